"""Exact duplicates, label conflicts and variant groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.operators.components import connected_components
from labelloom.operators.similarity import equal_links, hamming_links


def annotation_signature(boxes: Column) -> Column:
    """A text that is equal for equal sets of boxes, coordinates to five decimals."""
    five = lambda v: F.floor(v * F.lit(1e5) + F.lit(0.5)).cast("long")
    rows = F.transform(boxes, lambda b: F.struct(b["class_id"].alias("c"), *[five(b[k]).alias(k) for k in ("x", "y", "w", "h")]))
    return F.to_json(F.array_sort(rows))


def exact_dedup(records: DataFrame, hash_col: str = "sha256", signature_col: str = "signature", order_col: str = "ord") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(unique, conflicts, removed).

    Of equal hashes with one signature the first by ``order_col`` stays; hashes with several signatures are
    conflicts and leave altogether (one row each: hash, members, signatures, ids in order). The first row is
    found by an aggregate that combines before the shuffle, not by a window over the whole group.
    """
    per = records.groupBy(hash_col).agg(F.countDistinct(F.coalesce(F.col(signature_col), F.lit(""))).alias("signatures"), F.count(F.lit(1)).alias("members"), F.min(order_col).alias("__first"))
    good = per.filter("signatures = 1")
    unique = records.join(good.select(hash_col, "__first"), hash_col).filter(F.col(order_col) == F.col("__first")).select(*records.columns)
    removed = records.join(good.select(hash_col, "__first"), hash_col).filter(F.col(order_col) != F.col("__first")).select(*records.columns)
    clash = per.filter("signatures > 1").select(hash_col, "members", "signatures")
    ids = records.join(clash, hash_col).groupBy(hash_col, "members", "signatures").agg(F.array_sort(F.collect_list(order_col)).alias("ids"))
    return unique, ids, removed


def variant_groups(records: DataFrame, id_col: str = "ord", origin_col: str = "original_key", hash_col: str = "phash", distance: int | None = 2) -> DataFrame:
    """``records`` with ``group_ord`` (smallest member) and ``group_id``.

    Rows belong together if they share a non-empty origin or their hashes are at most ``distance`` bits apart
    (None: origins only), in any number of steps.
    """
    if distance is not None and distance < 0:
        raise ValueError("distance must not be negative")
    edges = equal_links(records, id_col, origin_col)
    if distance is not None:
        edges = edges.union(equal_links(records, id_col, hash_col)).union(hamming_links(records, id_col, hash_col, distance))
    found = connected_components(edges)
    out = records.join(found.select(F.col("id").alias(id_col), F.col("component").alias("__c")), id_col, "left")
    out = out.withColumn("group_ord", F.coalesce("__c", F.col(id_col))).drop("__c")
    return out.withColumn("group_id", F.format_string("group_%06d", F.col("group_ord")))


def links_made(records: DataFrame, **options) -> int:
    """Unions that near-duplicate hashes add to the origin groups."""
    count = lambda d: variant_groups(records, **{**options, "distance": d}).select("group_ord").distinct().count()
    return count(None) - count(options.get("distance", 2))
