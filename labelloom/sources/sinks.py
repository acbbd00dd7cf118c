"""Sinks: manifest, curated images and labels, reports, conflicts, errors, metrics.

All writers refuse an existing target unless ``overwrite`` is set. Overwriting deletes first: a dataset that is in use
is replaced by ``publish``, which keeps the old version until the new one is checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.functions.labels import label_text
from labelloom.operators.checks import assert_checks, check_split


def mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def write_manifest(manifest: DataFrame, path: str, overwrite: bool = False, validate: bool = True, **limits) -> None:
    """Parquet partitioned by split, after the checks have passed."""
    if validate:
        assert_checks(check_split(manifest, **limits))
    manifest.write.mode(mode(overwrite)).partitionBy("split").parquet(path)


def write_csv(df: DataFrame, path: str, overwrite: bool = False) -> None:
    df.write.mode(mode(overwrite)).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, overwrite: bool = False) -> None:
    df.write.mode(mode(overwrite)).json(path)


def curated(images: DataFrame, boxes: DataFrame, key: str = "path") -> DataFrame:
    """(split, name, content, label_text): renamed images with the text of their clean labels."""
    line = label_text(*[F.col(c) for c in ("class_id", "x", "y", "w", "h")])
    texts = boxes.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("position", line.alias("line")))).alias("l"))
    text = F.coalesce(F.array_join(F.transform("l", lambda r: r["line"]), "\n"), F.lit(""))
    return images.join(texts, key, "left").select("split", F.col("output_image").alias("name"), "content", text.alias("label_text"))


def write_curated(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    rows.write.mode(mode(overwrite)).partitionBy("split").parquet(path)


def report(summary: DataFrame, collection: DataFrame) -> DataFrame:
    """One row: totals of the collection and a list of per-split counts."""
    splits = summary.agg(F.array_sort(F.collect_list(F.struct(*summary.columns))).alias("splits"))
    return collection.select(F.struct(*collection.columns).alias("collection")).crossJoin(F.broadcast(splits))


def conflict_rows(conflicts: DataFrame, paths: DataFrame, hash_col: str = "sha256", order_col: str = "ord", path_col: str = "path") -> DataFrame:
    """(sha256, reason, ord, path): the members of each conflict, a row each, however many there are."""
    rows = paths.join(conflicts.select(hash_col), hash_col, "left_semi")
    return rows.select(hash_col, F.lit("label_conflict").alias("reason"), order_col, path_col)


def conflict_list(conflicts: DataFrame, paths: DataFrame, hash_col: str = "sha256", order_col: str = "ord", path_col: str = "path") -> DataFrame:
    """(sha256, reason, paths): members of each conflict in scan order, joined by "; ", for reports to be read; conflicts
    of very many members are better kept as ``conflict_rows``."""
    rows = paths.join(conflicts.select(hash_col), hash_col, "left_semi").groupBy(hash_col).agg(F.array_sort(F.collect_list(F.struct(order_col, path_col))).alias("m"))
    return rows.select(hash_col, F.lit("label_conflict").alias("reason"), F.array_join(F.transform("m", lambda r: r[path_col]), "; ").alias("paths"))
