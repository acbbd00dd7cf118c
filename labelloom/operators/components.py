"""Connected components by alternating large and small stars (Kiveris et al., SoCC 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.session import checkpointed


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every node of ``edges``; the component is its smallest node.

    Every round points nodes at the smallest node they know of, as a join with one row per node, so a node of
    very many neighbours costs a skewed join (which AQE splits), never a collected group. Rounds end when
    nothing changes; lineage is cut by a checkpoint each round. Loops and null ends are ignored.
    """
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    e = checkpointed(e)
    before = _fingerprint(e)
    while before[0]:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = e.join(least.withColumnRenamed("a", "b"), "b").select("a", F.col("m").alias("b")).filter("a <> b").distinct()
        parent = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(parent, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        e = checkpointed(small.union(parent.select("a", F.col("m").alias("b"))).distinct())
        after = _fingerprint(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("b").alias("id")).distinct()
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots.select("id", F.col("id").alias("component")))
