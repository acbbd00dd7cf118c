"""Global positions without a single sorted partition."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelloom.session import written


def dense_positions(df: DataFrame, order_col: str, name: str) -> DataFrame:
    """``df`` with ``name``: the position (from 0, long) of each row in the order of ``order_col``.

    Rows are range-partitioned; a window ranks each partition by itself, and the partitions' sizes (a row
    each) are summed up before them.
    """
    dealt = written(df.repartitionByRange(order_col).withColumn("__part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(W.orderBy("__part")) - F.col("__n")).alias("__before"))
    inside = F.row_number().over(W.partitionBy("__part").orderBy(order_col)) - 1
    out = dealt.withColumn("__i", inside).join(F.broadcast(before), "__part")
    return out.withColumn(name, (F.col("__i") + F.col("__before")).cast("long")).drop("__part", "__i", "__before")


def dealt_ranges(df: DataFrame, *order: str) -> DataFrame:
    """``df`` range-partitioned by ``order`` and written, with the number of the range in ``__part``.

    Equal values of ``order`` share a range: end it with a column that tells rows apart where many may be equal. The
    ranges come from a sample, for which ``df`` is computed once more: write it before if that is dear.
    """
    return written(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranges")


def same_key(a: DataFrame, b: DataFrame, *key: str) -> Column:
    """Equality of the key columns of two DataFrames, null with null."""
    return reduce(and_, [a[k].eqNullSafe(b[k]) for k in key])


def running_sums(dealt: DataFrame, key: tuple[str, ...], order: tuple[str, ...], values: dict[str, Column]) -> DataFrame:
    """``dealt`` (see ``dealt_ranges``, of ``key`` and then ``order``) with, by name, the sum of each value over the
    rows before, of the same key.

    A window adds up inside each part of a key; what the parts before hold (a row for each part and key in it)
    is carried over. So no task holds a key.
    """
    rows = dealt.withColumns({f"__v_{n}": v for n, v in values.items()})
    parts = rows.groupBy(*key, "__part").agg(*[F.sum(f"__v_{n}").alias(f"__p_{n}") for n in values])
    earlier = W.partitionBy(*key).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(*key, "__part", *[F.coalesce(F.sum(f"__p_{n}").over(earlier), F.lit(0)).alias(f"__c_{n}") for n in values])
    inside = W.partitionBy("__part", *key).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns({f"__i_{n}": F.coalesce(F.sum(f"__v_{n}").over(inside), F.lit(0)) for n in values})
    out = rows.join(parts, (rows["__part"] == parts["__part"]) & same_key(rows, parts, *key) if key else rows["__part"] == parts["__part"])
    return out.select(*[rows[c] for c in dealt.columns], *[(F.col(f"__i_{n}") + F.col(f"__c_{n}")).alias(n) for n in values])


def later_maxima(dealt: DataFrame, key: tuple[str, ...], order: tuple[str, ...], values: dict[str, Column]) -> DataFrame:
    """``dealt`` (see ``dealt_ranges``) with, by name, the greatest value of this and the later rows of the same key:
    a window inside each part of a key, and what the later parts have, carried over."""
    rows = dealt.withColumns({f"__v_{n}": v for n, v in values.items()})
    parts = rows.groupBy(*key, "__part").agg(*[F.max(f"__v_{n}").alias(f"__p_{n}") for n in values])
    later = W.partitionBy(*key).orderBy(F.desc("__part")).rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(*key, "__part", *[F.max(f"__p_{n}").over(later).alias(f"__c_{n}") for n in values])
    # backwards: a frame that only grows is worked out once
    inside = W.partitionBy("__part", *key).orderBy(*[F.col(c).desc_nulls_last() for c in order]).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({f"__i_{n}": F.max(f"__v_{n}").over(inside) for n in values})
    out = rows.join(parts, (rows["__part"] == parts["__part"]) & same_key(rows, parts, *key) if key else rows["__part"] == parts["__part"])
    return out.select(*[rows[c] for c in dealt.columns], *[F.greatest(f"__i_{n}", f"__c_{n}").alias(n) for n in values])
