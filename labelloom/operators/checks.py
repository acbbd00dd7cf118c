"""Checks of a manifest before it is published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.schemas import MIN_BOXES, MIN_GROUPS

#: Order in which ``assert_checks`` reports.
ORDER = ("empty", "invalid", "leak_group_id", "leak_sha256", "leak_original_key", "groups", "boxes", "stems")


def leaks(manifest: DataFrame, key: str) -> DataFrame:
    """Keys that occur in several splits; null keys don't count."""
    found = manifest.filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.sort_array(F.collect_set("split")).alias("s")).filter(F.size("s") > 1)
    return found.select(F.lit(f"leak_{key}").alias("check"), "key", F.array_join("s", ",").alias("detail"))


def check_split(manifest: DataFrame, min_groups: dict[str, int] = MIN_GROUPS, min_boxes: dict[str, int] = MIN_BOXES, classes: tuple[int, ...] = (0, 1), status_col: str = "annotation_status") -> DataFrame:
    """(check, key, detail): every violation at once."""
    spark = manifest.sparkSession
    row = lambda check, key, detail: (F.lit(check).alias("check"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))
    parts = [manifest.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(*row("empty", F.lit("manifest"), F.col("n")))]
    if status_col in manifest.columns:
        parts.append(manifest.filter(F.col(status_col) == "invalid").agg(F.count(F.lit(1)).alias("n")).filter("n > 0").select(*row("invalid", F.lit("manifest"), F.col("n"))))
    parts += [leaks(manifest, k) for k in ("group_id", "sha256", "original_key") if k in manifest.columns]
    groups = manifest.groupBy("split").agg(F.countDistinct("group_id").alias("n"))
    wanted = spark.createDataFrame(list(min_groups.items()), "split string, least int")
    few = wanted.join(groups, "split", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long"))).filter("n < least")
    parts.append(few.select(*row("groups", F.col("split"), F.col("n"))))
    boxes = manifest.groupBy("split").agg(*[F.sum(f"instances_class_{c}").alias(f"c{c}") for c in classes])
    wanted = spark.createDataFrame(list(min_boxes.items()), "split string, least int")
    per_class = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.coalesce(f"c{c}", F.lit(0).cast("long")).alias("n")) for c in classes]))
    scarce = boxes.join(wanted, "split").select("split", "least", per_class.alias("b")).filter("b.n < least")
    parts.append(scarce.select(*row("boxes", F.concat_ws(":", "split", F.col("b.c").cast("string")), F.col("b.n"))))
    return reduce(DataFrame.unionByName, parts)


def check_stems(images: DataFrame, labels: DataFrame, keys: tuple[str, ...] = ("split", "stem")) -> DataFrame:
    """Images without label and labels without image: both sides must have the same stems."""
    left, right = images.select(*keys).distinct().withColumn("__i", F.lit(True)), labels.select(*keys).distinct().withColumn("__l", F.lit(True))
    odd = left.join(right, list(keys), "full_outer").filter("__i IS NULL OR __l IS NULL")
    return odd.select(F.lit("stems").alias("check"), F.concat_ws("/", *keys).alias("key"), F.when(F.col("__i").isNull(), "no image").otherwise("no label").alias("detail"))


def assert_checks(violations: DataFrame) -> None:
    """Raise on the first violation, in the order of ``ORDER``."""
    rank = F.array_position(F.array(*[F.lit(c) for c in ORDER]), F.col("check"))
    first = violations.orderBy(rank, "key").limit(1).collect()
    if first:
        raise ValueError(f"{first[0]['check']}: {first[0]['key']} ({first[0]['detail']})")
