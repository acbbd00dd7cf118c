"""Image status, quarantine and collection reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.labels import micro


def file_counts(parsed: DataFrame, keys: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """Per label file: boxes kept, errors, repeated lines, out-of-scope lines, clipped, box and polygon lines."""
    # distinct boxes count in the same pass; rows without a box have nulls and do not count
    cell = ["class_id", *[micro(F.col(c)) for c in ("x", "y", "w", "h")]]
    out = parsed.groupBy(*keys).agg(
        F.count("class_id").alias("n_parsed"),
        F.countDistinct(*cell).alias("n_boxes"),
        F.count("error_code").alias("n_errors"),
        F.count_if(F.col("out_of_scope")).alias("n_out_of_scope"),
        F.count_if(F.col("source_type").endswith("_clipped")).alias("n_clipped"),
        F.count_if(F.col("source_type").startswith("bbox")).alias("n_bbox"),
        F.count_if(F.col("source_type").startswith("polygon")).alias("n_polygon"),
    )
    return out.withColumn("n_duplicates", F.col("n_parsed") - F.col("n_boxes")).drop("n_parsed")


COUNTS = ("n_boxes", "n_errors", "n_duplicates", "n_out_of_scope", "n_clipped", "n_bbox", "n_polygon")


def image_status(images: DataFrame, parsed: DataFrame, keys: tuple[str, ...] = ("image_id",), has_file: Column | None = None) -> DataFrame:
    """``images`` with the counts of their label files and ``status``.

    No label file, or any error in it: invalid; boxes: valid; else negative. ``has_file`` tells files that
    exist (they may hold no line); without it, a file exists if it has lines.
    """
    files = file_counts(parsed, keys)
    out = images.join(files.withColumn("__file", F.lit(True)), list(keys), "left")
    exists = has_file if has_file is not None else F.coalesce("__file", F.lit(False))
    for c in COUNTS:
        out = out.withColumn(c, F.coalesce(c, F.lit(0).cast("long")))
    status = F.when(~exists | (F.col("n_errors") > 0), "invalid").when(F.col("n_boxes") > 0, "valid").otherwise("negative")
    return out.withColumn("missing_label", ~exists).withColumn("status", status).drop("__file")


def split_quarantine(images: DataFrame, keep_negatives: bool = True) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined): invalid images, and negative ones if they are not wanted, go to the second."""
    bad = F.col("status") == "invalid" if keep_negatives else F.col("status") != "valid"
    return images.filter(~bad), images.filter(bad)


def collection_report(images: DataFrame) -> DataFrame:
    """One row: images scanned, valid, negative, invalid, missing; clipped, box, polygon and repeated lines."""
    return images.agg(
        F.count(F.lit(1)).alias("scanned"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("valid", "negative", "invalid")],
        F.count_if("missing_label").alias("missing"),
        *[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in ("n_clipped", "n_bbox", "n_polygon", "n_duplicates")],
    )


def boxes_per_class(images: DataFrame, boxes: DataFrame, classes: tuple[int, ...] = (0, 1), keys: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """``keys`` and ``instances_class_N`` of every image, 0 without boxes."""
    counts = boxes.groupBy(*keys).agg(*[F.count_if(F.col("class_id") == c).alias(f"instances_class_{c}") for c in classes])
    out = images.select(*keys).join(counts, list(keys), "left")
    return out.select(*keys, *[F.coalesce(f"instances_class_{c}", F.lit(0).cast("long")).alias(f"instances_class_{c}") for c in classes])
