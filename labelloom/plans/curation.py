"""Whole jobs: curate a collection, diagnose detections, evaluate, summarise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.functions.images import Decoder, describe_images, describe_pixels
from labelloom.functions.labels import dedup_boxes, parse_labels
from labelloom.operators import dedup, matching, metrics, splits, status
from labelloom.operators.ranks import dense_positions
from labelloom.session import written
from labelloom.sources import files as source_files
from labelloom.sources import sinks


def curate(files: DataFrame, classes: DataFrame, distance: int | None = 2, keep_negatives: bool = True, decoder: Decoder | None = None, pixels: DataFrame | None = None, source_order: tuple[str, ...] = (), **split_options) -> dict[str, DataFrame]:
    """From (source, path, content) of dataset trees to a manifest.

    Returns manifest, curated (image and label text), quarantine, conflicts, duplicates, report. Invalid images
    are set aside before any pixel is decoded; equal bytes go before the similarity join. Sizes come from headers, hashes
    from ``decoder`` or from ``pixels`` (Spark's image source, whose ``origin`` is the path); without either, only
    equal origins make variants. Sources are scanned in the order of ``source_order``, others behind by name.
    """
    images = source_files.image_keys(source_files.list_images(files))
    labels = source_files.parts(files, "labels", ("txt",))
    key = ("source", "old_split", "stem")
    lines = source_files.label_lines(labels.select(*key, "content"))
    parsed = written(parse_labels(lines, classes), "parsed-labels")
    has = labels.select(*key, F.lit(True).alias("__has"))
    listed = status.image_status(images.join(has, list(key), "left"), parsed, key, F.coalesce("__has", F.lit(False))).drop("__has")
    clean, quarantine = status.split_quarantine(listed, keep_negatives)
    described = describe_images(clean, decoder)
    if pixels is not None:
        seen = describe_pixels(pixels).drop("width", "height")
        described = described.drop("phash", "blur", "brightness").join(seen, "path", "left")
    described = written(described, "described-images")
    corrupt = described.filter("width IS NULL").select("path", F.lit("corrupt").alias("reason"))
    listed_at = F.array_position(F.array(*[F.lit(s) for s in source_order]), F.col("source")) if source_order else F.lit(0)
    source_ord = F.when(listed_at > 0, listed_at).otherwise(len(source_order) + 1).cast("int")
    order = F.struct(source_ord.alias("source_ord"), "source", "split_ord", "path")
    records = clean.drop("content").join(described.filter("width IS NOT NULL"), "path").withColumn("ord", order)
    boxes = dedup_boxes(parsed, key)
    per_image = boxes.groupBy(*key).agg(F.collect_list(F.struct("class_id", "x", "y", "w", "h")).alias("b"))
    counts = status.boxes_per_class(records, boxes, keys=key)
    records = records.join(per_image, list(key), "left").join(counts.distinct(), list(key), "left")
    records = records.withColumn("signature", F.when(F.col("b").isNull(), "[]").otherwise(dedup.annotation_signature(F.col("b")))).drop("b")
    unique, conflicts, removed = dedup.exact_dedup(records)
    unique = unique.withColumn("hash", F.conv("phash", 16, -10).cast("long"))
    # ordinals stand for the scan order; equal for every rerun
    numbered = unique.withColumn("ord_text", F.col("ord"))
    grouped = _grouped(written(numbered, "unique-images"), distance)
    manifest = splits.assign_splits(grouped, **split_options)
    manifest = manifest.withColumn("is_negative", F.col("status") == "negative").withColumn("output_image", source_files.output_name(F.col("source"), F.col("stem"), F.col("sha256"), F.col("ext")))
    manifest = written(manifest, "manifest")
    final = manifest.select(
        F.regexp_replace("output_image", "\\.[^.]+$", "").alias("image_id"), F.col("image_id").alias("source_image_id"), "split", "source", "old_split", "group_id", "original_key", "output_image",
        F.col("path").alias("source_image"), "sha256", "phash", "width", "height", F.col("status").alias("annotation_status"), "is_negative",
        F.col("instances_class_0").cast("int").alias("instances_class_0"), F.col("instances_class_1").cast("int").alias("instances_class_1"),
    )
    contents = manifest.select("path", "split", "output_image", *key).join(files.select("path", "content"), "path")
    curated = sinks.curated(contents.withColumn("k", F.concat_ws("/", *key)), boxes.withColumn("k", F.concat_ws("/", *key)), "k")
    return {"manifest": final, "curated": curated, "quarantine": quarantine.drop("content"), "corrupt": corrupt, "conflicts": conflicts, "duplicates": removed, "report": status.collection_report(listed.drop("content"))}


def _grouped(unique: DataFrame, distance: int | None) -> DataFrame:
    """Variant groups named after the rank of their first member in scan order."""
    ranked = dense_positions(unique, "ord_text", "ordinal")
    return dedup.variant_groups(written(ranked, "ranked-images"), "ordinal", "original_key", "hash", distance)


def diagnose(truth: DataFrame, detections: DataFrame, sizes: DataFrame, manifest: DataFrame | None = None, threshold: float = 0.5) -> dict[str, DataFrame]:
    """errors (rows), counts, recall by size."""
    matches = written(matching.match_detections(truth, detections, threshold), "matches")
    return {"errors": matching.error_rows(matches, manifest), "counts": matching.error_counts(matches), "recall": matching.size_recall(matches, truth, sizes)}


def evaluate(truth: DataFrame, detections: DataFrame, confidence: float = 0.001) -> dict[str, DataFrame]:
    """per_class and overall metrics."""
    per_class = written(metrics.class_metrics(truth, detections, confidence=confidence), "class-metrics")
    return {"per_class": per_class, "overall": metrics.overall_metrics(per_class)}
