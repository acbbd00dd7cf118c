"""Summaries of detections per image and per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelloom.functions.boxes import CORNERS, area
from labelloom.schemas import CLASSES, LOCAL_NAMES

#: What is said with every result, and behind it where nothing was found: short defaults, to be replaced.
NOTES = ("This result supports a decision and does not make it.", "Ask an expert before acting on it.")
NOTHING = "An image without detections may still show what the model has missed."
#: Advice by class: neutral defaults, to be replaced.
ADVICE = {c: (f"{name.replace('_', ' ')}: look at the image again.", f"{name.replace('_', ' ')}: compare with earlier images.", f"{name.replace('_', ' ')}: ask an expert.") for c, name in CLASSES.items()}


def at_least(pred: DataFrame, confidence: float) -> DataFrame:
    """Detections of at least ``confidence``."""
    if not 0 <= confidence <= 1:
        raise ValueError("a confidence lies in [0, 1]")
    return pred.filter(F.col("confidence") >= confidence)


def named(class_id: Column, names: dict[int, str] = LOCAL_NAMES, fallback: dict[int, str] = CLASSES) -> Column:
    """Local name of a class, else its name, else ``Class N``."""
    pairs = [F.lit(x) for kv in {**fallback, **names}.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), class_id), F.concat(F.lit("Class "), class_id.cast("string")))


def detections_by_class(images: DataFrame, pred: DataFrame) -> DataFrame:
    """(class_id, n): detections per class."""
    return pred.join(images.select("image_id"), "image_id", "left_semi").groupBy("class_id").agg(F.count(F.lit(1)).alias("n"))


def run_summary(images: DataFrame, pred: DataFrame) -> DataFrame:
    """One row: images, images with detections, detections, overall status."""
    counts = summarise_images(images, pred)
    out = counts.agg(F.count(F.lit(1)).alias("images"), F.count_if(F.col("n") > 0).alias("images_detected"), F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("detections"))
    return out.withColumn("status", F.when(F.col("detections") > 0, "DETECTED").otherwise("NO_SYMPTOM_DETECTED"))


def summarise_images(images: DataFrame, pred: DataFrame, classes: tuple[int, int] = (0, 1), notes: tuple[str, ...] = NOTES, nothing: str = NOTHING, advice: dict[int, tuple[str, ...]] = ADVICE) -> DataFrame:
    """Per image: detections, per class, highest confidence (0 if none), status, diagnosis, warnings, advice.

    notes, nothing, advice: the texts said with every result, where nothing was found, and by class.
    """
    a, b = classes
    per = pred.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("class_id") == c).alias(f"n_class_{c}") for c in classes], F.max("confidence").alias("max_confidence"))
    zero = F.lit(0).cast("long")
    out = images.select("image_id").join(per, "image_id", "left")
    out = out.select("image_id", *[F.coalesce(c, zero).alias(c) for c in ("n", f"n_class_{a}", f"n_class_{b}")], F.coalesce("max_confidence", F.lit(0.0)).alias("max_confidence"))
    has = lambda c: F.col(f"n_class_{c}") > 0
    said = [F.lit(x) for x in notes]
    listed = lambda c: F.when(has(c), F.array(*[F.lit(x) for x in advice.get(c, ())])).otherwise(F.array().cast("array<string>"))
    return (
        out.withColumn("status", F.when(F.col("n") > 0, "DETECTED").otherwise("NO_SYMPTOM_DETECTED"))
        .withColumn("diagnosis", F.when(F.col("n") == 0, "none").when(has(a) & has(b), "both").when(has(a), f"class_{a}").otherwise(f"class_{b}"))
        .withColumn("message", F.when(F.col("n") > 0, F.format_string("%d regions reach the confidence threshold", F.col("n"))).otherwise("nothing reaches the confidence threshold"))
        .withColumn("warnings", F.when(F.col("n") > 0, F.array(*said)).otherwise(F.array(F.lit(nothing), *said)))
        .withColumn("advice", F.concat(listed(a), listed(b)))
        .withColumn("confidence_text", F.format_string("%.1f%%", F.col("max_confidence") * 100))
    )


def box_table(pred: DataFrame, sizes: DataFrame) -> DataFrame:
    """Display rows of detections: number in the image, names, confidence, corners, share of the image in percent.

    sizes: image_id, width, height. The number counts detections of the image by index.
    """
    numbered = pred.withColumn("__number", F.row_number().over(W.partitionBy("image_id").orderBy("pred_idx")))
    rows = numbered.join(sizes.select("image_id", "width", "height"), "image_id", "left")
    share = area(*[F.col(c) for c in CORNERS]) / (F.col("width") * F.col("height")) * 100
    return rows.select(
        "image_id", "pred_idx", F.col("__number").alias("number"), "class_id", named(F.col("class_id")).alias("local_name"),
        F.format_string("%.2f%%", F.col("confidence") * 100).alias("confidence_text"), F.format_string("[%.0f, %.0f, %.0f, %.0f]", *CORNERS).alias("corners"), share.alias("area_pct"),
    )
