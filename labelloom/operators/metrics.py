"""Precision, recall and average precision.

Average precision: at each IoU threshold the detections of an image take their best free truth of the same
class by falling confidence; over all images, detections are ranked by confidence (ties: image, index);
precision is made non-increasing and averaged over 101 recall points.

A detection is one row with a hit or none for each threshold. The rows of all classes are range-sorted once; running
counts are worked out inside the ranges and carried over them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelloom.operators.matching import CROWDED, crowded_images, per_image, ranked_candidates, take_in_rounds
from labelloom.operators.ranks import dealt_ranges
from labelloom.session import broadcast_if_small, written

#: Hits that one number holds.
BITS = 62
THRESHOLDS = tuple(round(0.5 + 0.05 * i, 2) for i in range(10))


def hits(gt: DataFrame, pred: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS, crowded: int = CROWDED) -> DataFrame:
    """(image_id, pred_idx, class_id, confidence, hits): an array of 1 or 0 for each threshold."""
    crowds = crowded_images(gt, pred, crowded)
    few = (gt, pred) if crowds is None else [x.join(crowds, "image_id", "left_anti") for x in (gt, pred)]
    per = per_image(*few).filter(F.size("p") > 0)
    at = F.array(*[F.lit(float(t)) for t in thresholds])
    result = "array<struct<pred_idx:int,class_id:int,confidence:double,hits:array<int>>>"

    def step(state: Column, p: Column) -> Column:
        # the best free truth at each threshold, and what is taken there
        free = lambda t, taken: F.get(F.filter(p["same"], lambda s: (-s["i"] >= t) & ~F.array_contains(taken, s["gt_idx"])), F.lit(0))["gt_idx"]
        got = F.when(F.size(p["same"]) > 0, F.zip_with(at, state["taken"], free)).otherwise(F.array_repeat(F.lit(None).cast("int"), len(thresholds)))

        def settle(gt_idx: Column) -> Column:
            line = F.struct(p["pred_idx"].alias("pred_idx"), p["class_id"].alias("class_id"), p["confidence"].alias("confidence"), F.transform(gt_idx, lambda g: g.isNotNull().cast("int")).alias("hits"))
            taken = F.zip_with(state["taken"], gt_idx, lambda t, g: F.when(g.isNull(), t).otherwise(F.array_append(t, g)))
            return F.struct(taken.alias("taken"), F.array_append(state["rows"], line).alias("rows"))

        return F.get(F.transform(F.array(got), settle), F.lit(0))

    start = F.struct(F.array_repeat(F.array().cast("array<int>"), len(thresholds)).alias("taken"), F.array().cast(result).alias("rows"))
    rows = per.select("image_id", F.explode(F.aggregate("p", start, step, lambda s: s["rows"])).alias("__row")).select("image_id", "__row.*")
    if crowds is None:
        return rows
    gt, pred = [written(x.join(crowds, "image_id", "left_semi"), "crowded-boxes") for x in (gt, pred)]
    many = written(ranked_candidates(gt, pred, crowded), "candidates")
    wanted = many.select("image_id", "pred_idx", (-F.col("confidence")).alias("order"), F.explode("same").alias("s")).select("image_id", "pred_idx", "order", "s.gt_idx", "s.i")
    wanted = wanted.withColumn("t", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(t)).alias("least")) for k, t in enumerate(thresholds)]))).filter(-F.col("i") >= F.col("t.least")).select("image_id", "t.k", "pred_idx", "order", "gt_idx", "i")
    won = take_in_rounds(wanted, ("image_id", "k")).groupBy("image_id", "pred_idx").agg(F.collect_set("k").alias("__k"))
    found = F.transform(F.sequence(F.lit(0), F.lit(len(thresholds) - 1)), lambda k: F.coalesce(F.array_contains("__k", k), F.lit(False)).cast("int"))
    return rows.unionByName(many.join(won, ["image_id", "pred_idx"], "left").select("image_id", "pred_idx", "class_id", "confidence", found.alias("hits")))


def true_positives(gt: DataFrame, pred: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """(image_id, pred_idx, class_id, confidence, threshold, tp) at every threshold."""
    each = F.arrays_zip(F.array(*[F.lit(float(t)) for t in thresholds]).alias("threshold"), F.col("hits").alias("tp"))
    return hits(gt, pred, thresholds).select("image_id", "pred_idx", "class_id", "confidence", F.explode(each).alias("e")).select("image_id", "pred_idx", "class_id", "confidence", "e.threshold", "e.tp")


def average_precision(gt: DataFrame, pred: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS, found: DataFrame | None = None) -> DataFrame:
    """(class_id, threshold, ap) of every class with truths. found: ``hits`` of the same, if known.

    No task holds a class: counts are carried over the ranges of one sort. A recall point takes the best precision of the
    rows that reach it, so rows meet at the highest of the 101 points they reach, and the rest is over points.
    """
    n = range(len(thresholds))
    key, order, part = "class_id", ("order", "image_id", "pred_idx"), ("class_id", "__part")
    truths = written(gt.groupBy(key).agg(F.count(F.lit(1)).alias("truths")), "truths")
    found = written(hits(gt, pred, thresholds), "hits") if found is None else found
    # a row carries its hits as the bits of a number
    masks = [sum((F.shiftleft(F.col("hits")[k].cast("long"), k % BITS) for k in n if k // BITS == j), F.lit(0).cast("long")).alias(f"mask{j}") for j in range(-(-len(thresholds) // BITS))]
    dealt = dealt_ranges(found.select(key, (-F.col("confidence")).alias("order"), "image_id", "pred_idx", *masks), key, *order)
    bit = lambda k: F.shiftright(F.col(f"mask{k // BITS}"), k % BITS).bitwiseAND(F.lit(1).cast("long"))
    values = {"seen": F.lit(1).cast("long"), **{f"hits{k}": bit(k) for k in n}}
    earlier = W.partitionBy(key).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    before = dealt.groupBy(*part).agg(*[F.sum(v).alias(name) for name, v in values.items()])
    before = before.select(*part, *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"__{name}") for name in values]).join(truths, key)
    # dealt before the bits become columns, and joined with a row for each range and class
    rows = dealt.repartition(*part).join(broadcast_if_small(written(before, "range-counts")), list(part)).withColumns(values)
    inside = W.partitionBy(*part).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({f"run_{name}": F.sum(name).over(inside) + F.col(f"__{name}") for name in values})
    point = lambda k: F.struct(F.lit(k).alias("k"), F.expr(f"CAST((100 * run_hits{k}) DIV truths AS INT)").alias("point"), (F.col(f"run_hits{k}") / F.col("run_seen")).alias("precision"))
    best = rows.select(key, F.explode(F.array(*[F.when(F.col(f"hits{k}") == 1, point(k)) for k in n])).alias("e")).filter("e IS NOT NULL")
    best = best.groupBy(key, F.col("e.k").alias("k"), F.col("e.point").alias("point")).agg(F.max("e.precision").alias("precision"))
    along = W.partitionBy(key, "k").orderBy("point")
    envelope = F.max("precision").over(W.partitionBy(key, "k").orderBy(F.desc("point")).rowsBetween(W.unboundedPreceding, 0))
    area = F.sum((F.col("point") - F.col("last")) * F.col("envelope")) / 101
    per = best.withColumn("envelope", envelope).withColumn("last", F.coalesce(F.lag("point").over(along), F.lit(-1))).groupBy(key, "k").agg(area.alias("ap"))
    every = truths.select(key, F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(t)).alias("threshold")) for k, t in enumerate(thresholds)])).alias("e")).select(key, "e.k", "e.threshold")
    return every.join(per, [key, "k"], "left").select(key, "threshold", F.coalesce("ap", F.lit(0.0)).alias("ap"))


def rates(gt: DataFrame, rows: DataFrame) -> DataFrame:
    """(class_id, tp, fp, fn, precision, recall) from rows (class_id, tp)."""
    per = rows.groupBy("class_id").agg(F.sum("tp").alias("tp"), F.count(F.lit(1)).alias("n"))
    truths = gt.groupBy("class_id").agg(F.count(F.lit(1)).alias("truths"))
    zero = F.lit(0).cast("long")
    out = truths.join(per, "class_id", "full_outer").select("class_id", F.coalesce("tp", zero).alias("tp"), (F.coalesce("n", zero) - F.coalesce("tp", zero)).alias("fp"), (F.coalesce("truths", zero) - F.coalesce("tp", zero)).alias("fn"))
    return out.withColumn("precision", F.try_divide("tp", F.col("tp") + F.col("fp"))).withColumn("recall", F.try_divide("tp", F.col("tp") + F.col("fn")))


def precision_recall(gt: DataFrame, pred: DataFrame, threshold: float = 0.5, confidence: float = 0.0) -> DataFrame:
    """(class_id, tp, fp, fn, precision, recall) of detections of at least ``confidence``."""
    return rates(gt, true_positives(gt, pred.filter(F.col("confidence") >= confidence), (threshold,)))


def class_metrics(gt: DataFrame, pred: DataFrame, threshold: float = 0.5, confidence: float = 0.0) -> DataFrame:
    """Per class: precision, recall, ap50 and ap50_95.

    Detections are matched once: what those below ``confidence`` take, those above never wanted.
    """
    thresholds = THRESHOLDS if threshold in THRESHOLDS else (*THRESHOLDS, threshold)
    found = written(hits(gt, pred, thresholds), "hits")
    ap = average_precision(gt, pred, THRESHOLDS, found).groupBy("class_id").agg(F.max(F.when(F.col("threshold") == 0.5, F.col("ap"))).alias("ap50"), F.avg("ap").alias("ap50_95"))
    at = F.col("hits")[thresholds.index(threshold)]
    return rates(gt, found.filter(F.col("confidence") >= confidence).select("class_id", at.alias("tp"))).join(ap, "class_id", "left")


def overall_metrics(per_class: DataFrame) -> DataFrame:
    """One row: mean precision, recall, map50 and map50_95 over classes."""
    return per_class.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("ap50").alias("map50"), F.avg("ap50_95").alias("map50_95"))
