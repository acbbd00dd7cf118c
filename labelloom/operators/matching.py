"""Matching of detections to ground truth, error taxonomy and size-sliced recall."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.boxes import CORNERS, iou, size_class
from labelloom.schemas import SIZES
from labelloom.session import written

#: Boxes of an image from which it is cut into tiles, and settled in rounds instead of one after the other.
CROWDED = 1000

OUTCOMES = ("true_positive", "duplicate_detection", "classification_confusion", "localization_error", "false_positive_background", "false_negative_missed_lesion")


def check_threshold(t: float) -> None:
    if not 0 < t <= 1:
        raise ValueError("an IoU threshold lies in (0, 1]")


def tile_grid(boxes: DataFrame, keys: tuple[str, ...], crowded: int = CROWDED) -> DataFrame:
    """(keys, x0, y0, tile_w, tile_h, nx, ny): the tiles of every group of more than ``crowded`` boxes.

    As many tiles as would give each some eight boxes, but none smaller than the average box, so that a box of
    average size lies in four at most.
    """
    per = boxes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("x1").alias("x0"), F.min("y1").alias("y0"), F.max("x2").alias("xe"), F.max("y2").alias("ye"), F.avg(F.col("x2") - F.col("x1")).alias("w"), F.avg(F.col("y2") - F.col("y1")).alias("h"))
    per = per.filter(F.col("n") > crowded)
    across = lambda a, b, size: F.greatest(F.lit(1), F.least(F.ceil(F.sqrt(F.col("n") / 8)), F.when(F.col(size) > 0, F.floor((F.col(b) - F.col(a)) / F.col(size))).otherwise(F.lit(1)))).cast("long")
    per = per.withColumn("nx", across("x0", "xe", "w")).withColumn("ny", across("y0", "ye", "h"))
    width = lambda a, b, n: F.greatest((F.col(b) - F.col(a)) / F.col(n), F.lit(1e-300))
    return per.select(*keys, "x0", "y0", width("x0", "xe", "nx").alias("tile_w"), width("y0", "ye", "ny").alias("tile_h"), "nx", "ny")


def tile_of(value: Column, start: str, size: str, n: str) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(F.floor((value - F.col(start)) / F.col(size)).cast("long"), F.col(n) - 1))


def in_tiles(boxes: DataFrame, grid: DataFrame, keys: tuple[str, ...], prefix: str) -> DataFrame:
    """A row for each tile that a box touches; boxes without a grid lie in tile 0."""
    c = lambda k: F.col(f"{prefix}{k}")
    span = lambda a, b, *grid: F.sequence(tile_of(F.least(a, b), *grid), tile_of(F.greatest(a, b), *grid))
    rows, columns = span(c("x1"), c("x2"), "x0", "tile_w", "nx"), span(c("y1"), c("y2"), "y0", "tile_h", "ny")
    every = F.flatten(F.transform(rows, lambda i: F.transform(columns, lambda j: i * F.col("ny") + j)))
    return boxes.join(grid, list(keys), "left").withColumn("tile", F.explode(F.when(F.col("nx").isNull(), F.array(F.lit(0).cast("long"))).otherwise(every)))


def overlapping(left: DataFrame, right: DataFrame, grid: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Pairs of boxes of equal ``keys`` that overlap, with ``iou``. Their corners have the prefixes g_ and p_.

    Boxes meet in the tiles they share; the tile of the overlap's first corner counts, so a pair occurs once.
    """
    # boxes that don't overlap can't decide anything and go before the division
    overlap = "least(g_x2, p_x2) > greatest(g_x1, p_x1) AND least(g_y2, p_y2) > greatest(g_y1, p_y1)"
    value = iou([F.col(f"g_{c}") for c in CORNERS], [F.col(f"p_{c}") for c in CORNERS])
    if grid.isEmpty():
        pairs = left.join(right, list(keys)).filter(overlap)
    else:
        grid = written(grid, "tile-grid")
        names = ("x0", "y0", "tile_w", "tile_h", "nx", "ny")
        pairs = in_tiles(left, grid, keys, "g_").join(in_tiles(right, grid, keys, "p_").drop(*names), [*keys, "tile"]).filter(overlap)
        first = tile_of(F.greatest("g_x1", "p_x1"), "x0", "tile_w", "nx") * F.col("ny") + tile_of(F.greatest("g_y1", "p_y1"), "y0", "tile_h", "ny")
        pairs = pairs.filter(F.col("nx").isNull() | (F.col("tile") == first)).drop(*names, "tile")
    return pairs.withColumn("iou", value).filter("iou > 0")


def iou_pairs(gt: DataFrame, pred: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(image_id, gt_idx, pred_idx, gt_class, pred_class, iou) of every overlapping pair of an image.

    Crowded images are cut into tiles, where boxes meet those nearby only.
    """
    g = gt.select("image_id", "gt_idx", F.col("class_id").alias("gt_class"), *[F.col(c).alias(f"g_{c}") for c in CORNERS])
    p = pred.select("image_id", "pred_idx", F.col("class_id").alias("pred_class"), *[F.col(c).alias(f"p_{c}") for c in CORNERS])
    grid = tile_grid(gt.select("image_id", *CORNERS).unionAll(pred.select("image_id", *CORNERS)), ("image_id",), crowded)
    return overlapping(g, p, grid, ("image_id",)).select("image_id", "gt_idx", "pred_idx", "gt_class", "pred_class", "iou")


def ranked_candidates(gt: DataFrame, pred: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``pred`` with ``same`` (same-class truths by IoU, then index), ``best_same``, ``best_any`` and ``true_class``."""
    same = F.when(F.col("gt_class") == F.col("pred_class"), F.struct((-F.col("iou")).alias("i"), "gt_idx"))
    per = iou_pairs(gt, pred, crowded).groupBy("image_id", "pred_idx").agg(
        F.array_sort(F.collect_list(same)).alias("same"),
        F.max(F.when(F.col("gt_class") == F.col("pred_class"), F.col("iou"))).alias("best_same"),
        F.max(F.struct("iou", (-F.col("gt_idx")).alias("i"), F.col("gt_class").alias("c"))).alias("any"),
    )
    out = pred.join(per, ["image_id", "pred_idx"], "left")
    none = F.array().cast("array<struct<i:double,gt_idx:int>>")
    return out.select("image_id", "pred_idx", "class_id", "confidence", F.coalesce("same", none).alias("same"), F.coalesce("best_same", F.lit(0.0)).alias("best_same"), F.coalesce("any.iou", F.lit(0.0)).alias("best_any"), F.col("any.c").alias("true_class"))


def split_crowded(rows: DataFrame, keys: tuple[str, ...], crowded: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of groups of at most ``crowded`` rows, the others or None)."""
    many = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowded).select(*keys)
    if many.isEmpty():
        return rows, None
    many = written(many, "crowded")
    return rows.join(many, list(keys), "left_anti"), rows.join(many, list(keys), "left_semi")


def take_in_rounds(edges: DataFrame, keys: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """(keys, pred_idx, gt_idx, i): what detections get if they take their best free truth one after the other.

    edges: keys, pred_idx, order (less is earlier), gt_idx, i (less is better). In a round, a detection takes its best
    free truth if no earlier one that is still open wants it at all; both leave. The earliest open detection always
    can, and a detection that waits waits for an earlier one only, so the outcome is that of the sequence.
    """
    found, edges = None, written(edges.select(*keys, "pred_idx", "order", "gt_idx", "i"), "wanted")
    while not edges.isEmpty():
        best = edges.groupBy(*keys, "pred_idx").agg(F.min(F.struct("i", "gt_idx")).alias("b")).select(*keys, "pred_idx", "b.gt_idx", "b.i")
        first = edges.groupBy(*keys, "gt_idx").agg(F.min(F.struct("order", "pred_idx")).alias("f")).select(*keys, "gt_idx", F.col("f.pred_idx").alias("pred_idx"))
        won = written(best.join(first, [*keys, "gt_idx", "pred_idx"]).select(*keys, "pred_idx", "gt_idx", "i"), "taken")
        edges = edges.join(won.select(*keys, "pred_idx"), [*keys, "pred_idx"], "left_anti").join(won.select(*keys, "gt_idx"), [*keys, "gt_idx"], "left_anti")
        edges = written(edges.select(*keys, "pred_idx", "order", "gt_idx", "i"), "wanted")
        found = won if found is None else found.unionByName(won)
    return edges.select(*keys, "pred_idx", "gt_idx", "i") if found is None else found


def match_line(p: Column | None, hit_gt: Column, hit_i: Column, threshold: float, floor: float) -> list[Column]:
    """The columns of a match from a detection (a struct, or the row itself) and the truth it took, if any."""
    c = (lambda k: p[k]) if p is not None else F.col
    found = hit_gt.isNotNull()
    outcome = (
        F.when(found, OUTCOMES[0])
        .when(c("best_same") >= threshold, OUTCOMES[1])
        .when(c("best_any") >= threshold, OUTCOMES[2])
        .when(c("best_same") >= floor, OUTCOMES[3])
        .otherwise(OUTCOMES[4])
    )
    confused = ~found & (c("best_same") < threshold) & (c("best_any") >= threshold)
    best = F.when(found, -hit_i).when(confused, c("best_any")).otherwise(c("best_same"))
    return [c("pred_idx").alias("pred_idx"), hit_gt.alias("gt_idx"), c("class_id").alias("class_id"), c("confidence").alias("confidence"), best.alias("best_iou"), F.when(confused, c("true_class")).alias("true_class"), outcome.alias("outcome")]


def crowded_images(gt: DataFrame, pred: DataFrame, crowded: int) -> DataFrame | None:
    """The images of more than ``crowded`` boxes, or None."""
    many = gt.select("image_id").unionAll(pred.select("image_id")).groupBy("image_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowded).select("image_id")
    many = written(many, "crowded")
    return None if many.isEmpty() else many


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def per_image(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """(image_id, p, t): the detections of an image in their order, with the candidates of ``ranked_candidates``, and its
    truths. Both sides are dealt by image only, and not at all if they are already; null images meet none.
    """
    truths = gt.groupBy("image_id").agg(F.collect_list(F.struct("gt_idx", "class_id", *CORNERS)).alias("t"))
    row = F.struct((-F.col("confidence")).alias("order"), "pred_idx", "class_id", "confidence", *CORNERS)
    found = pred.groupBy("image_id").agg(F.array_sort(F.collect_list(row)).alias("p"))

    def candidates(p: Column) -> Column:
        # boxes that don't overlap can't decide anything and go before the division
        met = F.filter("t", lambda g: (F.least(g["x2"], p["x2"]) > F.greatest(g["x1"], p["x1"])) & (F.least(g["y2"], p["y2"]) > F.greatest(g["y1"], p["y1"])))
        met = F.transform(met, lambda g: F.struct(iou([g[c] for c in CORNERS], [p[c] for c in CORNERS]).alias("iou"), (-g["gt_idx"]).alias("i"), g["class_id"].alias("c")))
        return once(F.filter(met, lambda m: m["iou"] > 0), lambda near: once(F.array_sort(F.transform(F.filter(near, lambda m: m["c"] == p["class_id"]), lambda m: F.struct((-m["iou"]).alias("i"), (-m["i"]).alias("gt_idx")))), lambda same: line(p, near, same)))

    def line(p: Column, near: Column, same: Column) -> Column:
        best = F.coalesce(-F.get(same, F.lit(0))["i"], F.lit(0.0))
        return once(F.array_max(near), lambda top: F.struct(*[p[k].alias(k) for k in ("pred_idx", "class_id", "confidence")], same.alias("same"), best.alias("best_same"), F.coalesce(top["iou"], F.lit(0.0)).alias("best_any"), top["c"].alias("true_class")))

    none = lambda name, kind: F.coalesce(name, F.array().cast(kind)).alias(name)
    both = found.join(truths, "image_id", "full_outer")
    both = both.select("image_id", none("p", both.schema["p"].dataType), none("t", both.schema["t"].dataType))
    return both.select("image_id", F.transform("p", candidates).alias("p"), "t")


def match_detections(gt: DataFrame, pred: DataFrame, threshold: float = 0.5, floor: float = 0.1, crowded: int = CROWDED) -> DataFrame:
    """One row per detection and per missed truth: image_id, pred_idx, gt_idx, class_id, confidence, best_iou,
    true_class, outcome.

    Detections of an image take their best free truth of the same class by falling confidence (ties: index).
    The order inside an image is a fold over its detections, which stays in the JVM; images of more than
    ``crowded`` boxes are settled in rounds (see ``take_in_rounds``), without a list of theirs. Both inputs are read more
    than once (images are counted first): write them before if they are dear.
    """
    check_threshold(threshold)
    many = crowded_images(gt, pred, crowded)
    few = (gt, pred) if many is None else [x.join(many, "image_id", "left_anti") for x in (gt, pred)]
    taken = "array<int>"
    result = "array<struct<pred_idx:int,gt_idx:int,class_id:int,confidence:double,best_iou:double,true_class:int,outcome:string>>"

    def step(state: Column, p: Column) -> Column:
        free = F.get(F.filter(p["same"], lambda s: (s["i"] <= -threshold) & ~F.array_contains(state["taken"], s["gt_idx"])), F.lit(0))

        def settle(hit: Column) -> Column:
            line = F.struct(*match_line(p, hit["gt_idx"], hit["i"], threshold, floor))
            return F.struct(F.when(hit["gt_idx"].isNotNull(), F.array_append(state["taken"], hit["gt_idx"])).otherwise(state["taken"]).alias("taken"), F.array_append(state["rows"], line).alias("rows"))

        return once(free, settle)

    def missed(state: Column) -> Column:
        left = F.filter("t", lambda g: ~F.coalesce(F.array_contains(state["taken"], g["gt_idx"]), F.lit(False)))
        return F.concat(state["rows"], F.transform(left, lambda g: F.struct(*missed_line(g["gt_idx"], g["class_id"]))).cast(result))

    start = F.struct(F.array().cast(taken).alias("taken"), F.array().cast(result).alias("rows"))
    rows = per_image(*few).select("image_id", F.explode(F.aggregate("p", start, step, missed)).alias("__row")).select("image_id", "__row.*")
    if many is None:
        return rows
    gt, pred = [written(x.join(many, "image_id", "left_semi"), "crowded-boxes") for x in (gt, pred)]
    ranked = written(ranked_candidates(gt, pred, crowded), "candidates")
    wanted = ranked.select("image_id", "pred_idx", (-F.col("confidence")).alias("order"), F.explode("same").alias("s")).select("image_id", "pred_idx", "order", "s.gt_idx", "s.i")
    won = take_in_rounds(wanted.filter(F.col("i") <= -threshold)).withColumnsRenamed({"gt_idx": "__gt", "i": "__i"})
    settled = written(ranked.join(won, ["image_id", "pred_idx"], "left").select("image_id", *match_line(None, F.col("__gt"), F.col("__i"), threshold, floor)), "settled")
    left = gt.join(settled.filter("gt_idx IS NOT NULL").select("image_id", "gt_idx"), ["image_id", "gt_idx"], "left_anti")
    return rows.unionByName(settled).unionByName(left.select("image_id", *missed_line(F.col("gt_idx"), F.col("class_id"))))


def missed_line(gt_idx: Column, class_id: Column) -> list[Column]:
    null = lambda k: F.lit(None).cast(k)
    return [null("int").alias("pred_idx"), gt_idx.alias("gt_idx"), class_id.alias("class_id"), null("double").alias("confidence"), null("double").alias("best_iou"), null("int").alias("true_class"), F.lit(OUTCOMES[5]).alias("outcome")]


def error_rows(matches: DataFrame, manifest: DataFrame | None = None, keep: tuple[str, ...] = ("output_image", "source", "is_negative")) -> DataFrame:
    """Matches without true positives, with ``error_type`` and the image's columns."""
    out = matches.filter(F.col("outcome") != OUTCOMES[0]).withColumn("error_type", F.when(F.col("outcome") == OUTCOMES[5], "false_negative").otherwise("false_positive"))
    return out if manifest is None else out.join(manifest.select("image_id", *keep), "image_id", "left")


def error_counts(matches: DataFrame) -> DataFrame:
    """One row: true and false positives, false negatives and every kind of error."""
    count = lambda *names: F.count_if(F.col("outcome").isin(*names))
    return matches.agg(count(OUTCOMES[0]).alias("tp"), count(*OUTCOMES[1:5]).alias("fp"), count(OUTCOMES[5]).alias("fn"), *[count(o).alias(o) for o in OUTCOMES[1:5]])


def size_recall(matches: DataFrame, gt: DataFrame, sizes: DataFrame) -> DataFrame:
    """(size, total, recalled, recall) for small, medium and large truths; recall is null without truths.

    sizes: image_id, width, height.
    """
    hit = matches.filter(F.col("outcome") == OUTCOMES[0]).select("image_id", "gt_idx", F.lit(1).alias("hit"))
    # the size goes to the join instead of the box
    rows = gt.join(sizes.select("image_id", "width", "height"), "image_id").select("image_id", "gt_idx", size_class([F.col(c) for c in CORNERS], F.col("width"), F.col("height")).alias("size"))
    rows = rows.join(hit, ["image_id", "gt_idx"], "left").groupBy("size").agg(F.count(F.lit(1)).alias("total"), F.count("hit").alias("recalled"))
    every = gt.sparkSession.createDataFrame([(s,) for s in SIZES], "size string").join(rows, "size", "left")
    zero = F.lit(0).cast("long")
    out = every.select("size", F.coalesce("total", zero).alias("total"), F.coalesce("recalled", zero).alias("recalled"))
    return out.withColumn("recall", F.round(F.try_divide(F.col("recalled"), F.col("total")), 4))


def nms(pred: DataFrame, threshold: float = 0.45, per_class: bool = True, crowded: int = CROWDED) -> DataFrame:
    """Detections left by non-maximum suppression: by falling confidence (ties: index), a box goes if it
    overlaps a kept one by more than ``threshold``.

    A fold over the boxes of an image, or, for more than ``crowded`` boxes, rounds over the overlaps: a box without
    an open earlier neighbour stays, its later neighbours go.
    """
    check_threshold(threshold)
    keys = ("image_id", "class_id") if per_class else ("image_id",)
    few, many = split_crowded(pred, keys, crowded)
    row = F.struct((-F.col("confidence")).alias("order"), "pred_idx", *CORNERS)
    per = few.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("p"))

    def step(kept: Column, p: Column) -> Column:
        clash = F.exists(kept, lambda k: iou([k[c] for c in CORNERS], [p[c] for c in CORNERS]) > threshold)
        return F.when(clash, kept).otherwise(F.array_append(kept, p))

    start = F.array().cast("array<struct<order:double,pred_idx:int,x1:double,y1:double,x2:double,y2:double>>")
    kept = per.select("image_id", F.explode(F.aggregate("p", start, step)).alias("__row")).select("image_id", "__row.pred_idx")
    if many is not None:
        kept = kept.unionByName(many.select("image_id", "pred_idx").join(suppressed_in_rounds(many, keys, threshold, crowded), ["image_id", "pred_idx"], "left_anti"))
    return pred.join(kept, ["image_id", "pred_idx"], "left_semi")


def suppressed_in_rounds(boxes: DataFrame, keys: tuple[str, ...], threshold: float, crowded: int = CROWDED) -> DataFrame:
    """(image_id, pred_idx) of the boxes that go."""
    grid = tile_grid(boxes, keys, crowded)
    side = lambda x, first: boxes.select(*keys, F.struct((-F.col("confidence")).alias("order"), "pred_idx").alias(first), *[F.col(c).alias(f"{x}_{c}") for c in CORNERS])
    pairs = overlapping(side("g", "first"), side("p", "second"), grid, keys).filter((F.col("first") < F.col("second")) & (F.col("iou") > threshold))
    edges = written(pairs.select("image_id", F.col("first.pred_idx").alias("first"), F.col("second.pred_idx").alias("second")), "clashes")
    gone = edges.select("image_id", F.col("first").alias("pred_idx")).limit(0)
    while not edges.isEmpty():
        later = edges.select("image_id", F.col("second").alias("first")).distinct()
        sure = edges.join(later, ["image_id", "first"], "left_anti")
        going = written(sure.select("image_id", F.col("second").alias("pred_idx")).distinct(), "suppressed")
        edges = edges.join(going.withColumnRenamed("pred_idx", "first"), ["image_id", "first"], "left_anti").join(going.withColumnRenamed("pred_idx", "second"), ["image_id", "second"], "left_anti")
        edges = written(edges.select("image_id", "first", "second"), "clashes")
        gone = gone.unionByName(going)
    return gone
