import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.functions.boxes import corners, iou, size_class
from labelloom.operators import detections, matching, metrics

GT = "image_id long, gt_idx int, class_id int, x1 double, y1 double, x2 double, y2 double"
PRED = "image_id long, pred_idx int, class_id int, confidence double, x1 double, y1 double, x2 double, y2 double"


def frames(spark, gt, pred):
    return spark.createDataFrame(gt, GT), spark.createDataFrame(pred, PRED)


def overlap(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    inter = max(0.0, w) * max(0.0, h)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return inter / union if union > 0 else 0.0


def naive_match(gt, pred, t=0.5):
    """(image, pred, gt, outcome) by walking the detections of each image."""
    out = []
    for image in {r[0] for r in gt} | {r[0] for r in pred}:
        truths = [r for r in gt if r[0] == image]
        taken = set()
        for p in sorted((r for r in pred if r[0] == image), key=lambda r: (-r[3], r[1])):
            scored = [(overlap(g[3:7], p[4:8]), g) for g in truths]
            own = [(v, g) for v, g in scored if g[2] == p[2]]
            free = sorted(((-v, g[1]) for v, g in own if v >= t and g[1] not in taken))
            best_own, best = max((v for v, _ in own), default=0.0), max((v for v, _ in scored), default=0.0)
            if free:
                taken.add(free[0][1])
                out.append((image, p[1], free[0][1], "true_positive"))
            elif best_own >= t:
                out.append((image, p[1], None, "duplicate_detection"))
            elif best >= t:
                out.append((image, p[1], None, "classification_confusion"))
            elif best_own >= 0.1:
                out.append((image, p[1], None, "localization_error"))
            else:
                out.append((image, p[1], None, "false_positive_background"))
        out += [(image, None, g[1], "false_negative_missed_lesion") for g in truths if g[1] not in taken]
    return out


def some(seed):
    rng = random.Random(seed)

    def box():
        x, y = rng.randrange(20), rng.randrange(20)
        return float(x), float(y), float(x + rng.randrange(1, 14)), float(y + rng.randrange(1, 14))

    gt = [(i, j, rng.randrange(2), *box()) for i in range(12) for j in range(rng.randrange(5))]
    pred = [(i, j, rng.randrange(2), rng.randrange(8) / 8, *box()) for i in range(13) for j in range(rng.randrange(6))]
    return gt, pred


@pytest.mark.parametrize("seed", range(3))
def test_match_against_naive(spark, seed):
    gt, pred = some(seed)
    got = matching.match_detections(*frames(spark, gt, pred))
    rows = [(r.image_id, r.pred_idx, r.gt_idx, r.outcome) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(naive_match(gt, pred), key=str)
    counts = matching.error_counts(got).first()
    assert counts.tp + counts.fn == len(gt) and counts.tp + counts.fp == len(pred)


def test_one_shuffle_of_the_boxes(spark, sf_dir):
    """Truths and detections that are dealt by image already are not dealt again, nor written in between."""
    from labelloom.plans import catalogue

    df = catalogue.QUERIES["match_errors"](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    shuffles = [x for x in plan.splitlines() if " Exchange " in x and "Reused" not in x]
    assert len(shuffles) == 1 and "ReusedExchange" in plan, plan


def outcomes(spark, gt, pred):
    rows = matching.match_detections(*frames(spark, gt, pred)).filter("pred_idx IS NOT NULL").collect()
    return {(r.image_id, r.pred_idx): r.outcome for r in rows}


def test_one_truth_is_given_out_once_to_the_surest(spark):
    """Five shifted detections of one lesion, in rising confidence: the last one takes it, whatever overlaps more."""
    gt = [(7, 0, 1, 100.0, 50.0, 140.0, 90.0)]
    pred = [(7, i, 1, 0.1 + i / 10, 100.0 + 2 * i, 50.0, 140.0 + 2 * i, 90.0) for i in range(5)]
    got = outcomes(spark, gt, pred)
    assert got[7, 4] == "true_positive" and {got[7, i] for i in range(4)} == {"duplicate_detection"}
    assert matching.error_rows(matching.match_detections(*frames(spark, gt, pred))).count() == 4


def test_kinds_of_error_by_overlap_and_class(spark):
    """A detection slid off its truth step by step, once of the same class and once of the other."""
    truth = (3, 0, 0, 0.0, 0.0, 100.0, 40.0)
    for shift, same, other in ((20.0, "true_positive", "classification_confusion"), (60.0, "localization_error", "false_positive_background"), (95.0, "false_positive_background", "false_positive_background")):
        box = (shift, 0.0, 100.0 + shift, 40.0)
        assert outcomes(spark, [truth], [(3, 0, 0, 0.5, *box)]) == {(3, 0): same}
        assert outcomes(spark, [truth], [(3, 0, 1, 0.5, *box)]) == {(3, 0): other}


@pytest.mark.parametrize("t", [0, -0.1, 1.1])
def test_threshold_domain(spark, t):
    with pytest.raises(ValueError):
        matching.match_detections(*frames(spark, [], []), t)


def test_empty_sides(spark):
    gt, pred = frames(spark, [], [])
    assert matching.match_detections(gt, pred).count() == 0
    assert {r["size"]: r.recall for r in matching.size_recall(matching.match_detections(gt, pred), gt, spark.createDataFrame([], "image_id long, width int, height int")).collect()} == {"small": None, "medium": None, "large": None}


def test_iou_and_sizes(spark):
    box = lambda *v: [F.lit(float(x)) for x in v]
    a, b, c, d = spark.range(1).select(iou(box(0, 0, 10, 10), box(0, 0, 10, 10)), iou(box(0, 0, 1, 1), box(5, 5, 6, 6)), iou(box(0, 0, 10, 10), box(5, 5, 15, 15)), iou(box(1, 1, 1, 1), box(1, 1, 1, 1))).first()
    assert (a, b, d) == (1.0, 0.0, 0.0) and math.isclose(c, 25 / 175)
    s = lambda x, w: size_class(box(0, 0, x, x), F.lit(w), F.lit(w))
    assert tuple(spark.range(1).select(s(20, 100), s(40, 100), s(50, 100), s(50, 0)).first()) == ("small", "medium", "large", "medium")
    assert tuple(spark.range(1).select(*corners(*[F.lit(v) for v in (0.5, 0.5, 0.2, 0.4, 100, 200)])).first()) == (40.0, 60.0, 60.0, 140.0)


@pytest.mark.parametrize("seed", range(2))
def test_nms_against_naive(spark, seed):
    _, pred = some(seed)
    want = set()
    for key in {(r[0], r[2]) for r in pred}:
        kept = []
        for p in sorted((r for r in pred if (r[0], r[2]) == key), key=lambda r: (-r[3], r[1])):
            if all(overlap(k[4:8], p[4:8]) <= 0.3 for k in kept):
                kept.append(p)
        want |= {(p[0], p[1]) for p in kept}
    got = matching.nms(frames(spark, [], pred)[1], 0.3).collect()
    assert {(r.image_id, r.pred_idx) for r in got} == want


def naive_ap(gt, pred, cls, t):
    hits = {(i, p) for i, p, _, o in naive_match(gt, pred, t) if o == "true_positive"}
    n = sum(g[2] == cls for g in gt)
    rows = sorted((r for r in pred if r[2] == cls), key=lambda r: (-r[3], r[0], r[1]))
    tp = points = 0
    curve = []
    for k, r in enumerate(rows, 1):
        tp += (r[0], r[1]) in hits
        curve.append((tp, tp / k))
    for i in range(101):
        points += max((p for c, p in curve if 100 * c >= i * n and c > 0), default=0.0)
    return points / 101


def test_average_precision_against_naive(spark):
    gt, pred = some(5)
    got = metrics.average_precision(*frames(spark, gt, pred), (0.3, 0.5)).collect()
    assert len(got) == 4
    for r in got:
        assert math.isclose(r.ap, naive_ap(gt, pred, r.class_id, r.threshold), abs_tol=1e-9)
    per_class = metrics.class_metrics(*frames(spark, gt, pred))
    assert {"precision", "recall", "ap50", "ap50_95"} <= set(per_class.columns) and metrics.overall_metrics(per_class).count() == 1


def test_more_thresholds_than_one_number_holds(spark):
    gt, pred = some(8)
    at = tuple((k + 20) / 100 for k in range(70))
    got = {(r.class_id, r.threshold): r.ap for r in metrics.average_precision(*frames(spark, gt, pred), at).collect()}
    assert len(got) == 140
    for t in (0.2, 0.5, 0.81, 0.82, 0.89):
        for c in (0, 1):
            assert math.isclose(got[c, t], naive_ap(gt, pred, c, t), abs_tol=1e-9)


def test_summaries(spark):
    images = spark.createDataFrame([(1,), (2,), (3,)], "image_id long")
    pred = spark.createDataFrame([(1, 0, 0, 0.9, 0.0, 0.0, 32.0, 64.0), (1, 1, 1, 0.5, 0.0, 0.0, 1.0, 1.0), (2, 0, 1, 0.7, 0.0, 0.0, 64.0, 64.0)], PRED)
    rows = {r.image_id: r for r in detections.summarise_images(images, pred).collect()}
    assert [rows[i].diagnosis for i in (1, 2, 3)] == ["both", "class_1", "none"]
    assert [rows[i].max_confidence for i in (1, 2, 3)] == [0.9, 0.7, 0.0]
    assert len(rows[3].warnings) == 3 and len(rows[1].advice) == 6 and rows[1].confidence_text == "90.0%"
    r = detections.run_summary(images, detections.at_least(pred, 0.6)).first()
    assert (r.images, r.images_detected, r.detections, r.status) == (3, 2, 2, "DETECTED")
    sizes = images.select("image_id", F.lit(64).alias("width"), F.lit(64).alias("height"))
    boxes = {(r.image_id, r.number): (r.area_pct, r.local_name) for r in detections.box_table(pred, sizes).collect()}
    assert boxes[1, 1] == (50.0, "Bạc lá lúa") and boxes[2, 1][0] == 100.0
    assert spark.range(1).select(detections.named(F.lit(9))).first()[0] == "Class 9"
    with pytest.raises(ValueError):
        detections.at_least(pred, 1.5)


@pytest.mark.parametrize("seed", range(2))
def test_crowded_images_give_what_the_fold_gives(spark, seed):
    gt, pred = some(seed)
    g, p = frames(spark, gt, pred)
    got = {(r.image_id, r.pred_idx, r.gt_idx, r.outcome) for r in matching.match_detections(g, p, crowded=2).collect()}
    assert got == set(naive_match(gt, pred))
    pairs = lambda crowded: {(r.image_id, r.gt_idx, r.pred_idx, round(r.iou, 9)) for r in matching.iou_pairs(g, p, crowded).collect()}
    assert pairs(1) == pairs(10**6)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(matching.match_detections(g, p, crowded=2)) == rows(matching.match_detections(g, p))
    assert rows(matching.nms(p, 0.3, crowded=1)) == rows(matching.nms(p, 0.3))
    assert rows(matching.nms(p, 0.3, per_class=False, crowded=1)) == rows(matching.nms(p, 0.3, per_class=False))
    assert rows(metrics.hits(g, p, (0.3, 0.5), crowded=2)) == rows(metrics.hits(g, p, (0.3, 0.5)))


def all_overlaps(a, b):
    """(i, j, iou) of two lists of corner boxes, by comparing all with all."""
    out = []
    for lo in range(0, len(a), 200):
        x = a[lo : lo + 200, None]
        w = np.minimum(x[..., 2], b[:, 2]) - np.maximum(x[..., 0], b[:, 0])
        h = np.minimum(x[..., 3], b[:, 3]) - np.maximum(x[..., 1], b[:, 1])
        i, j = np.nonzero((w > 0) & (h > 0))
        inter = w[i, j] * h[i, j]
        size = lambda v: (v[:, 2] - v[:, 0]) * (v[:, 3] - v[:, 1])
        out.append(np.stack([i + lo, j, inter / (size(a[i + lo]) + size(b[j]) - inter)], axis=1))
    return np.concatenate(out)


def test_one_image_of_20000_boxes(spark):
    rng = np.random.default_rng(7)
    n = 10_000
    truth = np.concatenate([rng.uniform(0, 3000, (n, 2)), np.zeros((n, 2))], axis=1)
    truth[:, 2:] = truth[:, :2] + rng.uniform(8, 40, (n, 2))
    truth[0] = (0, 0, 3000, 3000)
    found = truth + rng.normal(0, 2, (n, 4)).round(2)
    found[:, 2:] = np.maximum(found[:, 2:], found[:, :2] + 1)
    score = rng.integers(0, 400, n) / 400
    g, p = frames(spark, [(1, i, 0, *map(float, b)) for i, b in enumerate(truth)], [(1, i, 0, float(s), *map(float, b)) for i, (s, b) in enumerate(zip(score, found, strict=True))])
    pairs = all_overlaps(truth, found)
    assert {(r.gt_idx, r.pred_idx) for r in matching.iou_pairs(g, p).collect()} == {(int(i), int(j)) for i, j, _ in pairs}
    wanted, taken, want = {}, set(), {}
    for i, j, v in sorted((r for r in pairs.tolist() if r[2] >= 0.5), key=lambda r: (-r[2], r[0])):
        wanted.setdefault(int(j), []).append(int(i))
    order = sorted(range(n), key=lambda j: (-score[j], j))
    for j in order:
        free = next((i for i in wanted.get(j, ()) if i not in taken), None)
        if free is not None:
            taken.add(free)
            want[j] = free
    got = {r.pred_idx: r.gt_idx for r in matching.match_detections(g, p).filter("outcome = 'true_positive'").collect()}
    assert got == want
    near = {}
    for i, j, v in all_overlaps(found, found).tolist():
        if i != j and v > 0.3:
            near.setdefault(int(i), []).append(int(j))
    kept = set()
    for j in order:
        if not any(k in kept for k in near.get(j, ())):
            kept.add(j)
    assert {r.pred_idx for r in matching.nms(p, 0.3).collect()} == kept


def test_equal_confidences_stay_spread(spark):
    gt = [(i, 0, 0, 0.0, 0.0, 10.0, 10.0) for i in range(400)]
    pred = [(i, 0, 0, 0.5, 0.0, 0.0, 10.0, 10.0 if i % 3 else 5.0) for i in range(400)]
    ap = metrics.average_precision(*frames(spark, gt, pred), (0.5, 0.9)).collect()
    want = lambda t: (lambda hits: sum(max((sum(hits[: k + 1]) / (k + 1) for k in range(len(hits)) if 100 * sum(hits[: k + 1]) >= 400 * x), default=0.0) for x in range(101)) / 101)([int(i % 3 > 0 or t <= 0.5) for i in range(400)])
    assert {r.threshold: pytest.approx(r.ap) for r in ap} == {t: want(t) for t in (0.5, 0.9)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    dealt = metrics.dealt_ranges(frames(spark, gt, pred)[1], "class_id", "confidence", "image_id")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert dealt.select("__part").distinct().count() > 1
