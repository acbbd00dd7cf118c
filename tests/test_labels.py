import math

import pytest
from pyspark.sql import functions as F

from labelloom.functions.labels import canonical_class, class_map, dedup_boxes, label_text, parse_labels, split_lines
from labelloom.operators.status import boxes_per_class, collection_report, image_status, split_quarantine
from labelloom.sources.files import label_lines


def parse(spark, lines):
    df = spark.createDataFrame([(i, "s", i, x) for i, x in enumerate(lines)], "image_id long, source string, line_no int, line string")
    classes = spark.createDataFrame([("s", 0.0, 0), ("s", 3.0, 1)], "source string, old_id double, class_id int")
    return parse_labels(df, classes).orderBy("line_no").collect()


def test_every_spelling_of_a_class_is_known(spark):
    """Names in any case and with any separator lead to the class; a name that only begins like one does not."""
    from labelloom.schemas import CLASSES

    for name in CLASSES.values():
        spellings = [name, name.lower(), name.upper(), name.replace("_", "-"), f"  {name.replace('_', ' ')} "]
        assert {r[0] for r in spark.createDataFrame([(x,) for x in spellings], "n string").select(canonical_class(F.col("n"))).collect()} == {name}
        assert spark.range(1).select(canonical_class(F.lit(name[:-2]))).first()[0] is None


@pytest.mark.parametrize("name", ["label_errors_by_code", "label_box_dedup", "image_status"])
def test_a_line_is_cut_and_read_once(spark, sf_dir, name):
    from labelloom.plans import catalogue

    plan = catalogue.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.lower().count("try_cast") + plan.lower().count("rlike") <= 3


def test_class_map(spark):
    got = class_map(spark, {"a": ["x", "brown spot", "Bacterial Leaf Blight"]}, ["Bacterial_Leaf_Blight", "Brown_Spot"]).collect()
    assert {(r.old_id, r.class_id) for r in got} == {(1.0, 1), (2.0, 0)}


def test_polygon_becomes_its_envelope(spark):
    """A triangle, a star of five points and one that leaves the image: the box of what is inside."""
    star = "0 0.5 0.25 0.55 0.4 0.75 0.4 0.6 0.5 0.65 0.75"
    triangle, _, outside = parse(spark, ["3 0.2 0.7 0.3 0.3 0.6 0.5", star, "0 0.25 0.5 0.75 0.25 0.75 1.0"])
    assert triangle.class_id == 1 and triangle.source_type == "polygon_to_bbox"
    assert (triangle.x, triangle.y, triangle.w, triangle.h) == pytest.approx((0.4, 0.5, 0.4, 0.4))
    assert (outside.x, outside.y, outside.w, outside.h) == pytest.approx((0.5, 0.625, 0.5, 0.75))


@pytest.mark.parametrize(
    ("line", "code"),
    [
        ("0 0.5 1.5 0.2 0.2", "out_of_range"),
        ("0 0.5 abc 0.2 0.2", "not_a_number"),
        ("0 0.1 0.2 0.3", "bad_shape"),
        ("0.5 0.1 0.2 0.3 0.4", "class_not_integer"),
        ("nan 0.1 0.2 0.3 0.4", "class_not_integer"),
        ("inf 0.1 0.2 0.3 0.4", "class_not_integer"),
        ("0", "bad_coordinates"),
        ("0 nan 0.2 0.3 0.4", "bad_coordinates"),
        ("0 0.5 0.5 0 0.4", "no_size"),
        ("0 0.1 0.2 0.3 0.4 0.5", "bad_shape"),
        ("0 0.1 0.2 0.3 0.4 0.5 0.6 0.7", "bad_shape"),
        ("0 1.000002 0.2 0.3 0.4", "out_of_range"),
        ("0 0x1p3 0.2 0.3 0.4", "not_a_number"),
        ("0 1d 0.2 0.3 0.4", "not_a_number"),
        ("1e300 abc", "not_a_number"),
    ],
)
def test_errors(spark, line, code):
    (r,) = parse(spark, [line])
    assert r.error_code == code and r.class_id is None and r.x is None


def test_blank_and_out_of_scope_lines(spark):
    blank, tab, other, bad, broken = parse(spark, ["", " \t ", "7 9 9 9 9", "7 abc", "x 1 2 3 4"])
    assert blank.error_code is None and blank.class_id is None and not blank.out_of_scope
    assert tab.error_code is None and not tab.out_of_scope
    assert other.error_code is None and other.out_of_scope
    assert bad.error_code == "not_a_number" and bad.out_of_scope
    assert broken.error_code == "not_a_number" and not broken.out_of_scope


def test_tolerance_and_clipping(spark):
    edge, clipped, plain, odd = parse(spark, ["0 0.5 1.0000005 0.2 0.2", "0 0.05 0.5 0.2 0.2", "+0 .5 5e-1 0.2 0.2 ", "0 0.5 0.5 0_0.2 0.2"])
    assert edge.error_code is None and edge.source_type == "bbox_clipped"
    assert clipped.source_type == "bbox_clipped" and math.isclose(clipped.w, 0.15)
    assert plain.source_type == "bbox" and plain.class_id == 0
    assert odd.error_code is None


def test_dedup_keeps_first_place_and_last_value(spark):
    df = spark.createDataFrame([(1, 1, 0, 0.5, 0.5, 0.2, 0.2, "bbox"), (1, 2, 0, 0.1, 0.1, 0.2, 0.2, "bbox"), (1, 3, 0, 0.50000001, 0.5, 0.2, 0.2, "bbox_clipped")], "image_id long, line_no int, class_id int, x double, y double, w double, h double, source_type string")
    got = dedup_boxes(df).orderBy("position").collect()
    assert [(r.position, r.source_type) for r in got] == [(1, "bbox_clipped"), (2, "bbox")]


def test_lines_of_a_file(spark):
    text = "a\r\nb\x0bc d\n\ne\n"
    df = spark.createDataFrame([("s", bytearray(text.encode())), ("t", bytearray(b""))], "stem string, content binary")
    rows = label_lines(df).orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in rows] == [(i + 1, x) for i, x in enumerate(text.splitlines())]
    assert spark.range(1).select(split_lines(F.lit("x"))).first()[0] == ["x"]


def test_status_and_report(spark):
    lines = [(1, "0 0.5 0.5 0.2 0.2"), (1, "0 0.5 0.5 0.2 0.2"), (2, "7 1 1 1 1"), (3, "0 0.5 0.5 0.2 0.2"), (3, "0 abc")]
    df = spark.createDataFrame([(i, "s", n, x) for n, (i, x) in enumerate(lines)], "image_id long, source string, line_no int, line string")
    classes = spark.createDataFrame([("s", 0.0, 0)], "source string, old_id double, class_id int")
    parsed = parse_labels(df, classes)
    images = spark.createDataFrame([(i, i in (1, 2, 3, 5)) for i in (1, 2, 3, 4, 5)], "image_id long, has boolean")
    got = image_status(images, parsed, has_file=F.col("has"))
    rows = {r.image_id: r for r in got.collect()}
    assert {i: r.status for i, r in rows.items()} == {1: "valid", 2: "negative", 3: "invalid", 4: "invalid", 5: "negative"}
    assert rows[1].n_boxes == 1 and rows[1].n_duplicates == 1 and rows[2].n_out_of_scope == 1 and rows[4].missing_label
    clean, bad = split_quarantine(got, keep_negatives=False)
    assert clean.count() + bad.count() == 5 and clean.count() == 1
    report = collection_report(got).first()
    assert (report.scanned, report.valid, report.negative, report.invalid, report.missing, report.n_duplicates) == (5, 1, 2, 2, 1, 1)
    per = {r.image_id: r.instances_class_0 for r in boxes_per_class(images, dedup_boxes(parsed)).collect()}
    assert per == {1: 1, 2: 0, 3: 1, 4: 0, 5: 0}


def test_label_text(spark):
    assert spark.range(1).select(label_text(F.lit(1), F.lit(0.5), F.lit(0.25), F.lit(0.125), F.lit(1.0))).first()[0] == "1 0.500000 0.250000 0.125000 1.000000"
