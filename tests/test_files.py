import hashlib
import re
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.functions import images
from labelloom.functions.labels import class_map
from labelloom.operators.splits import split_summary
from labelloom.plans.curation import curate, diagnose, evaluate
from labelloom.sources import archives, files, publish, sinks
from labelloom.streaming.screening import screened_stream


def png(image: np.ndarray) -> bytes:
    """An RGB PNG without filters."""
    h, w = image.shape[:2]
    rows = b"".join(b"\0" + line.tobytes() for line in image[:, :, ::-1].astype(np.uint8))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def jpeg(width, height, before=b"", frame=0xC0):
    return b"\xff\xd8" + before + b"\xff" + bytes([frame]) + struct.pack(">HBHHB", 17, 8, height, width, 3) + b"\1\x22\0\2\x11\1\3\x11\1\xff\xda" + b"0" * 20


def segment(kind, data):
    return b"\xff" + bytes([kind]) + struct.pack(">H", len(data) + 2) + data


def picture(seed, size=48):
    rng = np.random.default_rng(seed)
    coarse = rng.integers(0, 256, (6, 6, 3))
    return np.kron(coarse, np.ones((size // 6, size // 6, 1))).astype(np.uint8)


def test_hash_and_quality():
    image = picture(1)
    h = images.phash(image)
    assert len(h) == 16 and h == images.phash(image.copy()) and len(images.phash(image, 4)) == 4
    noisy = np.clip(image.astype(int) + np.random.default_rng(0).integers(-2, 3, image.shape), 0, 255).astype(np.uint8)
    distance = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    assert 2 * distance(h, images.phash(noisy)) < distance(h, images.phash(picture(2)))
    with pytest.raises(ValueError):
        images.phash(image, 0)
    flat = np.full((40, 40, 3), 100, np.uint8)
    assert images.quality(flat) == (0.0, pytest.approx(100.0))


def riff(kind, data):
    return b"RIFF" + struct.pack("<I", len(data) + 12) + b"WEBP" + kind + struct.pack("<I", len(data)) + data


def bmp(width, height):
    return b"BM" + struct.pack("<IHHI", 54, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, 0, 0, 0, 0, 0)


SIZED = [
    (png(np.zeros((7, 300, 3))), (300, 7)),
    (jpeg(640, 480), (640, 480)),
    (jpeg(65535, 1, segment(0xE0, b"JFIF") + segment(0xE1, b"x" * 60000) + segment(0xDB, b"q" * 65), 0xC2), (65535, 1)),
    (jpeg(5, 6, segment(0xC4, b"huffman tables come first") + b"\xff\xff" + segment(0xFE, b"fill bytes")[1:]), (5, 6)),
    (jpeg(9, 8, b"".join(segment(0xE2, bytes([i % 256])) for i in range(400))), (9, 8)),
    (b"\xff\xd8" + segment(0xE0, b"no frame") + b"\xff\xd9", None),
    (jpeg(640, 480)[:9], None),
    (b"\xff\xd8\xff", None),
    (riff(b"VP8 ", b"\0\0\0\x9d\x01\x2a" + struct.pack("<HH", 1000 | 0x4000, 33) + b"0" * 8), (1000, 33)),
    (riff(b"VP8L", b"\x2f" + struct.pack("<I", 1199 | (799 << 14)) + b"0" * 9), (1200, 800)),
    (riff(b"VP8X", b"\0\0\0\0" + struct.pack("<I", 70000 - 1)[:3] + struct.pack("<I", 12 - 1)[:3] + b"0" * 9), (70000, 12)),
    (riff(b"XXXX", b"0" * 30), None),
    (bmp(31, 17), (31, 17)),
    (bmp(31, -17), (31, 17)),
    (bmp(0, 17), None),
    (b"\x89PNG\r\n\x1a\nxxxxxxx", None),
    (b"plain text that is long enough to hold a header", None),
    (b"", None),
    (None, None),
]


def test_sizes_come_from_headers(spark):
    rows = [(i, None if c is None else bytearray(c)) for i, (c, _) in enumerate(SIZED)]
    df = spark.createDataFrame(rows, "i int, content binary").select("i", images.image_size(F.col("content")).alias("s"))
    assert {r.i: r.s and (r.s.width, r.s.height) for r in df.collect()} == {i: size for i, (_, size) in enumerate(SIZED)}
    codes = images.screen_content(spark.createDataFrame(rows, "i int, content binary"), max_pixels=400_000, max_bytes=10**6, sizes=True)
    assert {r.i: r.screen_code for r in codes.collect() if r.i in (0, 1, 3, 5, 6, 9)} == {0: 200, 1: 200, 3: 200, 5: 400, 6: 400, 9: 413}


@pytest.mark.parametrize(
    ("content", "width", "code"),
    [(b"abc_not_image_content", None, 415), (b"short", None, 400), (b"\xff\xd8\xff" + b"0" * 20, 10, 200), (b"\xff\xd8\xff" + b"0" * 20, None, 400), (b"RIFF0000WEBP" + b"0", 9000, 413), (b"\xff\xd8\xff" + b"0" * 200, 10, 413), (b"", None, 400), (None, None, 400)],
)
def test_screening(spark, content, width, code):
    df = spark.createDataFrame([(content, width, width)], "content binary, width int, height int")
    assert images.screen_content(df, max_bytes=100).first().screen_code == code


def image_rows(spark, tmp_path, pictures):
    """Files read by Spark's image source, by file name."""
    for name, image in pictures.items():
        (tmp_path / name).write_bytes(png(image) if isinstance(image, np.ndarray) else image)
    return spark.read.format("image").load(f"file://{tmp_path}/*.*").select("image.*").withColumn("origin", F.substring_index("origin", "/", -1))


def test_descriptions_and_scores(spark, tmp_path):
    rows = image_rows(spark, tmp_path, {"a.png": picture(3), "b.png": b"junk", **{f"c{i}.png": picture(i, 96) for i in range(9)}})
    got = {r.path: r for r in images.image_quality(images.describe_pixels(rows)).collect()}
    assert (got["a.png"].width, got["a.png"].height) == (48, 48) and got["a.png"].warnings == ["small"] and got["a.png"].phash == images.phash(picture(3)) and got["c0.png"].width == 96

    def model():
        calls = []

        def run(batch):
            calls.append(len(batch))
            return [[(len(batch), 0.5, float(len(calls)), 0.0, float(image.shape[1]), 1.0)] * (image.shape[1] == 96) for image in batch]

        return run

    made = images.score_images(rows.coalesce(1), model, batch=4).collect()
    # ten images in one task: one model, batches of four, four and two
    assert sorted((r.class_id, r.x1) for r in made) == sorted([(4, 1.0)] * sum(r.x1 == 1 for r in made) + [(4, 2.0)] * sum(r.x1 == 2 for r in made) + [(2, 3.0)] * sum(r.x1 == 3 for r in made))
    assert {r.x1 for r in made} == {1.0, 2.0, 3.0} and len(made) == 9 and all(r.pred_idx == 0 and r.x2 == 96.0 for r in made)


def test_descriptions_of_bytes(spark):
    rows = [("a", bytearray(png(picture(3)))), ("b", bytearray(b"junk")), ("c", None), ("d", bytearray(jpeg(70, 80)))]
    df = spark.createDataFrame(rows, "path string, content binary")
    got = {r.path: (r.width, r.height, r.phash) for r in images.describe_images(df).collect()}
    assert got == {"a": (48, 48, None), "b": (None, None, None), "c": (None, None, None), "d": (70, 80, None)}
    shown = picture(3)
    decode = lambda data: shown if data[:2] == b"\xff\xd8" else None
    got = {r.path: (r.width, r.phash, r.sha256 is None) for r in images.describe_images(df, decode).collect()}
    assert got == {"a": (48, None, False), "b": (None, None, False), "c": (None, None, True), "d": (70, images.phash(picture(3)), False)}


def archive(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)


def test_archives(spark, tmp_path):
    archive(tmp_path / "My Set.zip", {"d/x.txt": b"1", "d/empty.txt": b""})
    archive(tmp_path / "bad.zip", {"ok.txt": b"1", "../evil.txt": b"2"})
    (tmp_path / "no.zip").write_bytes(b"nothing")
    rows = archives.read_archives(spark, f"file://{tmp_path}").collect()
    assert {(r.source, r.member, r.error) for r in rows} == {("my_set", "d/x.txt", None), ("my_set", "d/empty.txt", None), ("bad", None, "unsafe_member"), ("no", None, "not_a_zip")}
    with pytest.raises(ValueError, match="more than once"):
        files.check_sources(spark.createDataFrame([("a",), ("a",)], "source string"))
    with pytest.raises(ValueError, match="no sources"):
        files.check_sources(spark.createDataFrame([], "source string"))


def test_archives_are_read_in_slices(spark, tmp_path):
    data = {f"d/f{i}.bin": bytes([i]) * 3000 for i in range(30)}
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_STORED) as z:
        for name, content in data.items():
            z.writestr(name, content)
    raw = bytearray((tmp_path / "big.zip").read_bytes())
    at = raw.index(bytes([7]) * 3000)
    raw[at + 5] ^= 1  # a wrong checksum
    names = {k: [m.start() for m in re.finditer(f"d/f{k}.bin".encode(), raw)] for k in (11, 12)}
    for header, name in ((30, names[11][0]), (46, names[11][1])):
        raw[name - header + (6 if header == 30 else 8)] |= 1  # encrypted
    for header, name in ((30, names[12][0]), (46, names[12][1])):
        raw[name - header + (8 if header == 30 else 10)] = 97  # an unknown way of compression
    (tmp_path / "big.zip").write_bytes(raw)
    df = archives.read_archives(spark, f"file://{tmp_path}/big.zip", slice_bytes=10_000)
    rows = {r.member: r for r in df.collect()}
    odd = {"d/f7.bin": "broken", "d/f11.bin": "encrypted", "d/f12.bin": "unsupported"}
    assert {m: r.error for m, r in rows.items() if r.error} == odd
    assert len(rows) == 30 == df.count() and all(bytes(r.content) == data[m] for m, r in rows.items() if m not in odd)
    assert {r.archive_sha256 for r in rows.values()} == {hashlib.sha256(raw).hexdigest()}
    parts = spark.read.format("zip_members").option("sliceBytes", 10_000).load(f"file://{tmp_path}/big.zip").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 9 and max(r["count"] for r in parts) <= 4


def published(spark, path):
    return sorted(r.split for r in publish.read_published(spark, path).collect())


def test_publishing_keeps_the_old_version_until_the_new_one_is_checked(spark, tmp_path):
    path = f"file://{tmp_path}/set"
    row = lambda split, i, **k: {"split": split, "group_id": f"{split}{i}", "sha256": f"h{split}{i}", "original_key": f"k{split}{i}", "annotation_status": "valid", "is_negative": False, "instances_class_0": 3, "instances_class_1": i, **k}
    schema = "split string, group_id string, sha256 string, original_key string, annotation_status string, is_negative boolean, instances_class_0 int, instances_class_1 int"
    frame = lambda rows: spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    limits = {"min_groups": {"train": 1, "val": 1, "test": 1}, "min_boxes": {}}
    good = [row(s, i, is_negative=i == 2) for s in ("train", "val", "test") for i in range(4)]
    with pytest.raises(ValueError, match="nothing is published"):
        publish.read_published(spark, path)
    made = publish.publish_manifest(frame(good), path, **limits)
    assert published(spark, path) == sorted(r["split"] for r in good)
    # counters of the write are those of a report
    summary = {r.split: r for r in split_summary(publish.read_published(spark, path)).collect()}
    assert made["rows"] == 12 and made["invalid"] == 0
    for s, r in summary.items():
        assert (made[f"{s}_images"], made[f"{s}_negatives"], made[f"{s}_class_0"], made[f"{s}_class_1"]) == (r.images, r.negatives, r.instances_class_0, r.instances_class_1)
    with pytest.raises(ValueError, match="exists"):
        publish.publish_manifest(frame(good[:3]), path, **limits)
    # refused by a check, or stopped before the rename: the old version stays
    with pytest.raises(ValueError, match="leak_group_id"):
        publish.publish_manifest(frame([*good, row("val", 9, group_id="train0")]), path, overwrite=True, **limits)
    with pytest.raises(RuntimeError):
        publish.publish(frame(good[:4]), path, check=lambda df: (_ for _ in ()).throw(RuntimeError("stopped")), overwrite=True)
    assert published(spark, path) == sorted(r["split"] for r in good) and publish.current_version(spark, path) == made["version"]
    assert len(publish.versions(spark, path)) == 3
    other = publish.publish_manifest(frame(good[:9] + [row("test", 8)]), path, overwrite=True, **limits)
    assert len(published(spark, path)) == 10 and len(publish.drop_versions(spark, path)) == 3
    assert publish.versions(spark, path) == [other["version"]] and len(published(spark, path)) == 10


def test_clean_labels_are_read_strictly(spark):
    lines = ["0 0.5 0.5 0.2 0.2", " ", "1 0.1 0.2 0.3", "1 0.1 0.2 0.3 0.4 0.5", "x 0.1 0.2 0.3 0.4", "0.5 1 1 1 1", "1 nan 0 0 0", "1\t0.25 0.5 1e-1 1_0"]
    df = spark.createDataFrame([(1, i + 1, x) for i, x in enumerate(lines)], "image_id long, line_no int, line string")
    got = {r.position: r for r in files.clean_boxes(df).collect()}
    assert {k: r.error for k, r in got.items()} == {1: None, 3: "not_five_numbers", 4: "not_five_numbers", 5: "not_a_number", 6: "class_not_integer", 7: "not_a_number", 8: None}
    assert (got[8].class_id, got[8].x, got[8].w, got[8].h) == (1, 0.25, 0.1, 10.0) and got[3].class_id is None
    files.assert_clean(files.clean_boxes(df.filter("line_no < 3")))
    with pytest.raises(ValueError, match="1:3: not_five_numbers"):
        files.assert_clean(files.clean_boxes(df))


def test_roots_and_listing(spark):
    names = ["r/data.yaml", "r/train/images/a.JPG", "r/valid/images/b.png", "r/test/images/c.gif", "r/test/images/d.rf.1.bmp", "x/train/images/e.jpg"]
    df = spark.createDataFrame([("s", n) for n in names], "source string, path string")
    assert [(r.source, r.root) for r in files.dataset_roots(df).collect()] == [("s", "r")]
    files.check_roots(files.dataset_roots(df))
    listed = {r.path: (r.old_split, r.stem, r.ext, r.original_key) for r in files.image_keys(files.list_images(df)).collect()}
    assert listed["r/test/images/d.rf.1.bmp"] == ("test", "d.rf.1", "bmp", "s:d") and "r/test/images/c.gif" not in listed and len(listed) == 4
    name = files.output_name(F.lit("s"), F.lit("a b/é"), F.lit("0123456789abcdef"), F.lit("JPG"))
    assert spark.range(1).select(name).first()[0] == "s__a_b___0123456789.jpg"


@pytest.mark.parametrize("text", ["names: [A, 'B']\nnc: 2", "nc: 2\nnames:\n- A\n- B\n", "names:\n  0: A\n  1: B\n"])
def test_class_names(text):
    assert files.parse_names(text) == ["A", "B"]


@pytest.mark.parametrize("text", ["names: ['smut, loose', farmer's rot]", "names: {0: 'smut, loose', 1: farmer's rot}\nnc: 2", "names: {1: farmer's rot,\n  0: \"smut, loose\"}"])
def test_flow_class_names(text):
    assert files.parse_names(text) == ["smut, loose", "farmer's rot"]


def test_class_names_need_all_ids():
    with pytest.raises(ValueError):
        files.parse_names("names: {0: A, 2: B}")
    with pytest.raises(ValueError):
        files.parse_names("names:\n  0: A\n  2: B\n")


def test_empty_files_are_kept(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"")
    (tmp_path / "b.txt").write_bytes(b"0 1 2 3 4\n")
    assert {r.path.rsplit("/", 1)[1]: len(r.content) for r in files.binary_files(spark, f"file://{tmp_path}").collect()} == {"a.txt": 0, "b.txt": 10}


def test_curation_end_to_end(spark, tmp_path):
    rows = []
    for i in range(40):
        split = ("train", "valid", "test")[i % 3]
        image = png(picture(i if i != 7 else 6))
        rows.append(("s", f"r/{split}/images/im{i}.png", bytearray(image)))
        if i == 9:
            continue  # no label file: invalid
        text = "" if i == 10 else "0 0.5 abc 0.2 0.2" if i == 11 else f"{i % 2} 0.35 0.45 0.3 0.5\n7 0.5 0.5 0.1 0.1"
        if i == 7:
            text = "0 0.35 0.45 0.3 0.5\n7 0.5 0.5 0.1 0.1"  # same bytes and boxes as 6
        rows.append(("s", f"r/{split}/labels/im{i}.txt", bytearray(text.encode())))
    rows.append(("s", "r/train/images/broken.png", bytearray(b"\x89PNG\r\n\x1a\nxxxxxxx")))
    rows.append(("s", "r/train/labels/broken.txt", bytearray(b"0 0.5 0.5 0.2 0.2")))
    df = spark.createDataFrame(rows, "source string, path string, content binary")
    classes = class_map(spark, {"s": ["Bacterial Leaf Blight", "brown spot"]}, ["Bacterial_Leaf_Blight", "Brown_Spot"])
    out = curate(df, classes)
    manifest = out["manifest"]
    assert manifest.count() == 40 - 2 - 1 and out["duplicates"].count() == 1 and out["quarantine"].count() == 2 and out["corrupt"].count() == 1 and out["conflicts"].count() == 0
    assert {r.split for r in manifest.collect()} == {"train", "val", "test"}
    negative = manifest.filter("is_negative").collect()
    assert len(negative) == 1 and negative[0].annotation_status == "negative"
    limits = {"min_groups": {"train": 1, "val": 1, "test": 1}, "min_boxes": {"val": 0, "test": 0}}
    sinks.write_manifest(manifest, f"file://{tmp_path}/m", **limits)
    with pytest.raises(Exception, match="exist"):
        sinks.write_manifest(manifest, f"file://{tmp_path}/m", **limits)
    back = files.read_manifest(spark, f"file://{tmp_path}/m", "train")
    assert back.count() == manifest.filter("split = 'train'").count()
    sinks.write_curated(out["curated"], f"file://{tmp_path}/c")
    texts = {r.label_text for r in spark.read.parquet(f"file://{tmp_path}/c").collect()}
    assert texts == {"", "0 0.350000 0.450000 0.300000 0.500000", "1 0.350000 0.450000 0.300000 0.500000"}
    report = sinks.report(manifest.groupBy("split").count(), out["report"])
    sinks.write_json(report, f"file://{tmp_path}/r")
    assert files.read_report(spark, f"file://{tmp_path}/r").first().collection.scanned == 41


def test_curation_of_jpeg_with_pixels_and_source_order(spark, tmp_path):
    rows, pictures = [], {}
    for i in range(12):
        source = "zeta" if i < 6 else "alpha"
        # images 3 and 9 have equal bytes and boxes; 4 and 5 look alike
        k = 3 if i == 9 else i
        rows.append((source, f"{('train', 'valid', 'test')[i % 3]}/images/im{i}.jpg", bytearray(jpeg(100 + k, 80))))
        rows.append((source, f"{('train', 'valid', 'test')[i % 3]}/labels/im{i}.txt", bytearray(b"0 0.5 0.5 0.2 0.2")))
        pictures[rows[-2][1]] = picture(4 if k == 5 else k)
    (tmp_path / "p").mkdir()
    seen = image_rows(spark, tmp_path / "p", {f"{i}.png": image for i, image in enumerate(pictures.values())})
    names = spark.createDataFrame([(f"{i}.png", path) for i, path in enumerate(pictures)], "origin string, path string")
    seen = seen.join(names, "origin").drop("origin").withColumnRenamed("path", "origin")
    df = spark.createDataFrame(rows, "source string, path string, content binary")
    classes = class_map(spark, {s: ["Bacterial Leaf Blight", "brown spot"] for s in ("zeta", "alpha")}, ["Bacterial_Leaf_Blight", "Brown_Spot"])
    for order, kept in ((("zeta", "alpha"), "im3"), ((), "im9")):
        out = curate(df, classes, pixels=seen, source_order=order)
        manifest = {r.source_image: r for r in out["manifest"].collect()}
        assert len(manifest) == 11 and out["corrupt"].count() == 0 and out["duplicates"].count() == 1
        assert {p.split("/")[-1][:-4] for p in manifest} & {"im3", "im9"} == {kept}
        assert {r.width for r in manifest.values()} == {100 + i for i in range(12) if i != 9}
        group = {p.split("/")[-1][:-4]: r.group_id for p, r in manifest.items()}
        assert group["im4"] == group["im5"] and len(set(group.values())) == 10
        first = min(group.values())
        assert (first == group["im0"]) == bool(order)


def test_conflict_list(spark):
    conflicts = spark.createDataFrame([("h",)], "sha256 string")
    paths = spark.createDataFrame([("h", 2, "b"), ("h", 1, "a"), ("i", 3, "c")], "sha256 string, ord long, path string")
    assert sorted(tuple(r) for r in sinks.conflict_rows(conflicts, paths).collect()) == [("h", "label_conflict", 1, "a"), ("h", "label_conflict", 2, "b")]
    assert [tuple(r) for r in sinks.conflict_list(conflicts, paths).collect()] == [("h", "label_conflict", "a; b")]


def test_diagnose_and_evaluate(spark):
    boxes = spark.createDataFrame([(1, 1, 0, 0.5, 0.5, 0.2, 0.2)], "image_id long, position int, class_id int, x double, y double, w double, h double")
    sizes = spark.createDataFrame([(1, 100, 100)], "image_id long, width int, height int")
    truth = files.pixel_truth(boxes, sizes)
    pred = spark.createDataFrame([(1, 0, 0, 0.9, 40.0, 40.0, 60.0, 60.0)], "image_id long, pred_idx int, class_id int, confidence double, x1 double, y1 double, x2 double, y2 double")
    out = diagnose(truth, pred, sizes)
    assert out["errors"].count() == 0 and out["counts"].first().tp == 1
    assert {r["size"]: r.recalled for r in out["recall"].collect()} == {"small": 1, "medium": 0, "large": 0}
    assert evaluate(truth, pred)["overall"].first().map50 == pytest.approx(1.0)


def test_screening_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jpg").write_bytes(b"\xff\xd8\xff" + b"0" * 20)
    (tmp_path / "in" / "b.txt").write_bytes(b"plain text that is long")
    q = screened_stream(spark, f"file://{tmp_path}/in").select("screen_code").writeStream.format("memory").queryName("screened").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r[0] for r in spark.sql("SELECT * FROM screened").collect()) == [200, 415]
