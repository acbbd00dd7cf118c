"""Sources: directory trees, label files, class lists, manifests. Archives: ``archives``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import Row

from labelloom.functions.labels import NUMBER, SPACES, split_lines
from labelloom.schemas import IMAGE_SUFFIXES, MANIFEST, SPLIT_DIRS


def source_name(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, "[^A-Za-z0-9_-]+", "_"))


def check_sources(names: DataFrame, col: str = "source") -> None:
    """Raise if two sources share a name, or there is none."""
    twice = names.groupBy(col).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"source name {twice[0][col]} occurs more than once")
    if names.isEmpty():
        raise ValueError("no sources")


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of all files under ``path``, empty ones too (DataFrame sources skip those)."""
    pairs = spark.sparkContext.binaryFiles(path).map(lambda kv: Row(path=kv[0], content=bytearray(kv[1])))
    return spark.createDataFrame(pairs, "path string, content binary")


def dataset_roots(paths: DataFrame, col: str = "path") -> DataFrame:
    """(source, root) of directories that hold data.yaml, train/images, valid or val/images and test/images.

    ``paths`` has ``source`` and a path column.
    """
    yaml = F.regexp_extract(col, "^(.*?)/?data\\.yaml$", 1)
    split = F.regexp_extract(col, "^(.*?)/?(train|valid|val|test)/images/[^/]+$", 2)
    root = F.when(F.col(col).rlike("(^|/)data\\.yaml$"), yaml).when(split != "", F.regexp_extract(col, "^(.*?)/?(train|valid|val|test)/images/[^/]+$", 1))
    rows = paths.select("source", root.alias("root"), split.alias("split"), F.col(col).rlike("(^|/)data\\.yaml$").alias("yaml")).filter(F.col("root").isNotNull())
    found = rows.groupBy("source", "root").agg(F.bool_or("yaml").alias("y"), *[F.bool_or(F.col("split").isin(*s)).alias(n) for n, s in (("a", ["train"]), ("b", ["valid", "val"]), ("c", ["test"]))])
    return found.filter("y AND a AND b AND c").select("source", "root")


def check_roots(roots: DataFrame) -> None:
    """Raise unless every source has exactly one dataset root."""
    odd = roots.groupBy("source").count().filter("count <> 1").limit(1).collect()
    if odd:
        raise ValueError(f"source {odd[0]['source']} has {odd[0]['count']} dataset roots")
    if roots.isEmpty():
        raise ValueError("no dataset root")


def parts(paths: DataFrame, kind: str, suffixes: tuple[str, ...], col: str = "path") -> DataFrame:
    """``paths`` of a kind (images or labels) with old_split, stem and ext."""
    pattern = f"(?:^|/)({'|'.join(SPLIT_DIRS)})/{kind}/([^/]+)\\.([A-Za-z0-9]+)$"
    out = paths.filter(F.col(col).rlike(pattern))
    out = out.withColumn("old_split", F.regexp_extract(col, pattern, 1)).withColumn("stem", F.regexp_extract(col, pattern, 2)).withColumn("ext", F.lower(F.regexp_extract(col, pattern, 3)))
    return out.filter(F.col("ext").isin(*suffixes))


def list_images(paths: DataFrame, col: str = "path") -> DataFrame:
    """Image files with old_split, stem, ext, and the columns that order a scan: split_ord, path."""
    order = F.array_position(F.array(*[F.lit(s) for s in SPLIT_DIRS]), F.col("old_split"))
    return parts(paths, "images", IMAGE_SUFFIXES, col).withColumn("split_ord", order.cast("int"))


def image_keys(images: DataFrame) -> DataFrame:
    """``images`` with image_id and original_key (the stem before ``.rf.``)."""
    return images.withColumn("image_id", F.concat_ws("__", "source", "stem")).withColumn("original_key", F.concat_ws(":", "source", F.substring_index("stem", ".rf.", 1)))


def output_name(source: Column, stem: Column, sha256: Column, ext: Column) -> Column:
    safe = F.substring(F.regexp_replace(stem, "[^A-Za-z0-9_-]+", "_"), 1, 90)
    return F.concat(F.concat_ws("__", source, safe, F.substring(sha256, 1, 10)), F.lit("."), F.lower(ext))


def label_lines(files: DataFrame, content_col: str = "content") -> DataFrame:
    """``files`` of label texts, a row per line: ``line_no`` from 1 and ``line``; empty files have none."""
    text = F.decode(F.col(content_col), "UTF-8")
    rows = files.filter(F.octet_length(content_col) > 0).select(*[c for c in files.columns if c != content_col], F.posexplode(split_lines(text)).alias("__p", "line"))
    return rows.withColumn("line_no", (F.col("__p") + 1).cast("int")).drop("__p")


def class_names(files: DataFrame, content_col: str = "content") -> dict[str, list[str]]:
    """Class list of each source from the ``names`` entry of its data.yaml (one small file a source).

    Takes a list or a mapping with keys from 0 without gaps, in flow or block form; quoted names may hold commas.
    """
    out = {}
    for r in files.select("source", F.decode(F.col(content_col), "UTF-8").alias("text")).collect():
        out[r["source"]] = parse_names(r["text"])
    return out


def parse_names(text: str) -> list[str]:
    import re

    m = re.search(r"^names[ \t]*:[ \t]*(.*)$", text, re.M)
    if not m:
        raise ValueError("no names entry")
    bare = lambda s: s.strip().strip("'\"")
    flow = re.match(r"""[\[{]((?:(?<!\w)(?:'[^']*'|"[^"]*")|[^\]}])*+)[\]}]""", text[m.start(1) :])
    names: dict[int, str] = {}
    if m[1].startswith(("[", "{")):
        if not flow:
            raise ValueError("names entry does not end")
        # commas inside quotes belong to a name
        for item in re.findall(r"""(?:(?<!\w)(?:'[^']*'|"[^"]*")|[^,])++""", flow[1]):
            keyed = re.fullmatch(r"\s*['\"]?(\d+)['\"]?\s*:\s*(.*)", item, re.S) if m[1].startswith("{") else None
            if keyed:
                names[int(keyed[1])] = bare(keyed[2])
            elif item.strip():
                names[len(names)] = bare(item)
        if m[1].startswith("["):
            return list(names.values())
    for line in [] if flow else text[m.end() :].splitlines():
        item = re.fullmatch(r"\s*-\s+(.*)", line)
        keyed = re.fullmatch(r"\s+['\"]?(\d+)['\"]?\s*:\s*(.*)", line)
        if item:
            names[len(names)] = bare(item[1])
        elif keyed:
            names[int(keyed[1])] = bare(keyed[2])
        elif line.strip() and not line.strip().startswith("#"):
            break
    if sorted(names) != list(range(len(names))) or not names:
        raise ValueError("class ids must count from 0 without gaps")
    return [names[i] for i in range(len(names))]


def read_manifest(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A manifest written by ``sinks.write_manifest``; one split is a pruned partition."""
    df = spark.read.schema(MANIFEST).parquet(path)
    return df if split is None else df.filter(F.col("split") == split)


def read_manifest_csv(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.schema(MANIFEST).option("header", True).csv(path)
    return df if split is None else df.filter(F.col("split") == split)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def clean_boxes(lines: DataFrame, keep: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """(keep, position, class_id, x, y, w, h, error) of the lines (``line_no``, ``line``) of clean label files.

    Strict: a line that isn't blank has exactly five numbers, the first an integer; any other one is a row with
    ``error`` and nulls. ``assert_clean`` raises on the first of these.
    """
    text = F.regexp_replace("line", f"^{SPACES}|{SPACES}$", "")
    rows = lines.withColumn("__t", F.split(text, SPACES)).filter(text != "")
    numbers = F.transform("__t", lambda t: F.when(t.rlike(NUMBER), F.replace(t, F.lit("_"), F.lit("")).try_cast("double")))
    rows = rows.withColumn("__v", numbers)
    first = F.get("__v", F.lit(0))
    error = (
        F.when(F.size("__t") != 5, "not_five_numbers")
        .when(F.exists("__v", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))), "not_a_number")
        .when(first != F.floor(first).cast("double"), "class_not_integer")
    )
    rows = rows.withColumn("error", error)
    value = lambda i: F.when(F.col("error").isNull(), F.get("__v", F.lit(i)))
    return rows.select(*keep, F.col("line_no").alias("position"), value(0).try_cast("int").alias("class_id"), *[value(i + 1).alias(c) for i, c in enumerate(("x", "y", "w", "h"))], "error")


def assert_clean(boxes: DataFrame, keep: tuple[str, ...] = ("image_id",)) -> None:
    """Raise on the first row of ``clean_boxes`` with an error."""
    first = boxes.filter("error IS NOT NULL").orderBy(*keep, "position").limit(1).collect()
    if first:
        raise ValueError(f"{'/'.join(str(first[0][k]) for k in keep)}:{first[0]['position']}: {first[0]['error']}")


def pixel_truth(boxes: DataFrame, sizes: DataFrame, id_col: str = "image_id") -> DataFrame:
    """Clean label boxes as pixel corners: image_id, gt_idx, class_id, corners, confidence 1.

    boxes: image_id, position, class_id, x, y, w, h. sizes: image_id, width, height.
    """
    from labelloom.functions.boxes import CORNERS, corners

    c = [F.col(k) for k in ("x", "y", "w", "h", "width", "height")]
    rows = boxes.join(sizes.select(id_col, "width", "height"), id_col)
    return rows.select(id_col, F.col("position").cast("int").alias("gt_idx"), "class_id", *[v.alias(k) for k, v in zip(CORNERS, corners(*c), strict=True)], F.lit(1.0).alias("confidence"))
