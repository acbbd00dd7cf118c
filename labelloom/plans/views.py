"""Views that turn the given tables into label lines, truths, detections, hashes and images.

The SQL runs unchanged in Spark and in other engines; Spark reads the tables it names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions.boxes import median_bits
from labelloom.session import table

NUMBERED = "l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS line_no FROM lineitem)"
COPIES = "(SELECT 0 AS copy_no UNION ALL SELECT 1 AS copy_no) k"

LABEL_LINES = f"""
WITH {NUMBERED}, c AS (
  SELECT l_orderkey AS image_id, concat('src', CAST(l_orderkey % 3 AS STRING)) AS source, CAST(line_no * 2 + copy_no AS INT) AS line_no,
    l_partkey, CAST(l_suppkey % 2 AS STRING) AS cls,
    concat('0.', lpad(CAST((l_partkey * 7) % 1000 AS STRING), 3, '0')) AS x,
    concat('0.', lpad(CAST((l_suppkey * 13) % 1000 AS STRING), 3, '0')) AS y,
    concat('0.', lpad(CAST(CAST(l_quantity AS INT) * 9 AS STRING), 3, '0')) AS w,
    concat('0.', lpad(CAST(l_linenumber * 40 AS STRING), 3, '0')) AS h
  FROM l CROSS JOIN {COPIES} WHERE l_orderkey % 10 <> 0 AND (copy_no = 0 OR l_suppkey % 23 = 0))
SELECT image_id, source, line_no, CASE
  WHEN l_partkey % 29 = 0 THEN concat(cls, ' ', x, ' abc ', w, ' ', h)
  WHEN l_partkey % 31 = 0 THEN concat(cls, ' ', x, ' 1.5 ', w, ' ', h)
  WHEN l_partkey % 37 = 0 THEN concat('7 ', x, ' ', y, ' ', w, ' ', h)
  WHEN l_partkey % 41 = 0 THEN concat(cls, ' ', x, ' ', y, ' ', w)
  WHEN l_partkey % 5 = 0 THEN concat(cls, ' ', x, ' ', y, ' ', w, ' ', y, ' ', w, ' ', h, ' ', x, ' ', h)
  ELSE concat(cls, ' ', x, ' ', y, ' ', w, ' ', h) END AS line
FROM c"""

CORNERED = f"""{NUMBERED}, b AS (SELECT l_orderkey AS image_id, line_no, l_partkey, l_suppkey, CAST(l_suppkey % 2 AS INT) AS class_id,
    (l_partkey * 7) % 400 AS x1, (l_suppkey * 13) % 400 AS y1,
    (l_partkey * 7) % 400 + 30 + 4 * CAST(l_quantity AS INT) AS x2, (l_suppkey * 13) % 400 + 30 + 25 * l_linenumber AS y2 FROM l)"""

TRUTH = f"""
WITH {CORNERED}
SELECT image_id, CAST(line_no AS INT) AS gt_idx, class_id, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2
FROM b WHERE l_suppkey % 17 <> 0"""

DETECTIONS = f"""
WITH {CORNERED}, r AS (SELECT b.*, k.copy_no FROM b CROSS JOIN {COPIES} WHERE l_partkey % 19 <> 0 AND (copy_no = 0 OR l_suppkey % 23 = 0))
SELECT image_id, CAST(line_no * 2 + copy_no AS INT) AS pred_idx,
  CASE WHEN l_partkey % 13 = 0 THEN 1 - class_id ELSE class_id END AS class_id,
  CAST((l_partkey * 31 + l_suppkey * 17 + copy_no * 7) % 1000 AS DOUBLE) / 1000.0 AS confidence,
  CAST(x1 + (l_partkey % 11) * 4 AS DOUBLE) AS x1, CAST(y1 + (l_suppkey % 7) * 3 AS DOUBLE) AS y1,
  CAST(x2 + (l_partkey % 11) * 4 AS DOUBLE) AS x2, CAST(y2 + (l_suppkey % 7) * 3 AS DOUBLE) AS y2
FROM r"""

PACKED = "SELECT p_partkey AS id, CAST(p_size AS BIGINT) + 64 * (p_partkey % 8) + 512 * CAST(length(p_type) AS BIGINT) + 16384 * CAST(length(p_name) AS BIGINT) AS h FROM part"


def view(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    return spark.sql(sql.replace(f"FROM {name}", f"FROM {{{name}}}"), **{name: table(spark, sf_dir, name)})


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, LABEL_LINES, "lineitem")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, TRUTH, "lineitem")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, DETECTIONS, "lineitem")


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, PACKED, "part")


def signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, h): median-bit hashes of the embeddings."""
    return table(spark, sf_dir, "embeddings").select("vec_id", median_bits(F.col("embedding")).alias("h"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as images (the greatest line of the whole text names the original): ord, sha256, original_key, source, signature, instances_class_N, hash, is_negative."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    hashes = signatures(spark, sf_dir).select(F.col("vec_id").alias("doc_id"), F.col("h").alias("hash"))
    count = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long"))
    rows = docs.select("doc_id", F.sha2("text", 256).alias("sha256"), F.sha2(F.array_max(F.split("text", "\n")), 256).alias("original_key"), "source").join(labels, "doc_id", "left").join(hashes, "doc_id", "left")
    signature = F.when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), F.concat_ws(",", F.col("quality").cast("string"), F.col("toxic").cast("string")))
    return rows.select(F.col("doc_id").alias("ord"), "sha256", "original_key", "source", signature.alias("signature"), count("quality").alias("instances_class_0"), count("toxic").alias("instances_class_1"), "hash", ((count("quality") + count("toxic")) == 0).alias("is_negative"))


def image_sizes(truth_or_pred: DataFrame) -> DataFrame:
    """All images of the views are 640 x 640."""
    return truth_or_pred.select("image_id").distinct().select("image_id", F.lit(640).alias("width"), F.lit(640).alias("height"))


def class_map(spark: SparkSession) -> DataFrame:
    """Classes 0 and 1 of every source of the label lines."""
    return spark.createDataFrame([(f"src{s}", float(c), c) for s in range(3) for c in (0, 1)], "source string, old_id double, class_id int")
