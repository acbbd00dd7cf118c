"""Registered queries over the given tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions import images as image_functions
from labelloom.functions.boxes import hamming
from labelloom.functions.labels import canonical_class, dedup_boxes, micro, parse_labels
from labelloom.operators import checks, dedup, detections, matching, metrics, similarity, splits, status
from labelloom.plans import views
from labelloom.session import table, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def scaled(c: Column, by: float = 1e4) -> Column:
    """A ratio as an integer, half up, so that engines agree."""
    return F.floor(c * F.lit(by) + F.lit(0.5)).cast("long")


def q4(x: str) -> str:
    return f"CAST(floor(({x}) * 1e4 + 0.5) AS BIGINT)"


def q6(x: str) -> str:
    return f"CAST(floor(({x}) * 1e6 + 0.5) AS BIGINT)"


# -- labels -----------------------------------------------------------------------------------------------

PARSED = f"""
label_lines AS ({views.LABEL_LINES}),
t AS (SELECT *, regexp_split_to_array(trim(line), '\\s+') AS t FROM label_lines),
v AS (SELECT *, list_transform(t, lambda s: TRY_CAST(s AS DOUBLE)) AS v FROM t),
c AS (SELECT *, v[1] AS raw, v[2:] AS co, CASE WHEN v[1] IN (0.0, 1.0) THEN CAST(v[1] AS INT) END AS cls,
  len(list_filter(v, lambda s: s IS NULL)) > 0 AS bad, coalesce(v[1] = floor(v[1]), FALSE) AS int_class FROM v),
k AS (SELECT *, list_transform(co, lambda s: least(1.0, greatest(0.0, s))) AS cl, len(co) AS n FROM c),
p AS (SELECT *, [cl[i] FOR i IN range(1, n + 1) IF i % 2 = 1] AS xs, [cl[i] FOR i IN range(1, n + 1) IF i % 2 = 0] AS ys FROM k),
b AS (SELECT *, n >= 6 AND n % 2 = 0 AS poly,
  CASE WHEN n = 4 THEN cl[1] WHEN n >= 6 AND n % 2 = 0 THEN (list_min(xs) + list_max(xs)) / 2 END AS bx,
  CASE WHEN n = 4 THEN cl[2] WHEN n >= 6 AND n % 2 = 0 THEN (list_min(ys) + list_max(ys)) / 2 END AS by_,
  CASE WHEN n = 4 THEN cl[3] WHEN n >= 6 AND n % 2 = 0 THEN list_max(xs) - list_min(xs) END AS bw,
  CASE WHEN n = 4 THEN cl[4] WHEN n >= 6 AND n % 2 = 0 THEN list_max(ys) - list_min(ys) END AS bh FROM p),
e AS (SELECT *, greatest(0.0, bx - bw / 2) AS x0, least(1.0, bx + bw / 2) AS x1, greatest(0.0, by_ - bh / 2) AS y0, least(1.0, by_ + bh / 2) AS y1 FROM b),
parsed AS (SELECT image_id, source, line_no, line, cls, bad, int_class AND cls IS NULL AS out_of_scope,
  CASE WHEN bad THEN 'not_a_number' WHEN NOT int_class THEN 'class_not_integer' WHEN cls IS NULL THEN NULL WHEN n = 0 THEN 'bad_coordinates'
    WHEN len(list_filter(co, lambda s: s < -1e-6 OR s > 1 + 1e-6)) > 0 THEN 'out_of_range' WHEN n <> 4 AND NOT poly THEN 'bad_shape'
    WHEN bw <= 0 OR bh <= 0 THEN 'no_size' WHEN x1 <= x0 OR y1 <= y0 THEN 'outside' END AS error_code,
  (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y, x1 - x0 AS w, y1 - y0 AS h, bx, by_, bw, bh, n FROM e),
lines AS (SELECT image_id, source, line_no, line, error_code, out_of_scope,
  CASE WHEN error_code IS NULL AND NOT bad THEN cls END AS class_id,
  CASE WHEN error_code IS NULL AND NOT bad AND cls IS NOT NULL THEN x END AS x, CASE WHEN error_code IS NULL AND NOT bad AND cls IS NOT NULL THEN y END AS y,
  CASE WHEN error_code IS NULL AND NOT bad AND cls IS NOT NULL THEN w END AS w, CASE WHEN error_code IS NULL AND NOT bad AND cls IS NOT NULL THEN h END AS h,
  CASE WHEN error_code IS NULL AND NOT bad AND cls IS NOT NULL THEN concat(CASE WHEN n = 4 THEN 'bbox' ELSE 'polygon_to_bbox' END,
    CASE WHEN abs(x - bx) <= 1e-9 * greatest(abs(x), abs(bx)) AND abs(y - by_) <= 1e-9 * greatest(abs(y), abs(by_))
      AND abs(w - bw) <= 1e-9 * greatest(abs(w), abs(bw)) AND abs(h - bh) <= 1e-9 * greatest(abs(h), abs(bh)) THEN '' ELSE '_clipped' END) END AS source_type FROM parsed)"""

BOXES = f"""{PARSED},
keyed AS (SELECT *, {q6('x')} AS kx, {q6('y')} AS ky, {q6('w')} AS kw, {q6('h')} AS kh FROM lines WHERE class_id IS NOT NULL),
boxes AS (SELECT * FROM (SELECT *, min(line_no) OVER (PARTITION BY image_id, class_id, kx, ky, kw, kh) AS position,
  row_number() OVER (PARTITION BY image_id, class_id, kx, ky, kw, kh ORDER BY line_no DESC) AS r FROM keyed) WHERE r = 1)"""

STATUS = f"""{BOXES},
per AS (SELECT image_id, count(class_id) AS n_parsed, count(error_code) AS n_errors, count(*) FILTER (out_of_scope) AS n_out_of_scope,
  count(*) FILTER (source_type LIKE '%clipped') AS n_clipped, count(*) FILTER (source_type LIKE 'bbox%') AS n_bbox, count(*) FILTER (source_type LIKE 'polygon%') AS n_polygon FROM lines GROUP BY 1),
kept AS (SELECT image_id, count(*) AS n_boxes FROM boxes GROUP BY 1),
status AS (SELECT o.o_orderkey AS image_id, per.image_id IS NULL AS missing_label, coalesce(n_boxes, 0) AS n_boxes, coalesce(n_errors, 0) AS n_errors, coalesce(n_parsed, 0) - coalesce(n_boxes, 0) AS n_duplicates,
  coalesce(n_out_of_scope, 0) AS n_out_of_scope, coalesce(n_clipped, 0) AS n_clipped, coalesce(n_bbox, 0) AS n_bbox, coalesce(n_polygon, 0) AS n_polygon,
  CASE WHEN per.image_id IS NULL OR n_errors > 0 THEN 'invalid' WHEN coalesce(n_boxes, 0) > 0 THEN 'valid' ELSE 'negative' END AS status
  FROM orders o LEFT JOIN per ON o.o_orderkey = per.image_id LEFT JOIN kept ON o.o_orderkey = kept.image_id)"""


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_labels(views.label_lines(spark, sf_dir), views.class_map(spark))


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"))
    return status.image_status(orders, parsed(spark, sf_dir))


@query(f"WITH {PARSED} SELECT image_id, source, line_no, class_id, {q6('x')} AS x6, {q6('y')} AS y6, {q6('w')} AS w6, {q6('h')} AS h6, source_type, error_code, out_of_scope FROM lines")
def label_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = [micro(F.col(c)).alias(f"{c}6") for c in ("x", "y", "w", "h")]
    return parsed(spark, sf_dir).select("image_id", "source", "line_no", "class_id", *boxes, "source_type", "error_code", "out_of_scope")


@query(f"WITH {PARSED} SELECT source, error_code, count(*) AS n FROM lines WHERE error_code IS NOT NULL GROUP BY 1, 2")
def label_errors_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).filter("error_code IS NOT NULL").groupBy("source", "error_code").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {BOXES} SELECT image_id, position, class_id, kx AS x6, ky AS y6, kw AS w6, kh AS h6, source_type FROM boxes")
def label_box_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_boxes(parsed(spark, sf_dir))
    return out.select("image_id", "position", "class_id", *[micro(F.col(c)).alias(f"{c}6") for c in ("x", "y", "w", "h")], "source_type")


@query(f"WITH {PARSED} SELECT source, count(*) FILTER (out_of_scope) AS n_out_of_scope, count(*) FILTER (out_of_scope AND error_code IS NOT NULL) AS n_with_error FROM lines GROUP BY 1")
def label_out_of_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).groupBy("source").agg(F.count_if("out_of_scope").alias("n_out_of_scope"), F.count_if(F.col("out_of_scope") & F.col("error_code").isNotNull()).alias("n_with_error"))


@query(f"WITH {STATUS} SELECT * FROM status")
def image_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statuses(spark, sf_dir)


@query(f"WITH {STATUS} SELECT count(*) AS scanned, count(*) FILTER (status = 'valid') AS valid, count(*) FILTER (status = 'negative') AS negative, count(*) FILTER (status = 'invalid') AS invalid, count(*) FILTER (missing_label) AS missing, CAST(sum(n_clipped) AS BIGINT) AS n_clipped, CAST(sum(n_bbox) AS BIGINT) AS n_bbox, CAST(sum(n_polygon) AS BIGINT) AS n_polygon, CAST(sum(n_duplicates) AS BIGINT) AS n_duplicates FROM status")
def collection_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.collection_report(statuses(spark, sf_dir))


@query(f"WITH {STATUS} SELECT status, missing_label, count(*) AS n FROM status WHERE status = 'invalid' GROUP BY 1, 2")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.split_quarantine(statuses(spark, sf_dir))[1].groupBy("status", "missing_label").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {BOXES} SELECT o_orderkey AS image_id, count(*) FILTER (class_id = 0) AS instances_class_0, count(*) FILTER (class_id = 1) AS instances_class_1 FROM orders LEFT JOIN boxes ON o_orderkey = image_id GROUP BY 1")
def boxes_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"))
    return status.boxes_per_class(orders, dedup_boxes(parsed(spark, sf_dir)))


ALIASED = "CASE p_partkey % 5 WHEN 0 THEN 'Bacterial Leaf Blight' WHEN 1 THEN 'bacterial  leafblight!' WHEN 2 THEN 'Brown-Spot' WHEN 3 THEN 'brown_spot' ELSE p_name END"


@query(f"SELECT p_partkey, CASE trim(regexp_replace(lower({ALIASED}), '[^a-z0-9]+', ' ', 'g')) WHEN 'bacterial leaf blight' THEN 'Bacterial_Leaf_Blight' WHEN 'bacterial leafblight' THEN 'Bacterial_Leaf_Blight' WHEN 'brown spot' THEN 'Brown_Spot' WHEN 'brownspot' THEN 'Brown_Spot' END AS canonical FROM part")
def class_name_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", canonical_class(F.expr(ALIASED)).alias("canonical"))


# -- duplicates and groups ----------------------------------------------------------------------------------

BITS = """sig AS (SELECT vec_id, array_to_string(list_transform(embedding, lambda v: CASE WHEN CAST(v AS DOUBLE) > med THEN '1' ELSE '0' END), '') AS bits
  FROM (SELECT vec_id, embedding, (CAST(list_sort(embedding)[32] AS DOUBLE) + CAST(list_sort(embedding)[33] AS DOUBLE)) / 2 AS med FROM embeddings))"""
IMAGES = f"""{BITS},
imgs AS (SELECT d.doc_id AS ord, sha256(text) AS sha256, sha256(list_max(string_split(text, chr(10)))) AS original_key, source, CASE WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN concat_ws(',', quality, toxic) END AS signature,
  CAST(coalesce(quality, 0) AS BIGINT) AS c0, CAST(coalesce(toxic, 0) AS BIGINT) AS c1, bits FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN sig ON d.doc_id = vec_id),
per AS (SELECT sha256, count(DISTINCT coalesce(signature, '')) AS signatures, count(*) AS members, min(ord) AS first FROM imgs GROUP BY 1),
uniq AS (SELECT i.* FROM imgs i JOIN per p ON i.sha256 = p.sha256 AND i.ord = p.first WHERE signatures = 1)"""
GROUPS = f"""{IMAGES},
edges AS (SELECT a.ord AS a, b.ord AS b FROM uniq a JOIN uniq b ON a.original_key = b.original_key AND a.original_key <> '' AND a.ord <> b.ord
  UNION SELECT a.ord, b.ord FROM uniq a JOIN uniq b ON a.ord <> b.ord AND a.bits IS NOT NULL AND b.bits IS NOT NULL AND hamming(a.bits, b.bits) <= {{d}}),
reach AS (SELECT ord AS id, ord AS label FROM uniq UNION SELECT e.b, r.label FROM reach r JOIN edges e ON e.a = r.id),
grouped AS (SELECT id AS ord, min(label) AS group_ord FROM reach GROUP BY 1)"""


@query(f"WITH {IMAGES} SELECT ord, sha256, original_key, source FROM uniq")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(views.images(spark, sf_dir))[0].select("ord", "sha256", "original_key", "source")


@query(f"WITH {IMAGES} SELECT p.sha256, members, signatures, string_agg(CAST(ord AS VARCHAR), ';' ORDER BY ord) AS ids FROM per p JOIN imgs i ON p.sha256 = i.sha256 WHERE signatures > 1 GROUP BY 1, 2, 3")
def label_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    clash = dedup.exact_dedup(views.images(spark, sf_dir))[1]
    return clash.select("sha256", "members", "signatures", F.array_join(F.transform("ids", lambda i: i.cast("string")), ";").alias("ids"))


@query(f"WITH {IMAGES} SELECT CAST(sum(members - 1) AS BIGINT) AS removed, count(*) AS kept FROM per WHERE signatures = 1")
def duplicates_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = views.images(spark, sf_dir).groupBy("sha256").agg(F.countDistinct(F.coalesce("signature", F.lit(""))).alias("s"), F.count(F.lit(1)).alias("n"))
    return per.filter("s = 1").agg(F.sum(F.col("n") - 1).alias("removed"), F.count(F.lit(1)).alias("kept"))


PAIRS = "SELECT a.vec_id AS a, b.vec_id AS b, CAST(hamming(a.bits, b.bits) AS INT) AS distance FROM n a JOIN n b ON a.vec_id < b.vec_id AND hamming(a.bits, b.bits) <= 16"


@query(f"WITH {BITS}, n AS (SELECT bits, min(vec_id) AS vec_id FROM sig GROUP BY 1) {PAIRS}")
def hamming_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.hamming_pairs(views.signatures(spark, sf_dir), "vec_id", "h", 16)


@query(f"WITH packed AS ({views.PACKED}), n AS (SELECT h, min(id) AS id FROM packed GROUP BY 1) SELECT a.id AS a, b.id AS b, CAST(bit_count(xor(a.h, b.h)) AS INT) AS distance FROM n a JOIN n b ON a.id < b.id AND bit_count(xor(a.h, b.h)) <= 2")
def hamming_pairs_banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.hamming_pairs(views.packed(spark, sf_dir), "id", "h", 2)


@query(f"WITH RECURSIVE {GROUPS.format(d=16)} SELECT ord, group_ord, printf('group_%06d', group_ord) AS group_id FROM grouped")
def variant_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique = written(dedup.exact_dedup(views.images(spark, sf_dir))[0], "unique")
    return dedup.variant_groups(unique, "ord", "original_key", "hash", 16).select("ord", "group_ord", "group_id")


@query(f"WITH RECURSIVE {GROUPS.format(d=16)}, o AS (SELECT count(DISTINCT original_key) AS n FROM uniq) SELECT (SELECT n FROM o) - count(DISTINCT group_ord) AS links FROM grouped")
def near_duplicate_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique = written(dedup.exact_dedup(views.images(spark, sf_dir))[0], "unique")
    count = lambda d: dedup.variant_groups(unique, "ord", "original_key", "hash", d).select("group_ord").distinct().agg(F.count(F.lit(1)).alias("n"))
    return count(None).withColumnRenamed("n", "m").crossJoin(F.broadcast(count(16))).select((F.col("m") - F.col("n")).alias("links"))


# -- splits -------------------------------------------------------------------------------------------------


def grouped_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique = written(dedup.exact_dedup(views.images(spark, sf_dir))[0], "unique")
    return written(dedup.variant_groups(unique, "ord", "original_key", "hash", None), "grouped")


ORIGINS = f"""{IMAGES}, og AS (SELECT *, printf('group_%06d', min(ord) OVER (PARTITION BY original_key)) AS group_id FROM uniq),
vec AS (SELECT group_id, 'images' AS dim, CAST(count(*) AS DOUBLE) AS value FROM og GROUP BY 1
  UNION ALL SELECT group_id, 'class_0', CAST(sum(c0) AS DOUBLE) FROM og GROUP BY 1 UNION ALL SELECT group_id, 'class_1', CAST(sum(c1) AS DOUBLE) FROM og GROUP BY 1
  UNION ALL SELECT group_id, concat('source_', source), CAST(count(*) AS DOUBLE) FROM og GROUP BY 1, 2)"""


@query(f"WITH {ORIGINS} SELECT group_id, dim, value FROM vec")
def group_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.group_vectors(grouped_images(spark, sf_dir))


@query(f"WITH {ORIGINS} SELECT split, dim, {q4('sum(value) * ratio')} AS target4 FROM vec, (VALUES ('train', 0.70::DOUBLE), ('val', 0.15::DOUBLE), ('test', 0.15::DOUBLE)) r(split, ratio) GROUP BY split, dim, ratio")
def split_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = splits.split_targets(splits.group_vectors(grouped_images(spark, sf_dir)))
    return out.select("split", "dim", scaled(F.col("target")).alias("target4"))


def split_sql(rule: str, shards: int) -> str:
    """The splits of the groups in ``ORIGINS``: ratios, seed and costs of ``splits.assign_splits``."""
    each = lambda x: f"list_transform(range(1, len(v) + 1), lambda k: {x})"
    cost = "(rooms[s][k] + v[k]) * (rooms[s][k] + v[k]) / (want[s][k] * want[s][k])" if rule == "own" else "v[k] * (2 * rooms[s][k] + v[k]) / (want[s][k] * (want[1][k] + want[2][k] + want[3][k]))"
    total = f"list_reduce({each(f'CASE WHEN want[s][k] > 0 THEN {cost} ELSE 0.0 END')}, lambda x, y: x + y)"
    forced = "len(list_filter(groups, lambda x: x = 0)) = n - i AND groups[s] > 0"
    ratios = ", ".join(f"list_transform(t, lambda x: {r}::DOUBLE * x)" for r in splits.RATIOS.values())
    names = [sorted(splits.RATIOS).index(s) for s in splits.RATIOS]
    return f"""WITH RECURSIVE {ORIGINS},
h AS (SELECT DISTINCT group_id, CAST(concat('0x', substr(md5(group_id), 1, 15)) AS BIGINT) % {shards} AS shard FROM og),
dims AS (SELECT dim, row_number() OVER (ORDER BY CASE dim WHEN 'images' THEN 0 WHEN 'class_0' THEN 1 WHEN 'class_1' THEN 2 ELSE 3 END, dim) AS k FROM (SELECT DISTINCT dim FROM vec)),
g AS (SELECT h.group_id, shard, list(coalesce(value, 0.0) ORDER BY k) AS v FROM h CROSS JOIN dims LEFT JOIN vec ON vec.group_id = h.group_id AND vec.dim = dims.dim GROUP BY 1, 2),
o AS (SELECT *, (r - 1 - {splits.SEED} % n + n) % n AS i FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY v[1] DESC, v[2] + v[3] DESC, group_id) AS r, count(*) OVER (PARTITION BY shard) AS n FROM g)),
tot AS (SELECT shard, list(x ORDER BY k) AS t FROM (SELECT shard, k, sum(v[k]) AS x FROM g, dims GROUP BY 1, 2) GROUP BY 1),
w AS (SELECT shard, [{ratios}] AS want FROM tot),
walk AS (SELECT shard, CAST(0 AS BIGINT) AS i, list_transform(want, lambda x: list_transform(x, lambda y: -y)) AS rooms, [0, 0, 0] AS groups, CAST(NULL AS VARCHAR) AS group_id, 0 AS pick FROM w
  UNION ALL SELECT shard, i + 1, list_transform([1, 2, 3], lambda s: CASE WHEN s = pick THEN {each('rooms[s][k] + v[k]')} ELSE rooms[s] END), list_transform([1, 2, 3], lambda s: groups[s] + CASE WHEN s = pick THEN 1 ELSE 0 END), group_id, pick
  FROM (SELECT a.shard, a.i, rooms, groups, o.group_id, v, list_sort(list_transform([1, 2, 3], lambda s: {{'c': CASE WHEN {forced.replace('- i', '- a.i')} THEN 'inf'::DOUBLE ELSE {total} END, 'g': groups[s], 'n': {names}[s], 's': s}}))[1].s AS pick
    FROM walk a JOIN o ON o.shard = a.shard AND o.i = a.i JOIN w ON w.shard = a.shard))
SELECT og.ord, og.group_id, {list(splits.RATIOS)}[pick] AS split FROM og JOIN walk ON og.group_id = walk.group_id"""


@query(split_sql("own", 1))
def split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.assign_splits(grouped_images(spark, sf_dir), rule="own").select("ord", "group_id", "split")


@query(split_sql("marginal", 4))
def split_assign_marginal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.assign_splits(grouped_images(spark, sf_dir), rule="marginal", shards=4).select("ord", "group_id", "split")


#: A split by rule, so that summaries and checks have SQL: origins may cross it, groups by hash of the source don't.
BY_RULE = "CASE WHEN ord % 20 < 14 THEN 'train' WHEN ord % 20 < 17 THEN 'val' ELSE 'test' END"


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_images(spark, sf_dir).withColumn("split", F.expr(BY_RULE))


@query(f"WITH {ORIGINS} SELECT {BY_RULE} AS split, count(*) AS images, count(*) FILTER (c0 + c1 = 0) AS negatives, count(DISTINCT group_id) AS groups, CAST(sum(c0) AS BIGINT) AS instances_class_0, CAST(sum(c1) AS BIGINT) AS instances_class_1 FROM og GROUP BY 1")
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_summary(ruled(spark, sf_dir))


LEAK = "SELECT 'leak_{k}' AS \"check\", {k} AS key, string_agg(DISTINCT split, ',' ORDER BY split) AS detail FROM r WHERE {k} IS NOT NULL GROUP BY 2 HAVING count(DISTINCT split) > 1"


@query(f"""WITH {ORIGINS}, r AS (SELECT *, {BY_RULE} AS split FROM og),
g AS (SELECT split, count(DISTINCT group_id) AS n, CAST(sum(c0) AS BIGINT) AS c0, CAST(sum(c1) AS BIGINT) AS c1 FROM r GROUP BY 1)
{LEAK.format(k='group_id')} UNION ALL {LEAK.format(k='sha256')} UNION ALL {LEAK.format(k='original_key')}
UNION ALL SELECT 'groups', split, CAST(n AS VARCHAR) FROM g WHERE n < CASE split WHEN 'train' THEN 1000 ELSE 100 END
UNION ALL SELECT 'boxes', concat(split, ':0'), CAST(c0 AS VARCHAR) FROM g WHERE split <> 'train' AND c0 < 60
UNION ALL SELECT 'boxes', concat(split, ':1'), CAST(c1 AS VARCHAR) FROM g WHERE split <> 'train' AND c1 < 60""")
def split_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_split(ruled(spark, sf_dir), {"train": 1000, "val": 100, "test": 100}, {"val": 60, "test": 60})


# -- detections ---------------------------------------------------------------------------------------------

AREA = "greatest(0.0, {a}x2 - {a}x1) * greatest(0.0, {a}y2 - {a}y1)"
INTER = "greatest(0.0, least(g.x2, p.x2) - greatest(g.x1, p.x1)) * greatest(0.0, least(g.y2, p.y2) - greatest(g.y1, p.y1))"
IOU = f"({INTER}) / ({AREA.format(a='g.')} + {AREA.format(a='p.')} - {INTER})"
BOTH = f"gt AS ({views.TRUTH}), pred AS ({views.DETECTIONS})"
PAIRED = f"{BOTH}, pairs AS (SELECT g.image_id, gt_idx, pred_idx, g.class_id AS gc, p.class_id AS pc, {IOU} AS iou FROM gt g JOIN pred p ON g.image_id = p.image_id WHERE {INTER} > 0)"
MATCHED = f"""{PAIRED},
cand AS (SELECT image_id, pred_idx, list({{'i': -iou, 'g': gt_idx}} ORDER BY iou DESC, gt_idx) FILTER (gc = pc) AS same, max(iou) FILTER (gc = pc) AS bs, max(iou) AS ba,
  arg_max(gc, [iou, -gt_idx]) AS tc FROM pairs GROUP BY 1, 2),
seq AS (SELECT p.*, same, coalesce(bs, 0.0) AS bs, coalesce(ba, 0.0) AS ba, tc, row_number() OVER (PARTITION BY p.image_id ORDER BY confidence DESC, p.pred_idx) AS r
  FROM pred p LEFT JOIN cand c ON p.image_id = c.image_id AND p.pred_idx = c.pred_idx),
walk AS (SELECT image_id, CAST(0 AS BIGINT) AS r, CAST([] AS INT[]) AS taken, CAST(NULL AS INT) AS pred_idx, CAST(NULL AS INT) AS class_id, CAST(NULL AS INT) AS gt_idx, CAST(NULL AS DOUBLE) AS best_iou, CAST(NULL AS INT) AS true_class, CAST(NULL AS VARCHAR) AS outcome FROM seq WHERE r = 1
  UNION ALL SELECT image_id, r, CASE WHEN hit IS NULL THEN taken ELSE list_append(taken, hit.g) END, pred_idx, class_id, hit.g,
    CASE WHEN hit IS NOT NULL THEN -hit.i WHEN bs < 0.5 AND ba >= 0.5 THEN ba ELSE bs END, CASE WHEN hit IS NULL AND bs < 0.5 AND ba >= 0.5 THEN tc END,
    CASE WHEN hit IS NOT NULL THEN 'true_positive' WHEN bs >= 0.5 THEN 'duplicate_detection' WHEN ba >= 0.5 THEN 'classification_confusion' WHEN bs >= 0.1 THEN 'localization_error' ELSE 'false_positive_background' END
  FROM (SELECT s.image_id, s.r, w.taken, s.pred_idx, s.class_id, bs, ba, tc, list_filter(s.same, lambda c: c.i <= -0.5 AND NOT list_contains(w.taken, c.g))[1] AS hit FROM walk w JOIN seq s ON s.image_id = w.image_id AND s.r = w.r + 1)),
matches AS (SELECT image_id, pred_idx, gt_idx, class_id, best_iou, true_class, outcome FROM walk WHERE r > 0
  UNION ALL SELECT g.image_id, NULL, g.gt_idx, g.class_id, NULL, NULL, 'false_negative_missed_lesion' FROM gt g WHERE NOT EXISTS (SELECT 1 FROM walk w WHERE w.image_id = g.image_id AND w.gt_idx = g.gt_idx))"""


def both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Not written: one shuffle of the table serves both, and they are dealt by image already."""
    return views.truth(spark, sf_dir), views.detections(spark, sf_dir)


@query(f"WITH {PAIRED} SELECT image_id, gt_idx, pred_idx, gc AS gt_class, pc AS pred_class, {q6('iou')} AS iou6 FROM pairs")
def iou_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.iou_pairs(*both(spark, sf_dir)).select("image_id", "gt_idx", "pred_idx", "gt_class", "pred_class", scaled(F.col("iou"), 1e6).alias("iou6"))


@query(f"WITH RECURSIVE {MATCHED} SELECT image_id, pred_idx, gt_idx, class_id, {q6('best_iou')} AS best6, true_class, outcome FROM matches")
def match_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = matching.match_detections(*both(spark, sf_dir))
    return out.select("image_id", "pred_idx", "gt_idx", "class_id", scaled(F.col("best_iou"), 1e6).alias("best6"), "true_class", "outcome")


ERRORS = ", ".join(f"count(*) FILTER (outcome = '{o}') AS {o}" for o in matching.OUTCOMES[1:5])


@query(f"WITH RECURSIVE {MATCHED} SELECT count(*) FILTER (outcome = 'true_positive') AS tp, count(*) FILTER (outcome NOT IN ('true_positive', 'false_negative_missed_lesion')) AS fp, count(*) FILTER (outcome = 'false_negative_missed_lesion') AS fn, {ERRORS} FROM matches")
def error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.error_counts(matching.match_detections(*both(spark, sf_dir)))


@query(f"""WITH RECURSIVE {MATCHED}, s AS (SELECT g.image_id, g.gt_idx, {AREA.format(a='')} / (640 * 640) AS share FROM gt g),
z AS (SELECT CASE WHEN share < 0.05 THEN 'small' WHEN share <= 0.20 THEN 'medium' ELSE 'large' END AS size, m.gt_idx AS hit FROM s LEFT JOIN (SELECT * FROM matches WHERE outcome = 'true_positive') m ON s.image_id = m.image_id AND s.gt_idx = m.gt_idx)
SELECT n.size, count(z.size) AS total, count(hit) AS recalled, CASE WHEN count(z.size) > 0 THEN {q4('count(hit)::DOUBLE / count(z.size)')} END AS recall4 FROM (VALUES ('small'), ('medium'), ('large')) n(size) LEFT JOIN z ON z.size = n.size GROUP BY 1""")
def size_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    gt, pred = both(spark, sf_dir)
    out = matching.size_recall(matching.match_detections(gt, pred), gt, views.image_sizes(gt))
    return out.select("size", "total", "recalled", scaled(F.try_divide("recalled", "total")).alias("recall4"))


SUPPRESSED = f"""pred AS ({views.DETECTIONS}), seq AS (SELECT *, row_number() OVER (PARTITION BY image_id, class_id ORDER BY confidence DESC, pred_idx) AS r FROM pred),
walk AS (SELECT image_id, class_id, CAST(0 AS BIGINT) AS r, CAST([] AS STRUCT(x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE)[]) AS kept, CAST(NULL AS INT) AS pred_idx, FALSE AS keep FROM seq WHERE r = 1
  UNION ALL SELECT image_id, class_id, r, CASE WHEN clash THEN kept ELSE list_append(kept, {{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}) END, pred_idx, NOT clash
  FROM (SELECT p.*, w.kept, len(list_filter(w.kept, lambda g: {IOU} > 0.45)) > 0 AS clash FROM walk w JOIN seq p ON p.image_id = w.image_id AND p.class_id = w.class_id AND p.r = w.r + 1))"""


@query(f"WITH RECURSIVE {SUPPRESSED} SELECT image_id, pred_idx, class_id FROM walk WHERE keep")
def nms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.nms(views.detections(spark, sf_dir), 0.45).select("image_id", "pred_idx", "class_id")


def ap_sql(thresholds: tuple[float, ...]) -> str:
    """The tables ``ap`` (class_id, threshold, ap) for detections over the views."""
    values = ", ".join(f"({t}::DOUBLE)" for t in thresholds)
    return f"""{PAIRED}, th AS (SELECT * FROM (VALUES {values}) v(threshold)),
cand AS (SELECT image_id, pred_idx, list({{'i': iou, 'g': gt_idx}} ORDER BY iou DESC, gt_idx) FILTER (gc = pc) AS same FROM pairs GROUP BY 1, 2),
seq AS (SELECT p.image_id, p.pred_idx, p.class_id, p.confidence, same, row_number() OVER (PARTITION BY p.image_id ORDER BY confidence DESC, p.pred_idx) AS r FROM pred p LEFT JOIN cand c ON p.image_id = c.image_id AND p.pred_idx = c.pred_idx),
walk AS (SELECT image_id, threshold, CAST(0 AS BIGINT) AS r, CAST([] AS INT[]) AS taken, CAST(NULL AS INT) AS pred_idx, CAST(NULL AS INT) AS class_id, CAST(NULL AS DOUBLE) AS confidence, 0 AS tp FROM seq, th WHERE r = 1
  UNION ALL SELECT image_id, threshold, r, CASE WHEN hit IS NULL THEN taken ELSE list_append(taken, hit.g) END, pred_idx, class_id, confidence, CASE WHEN hit IS NULL THEN 0 ELSE 1 END
  FROM (SELECT s.*, w.threshold, w.taken, list_filter(s.same, lambda c: c.i >= w.threshold AND NOT list_contains(w.taken, c.g))[1] AS hit FROM walk w JOIN seq s ON s.image_id = w.image_id AND s.r = w.r + 1)),
ranked AS (SELECT *, sum(tp) OVER o AS hits, count(*) OVER o AS seen FROM walk WHERE r > 0 WINDOW o AS (PARTITION BY class_id, threshold ORDER BY confidence DESC, image_id, pred_idx ROWS UNBOUNDED PRECEDING)),
env AS (SELECT *, max(hits::DOUBLE / seen) OVER (PARTITION BY class_id, threshold ORDER BY confidence DESC, image_id, pred_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS e FROM ranked),
truths AS (SELECT class_id, count(*) AS n FROM gt GROUP BY 1),
area AS (SELECT e.class_id, threshold, sum(((100 * hits) // n - CASE WHEN hits = 1 THEN -1 ELSE (100 * (hits - 1)) // n END) * e) / 101 AS ap FROM env e JOIN truths t ON e.class_id = t.class_id WHERE tp = 1 GROUP BY 1, 2),
ap AS (SELECT t.class_id, th.threshold, coalesce(a.ap, 0.0) AS ap FROM truths t CROSS JOIN th LEFT JOIN area a ON a.class_id = t.class_id AND a.threshold = th.threshold)"""


@query(f"WITH RECURSIVE {ap_sql((0.5, 0.75))} SELECT class_id, {q4('threshold')} AS threshold4, {q4('ap')} AS ap4 FROM ap")
def ap_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.average_precision(*both(spark, sf_dir), (0.5, 0.75))
    return out.select("class_id", scaled(F.col("threshold")).alias("threshold4"), scaled(F.col("ap")).alias("ap4"))


@query(f"WITH RECURSIVE {ap_sql(metrics.THRESHOLDS)} SELECT {q4('avg(ap) FILTER (threshold = 0.5)')} AS map50_4, {q4('avg(ap)')} AS map50_95_4 FROM ap")
def map_50_95(spark: SparkSession, sf_dir: str) -> DataFrame:
    ap = metrics.average_precision(*both(spark, sf_dir))
    return ap.agg(scaled(F.avg(F.when(F.col("threshold") == 0.5, F.col("ap")))).alias("map50_4"), scaled(F.avg("ap")).alias("map50_95_4"))


@query(f"""WITH RECURSIVE {ap_sql(metrics.THRESHOLDS)}, m AS (SELECT class_id, max(ap) FILTER (threshold = 0.5) AS ap50, avg(ap) AS ap50_95 FROM ap GROUP BY 1),
k AS (SELECT class_id, CAST(sum(tp) AS BIGINT) AS tp, count(*) AS n FROM walk WHERE r > 0 AND threshold = 0.5 GROUP BY 1)
SELECT class_id, coalesce(tp, 0) AS tp, coalesce(k.n, 0) - coalesce(tp, 0) AS fp, coalesce(t.n, 0) - coalesce(tp, 0) AS fn, {q4('tp::DOUBLE / nullif(k.n, 0)')} AS precision_4, {q4('coalesce(tp, 0)::DOUBLE / nullif(t.n, 0)')} AS recall_4,
  {q4('ap50')} AS ap50_4, {q4('ap50_95')} AS ap50_95_4 FROM truths t FULL JOIN k USING (class_id) LEFT JOIN m USING (class_id)""")
def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.class_metrics(*both(spark, sf_dir))
    return out.select("class_id", "tp", "fp", "fn", *[scaled(F.col(c)).alias(f"{c}_4") for c in ("precision", "recall", "ap50", "ap50_95")])


@query(f"WITH pred AS ({views.DETECTIONS}) SELECT class_id, count(*) AS n FROM pred WHERE confidence >= 0.45 GROUP BY 1")
def detections_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"))
    return detections.detections_by_class(orders, detections.at_least(views.detections(spark, sf_dir), 0.45))


PER_IMAGE = f"""pred AS ({views.DETECTIONS}), s AS (SELECT o_orderkey AS image_id, count(pred_idx) AS n, count(*) FILTER (class_id = 0) AS n_class_0, count(*) FILTER (class_id = 1) AS n_class_1, coalesce(max(confidence), 0.0) AS c
  FROM orders LEFT JOIN (SELECT * FROM pred WHERE confidence >= 0.45) p ON o_orderkey = image_id GROUP BY 1)"""


@query(f"WITH {PER_IMAGE} SELECT image_id, n, n_class_0, n_class_1, {q4('c')} AS confidence4, CASE WHEN n > 0 THEN 'DETECTED' ELSE 'NO_SYMPTOM_DETECTED' END AS status, CASE WHEN n = 0 THEN 'none' WHEN n_class_0 > 0 AND n_class_1 > 0 THEN 'both' WHEN n_class_0 > 0 THEN 'class_0' ELSE 'class_1' END AS diagnosis, CAST(CASE WHEN n > 0 THEN 2 ELSE 3 END AS INT) AS n_warnings, CAST(3 * (CASE WHEN n_class_0 > 0 THEN 1 ELSE 0 END + CASE WHEN n_class_1 > 0 THEN 1 ELSE 0 END) AS INT) AS n_advice FROM s")
def image_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"))
    out = detections.summarise_images(orders, detections.at_least(views.detections(spark, sf_dir), 0.45))
    return out.select("image_id", "n", "n_class_0", "n_class_1", scaled(F.col("max_confidence")).alias("confidence4"), "status", "diagnosis", F.size("warnings").alias("n_warnings"), F.size("advice").alias("n_advice"))


@query(f"WITH {PER_IMAGE} SELECT count(*) AS images, count(*) FILTER (n > 0) AS images_detected, CAST(sum(n) AS BIGINT) AS detections, CASE WHEN sum(n) > 0 THEN 'DETECTED' ELSE 'NO_SYMPTOM_DETECTED' END AS status FROM s")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"))
    return detections.run_summary(orders, detections.at_least(views.detections(spark, sf_dir), 0.45))


@query(f"WITH pred AS ({views.DETECTIONS}) SELECT image_id, pred_idx, CAST(row_number() OVER (PARTITION BY image_id ORDER BY pred_idx) AS INT) AS number, {q6(AREA.format(a='') + ' / (640 * 640) * 100')} AS area6 FROM pred")
def box_area_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = views.detections(spark, sf_dir)
    return detections.box_table(pred, views.image_sizes(pred)).select("image_id", "pred_idx", "number", scaled(F.col("area_pct"), 1e6).alias("area6"))


# -- bytes --------------------------------------------------------------------------------------------------


#: Headers of four kinds before the bytes of a page, a JPEG without a frame and no image at all; widths and heights by id.
WIDTH, HEIGHT = "(page_id * 37) % 3000 + 1", "(page_id * 91) % 2000 + 1"
BYTES = "lpad({hex}({x}), {n}, '0')"


def headed(hexed: str, unhexed: str) -> str:
    """The content of a page as an upload; ``hexed`` and ``unhexed`` name the engine's functions."""
    big = lambda x, n: BYTES.format(hex=hexed, x=x, n=n)
    little = lambda x: f"concat({', '.join(BYTES.format(hex=hexed, x=f'(({x}) // {256**k}) % 256' if hexed == 'to_hex' else f'(({x}) DIV {256**k}) % 256', n=2) for k in range(3))})"
    return f"""CASE page_id % 6 WHEN 0 THEN {unhexed}(concat('FFD8FFE000041234FFFFC0001108', {big(HEIGHT, 4)}, {big(WIDTH, 4)}, '03'))
  WHEN 1 THEN {unhexed}(concat('89504E470D0A1A0A0000000D49484452', {big(WIDTH, 8)}, {big(HEIGHT, 8)}))
  WHEN 2 THEN {unhexed}(concat('524946460000000057454250565038580A00000000000000', {little(WIDTH + " - 1")}, {little(HEIGHT + " - 1")}))
  WHEN 3 THEN {unhexed}('FFD8FFE000041234FFD9') ELSE {unhexed}('') END"""


@query(f"""WITH b AS (SELECT page_id, {headed('to_hex', 'unhex')} || encode(html) AS content FROM pages)
SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/png' WHEN 2 THEN 'image/webp' WHEN 3 THEN 'image/jpeg' END AS mime,
  CAST(CASE WHEN octet_length(content) > 2000 THEN 413 WHEN octet_length(content) < 12 THEN 400 WHEN page_id % 6 > 3 THEN 415 WHEN page_id % 6 = 3 THEN 400
    WHEN ({WIDTH}) * ({HEIGHT}) > 1000000 THEN 413 ELSE 200 END AS INT) AS screen_code FROM b""")
def content_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "pages").select("page_id", F.concat(F.expr(headed("hex", "unhex")), F.encode("html", "UTF-8")).alias("content"))
    return image_functions.screen_content(files, max_bytes=2000, max_pixels=1_000_000, sizes=True).select("page_id", "mime", "screen_code")


@query(f"WITH {BITS} SELECT vec_id, CAST(hamming(bits, repeat('0', 64)) AS INT) AS ones FROM sig")
def vector_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.signatures(spark, sf_dir).select("vec_id", hamming(F.col("h"), F.lit(0).cast("long")).alias("ones"))


def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in the columns of Spark's image source: their bytes as rows of 32 pixels of three channels."""
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = F.greatest(F.lit(8), F.ceil(F.octet_length(body) / 96)).cast("int")
    data = F.concat(body, F.unhex(F.repeat(F.lit("80"), rows * 96 - F.octet_length(body))))
    return table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("origin"), rows.alias("height"), F.lit(32).alias("width"), F.lit(3).alias("nChannels"), F.lit(16).alias("mode"), data.alias("data"))


@query()
def perceptual_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_functions.describe_pixels(page_images(spark, sf_dir)).select("path", "width", "height", "phash")


@query()
def image_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = image_functions.image_quality(image_functions.describe_pixels(page_images(spark, sf_dir)))
    return out.select("path", scaled(F.col("blur")).alias("blur4"), scaled(F.col("brightness")).alias("brightness4"), "quality_status", F.array_join("warnings", ",").alias("warnings"))


def bright_spots():
    """A stand-in model: one detection around the brightest quarter of an image, class by its side."""
    import numpy as np

    def one(image: np.ndarray) -> list[tuple]:
        g = image_functions.grey(image)
        h, w = g.shape[0] // 2, g.shape[1] // 2
        means = [(float(g[y : y + h, x : x + w].mean()), y, x) for y in (0, h) for x in (0, w)]
        m, y, x = max(means)
        return [(int(x > 0), m / 255, float(x), float(y), float(x + w), float(y + h))]

    return lambda images: [one(image) for image in images]


@query()
def score_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = image_functions.score_images(page_images(spark, sf_dir), bright_spots)
    return out.select(F.col("origin").alias("path"), "pred_idx", "class_id", scaled(F.col("confidence")).alias("confidence4"), "x1", "y1", "x2", "y2")
