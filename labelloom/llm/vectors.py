"""Vector codes by Lloyd's rounds over two trees.

Components become integers, vectors are cut into parts, each part position has a codebook of its own. The rows of
a task are dealt into blocks of ``BLOCK_ROWS`` vectors. A block is written once, with a tree over its points for each
part position: points split in halves along their widest dimension, down to leaves of ``LEAF`` to twice as many,
and for each node its bounding box, its sum and its number of points.

A round goes down that tree and a tree over the codebook's entries together (all part positions at once). A pair
of nodes is pruned if their boxes lie further apart than the furthest that some other node of entries can lie
from any of the points, and an entry if another one is nearer (or as near, of lower index) to every corner of the
box. A node with one entry left is assigned as a whole, with its cached sum; points of leaves with several entries
left are compared with these, in integers. All bounds are integers too, so pruning never changes a result. What a
task returns is a sum and a number of points for each entry; sums are added up by Spark.

Cases: vectors that are null or hold null or non-finite components leave; fewer than ``ENTRIES`` vectors make as many
entries; null ids come after all others, equal ids in the order of their vectors; repeated rows count as often as
they occur; vectors shorter than the longest, or of a length that ``PARTS`` doesn't divide, are filled up with
zeros; components beyond 2 ** 50 are cut there, and errors beyond 2 ** 63 - 1 are that; a sum of a label's errors
beyond it is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.session import small_batches, table, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK_ROWS, LEAF = 2048, 32
LARGEST = 2**63 - 1
#: Components, scaled, are cut here.
CUT = float(2**62)
#: A block: ids and labels; ``points`` (part, place in the tree, component) and their rows in ``rows`` (part, place);
#: per node, level by level, box and sum; ``wide`` blocks hold too large numbers for trees, and points of 64 bits.
BLOCK = "n int, wide boolean, vec_ids array<long>, labels array<long>, points binary, rows binary, low binary, high binary, sums binary"
SUMS = "part int, entry int, component int, n long, total decimal(38,0)"
CODES = "vec_id long, label long, code string, error long"


# -- trees ------------------------------------------------------------------------------------------------------


def narrow_bound(width: int, parts: int) -> int:
    """Below this, squared distances and the sums made of them fit into 64 bits."""
    return isqrt(2**60 // (width * parts))


def leaf_edges(n: int) -> np.ndarray:
    """Where the leaves of a tree over n points begin and end; a power of two of them."""
    depth = max(0, (n // LEAF).bit_length() - 1)
    return (n * np.arange(2**depth + 1)) >> depth


def tree_order(points: np.ndarray) -> np.ndarray:
    """(part, place) -> row: the order of the ``points`` (part, row, component) in their trees."""
    parts, n, _ = points.shape
    order = np.tile(np.arange(n), (parts, 1))
    edges = leaf_edges(n)
    step = len(edges) - 1
    while step > 1:
        for lo, hi in zip(edges[:-1:step], edges[step::step], strict=True):
            for p in range(parts):
                inside = points[p, order[p, lo:hi]]
                by = np.argmax(np.ptp(inside, axis=0))
                order[p, lo:hi] = order[p, lo:hi][np.argsort(inside[:, by], kind="stable")]
        step //= 2
    return order


def node_values(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low, high, sums) of the nodes, the root first, then level by level, of points in tree order."""
    edges, out = leaf_edges(points.shape[1]), []
    step = len(edges) - 1
    while step:
        at = edges[:-1:step]
        out.append([f.reduceat(points, at, axis=1) for f in (np.minimum, np.maximum, np.add)])
        step //= 2
    return tuple(np.concatenate([x[i] for x in out], axis=1) for i in range(3))


def entry_levels(book: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The tree over the entries (part, entry, component): their order in it and, from the root to the entries,
    each level's (parent, low, high)."""
    parts, k, _ = book.shape
    order, ranges, levels = np.tile(np.arange(k), (parts, 1)), [(0, k)], []
    parent = np.zeros(1, np.int64)
    while True:
        at = np.array([lo for lo, _ in ranges])
        sorted_book = np.take_along_axis(book, order[:, :, None], axis=1)
        levels.append((parent, np.minimum.reduceat(sorted_book, at, axis=1), np.maximum.reduceat(sorted_book, at, axis=1)))
        if len(ranges) == k:
            return order, levels
        for lo, hi in ranges:
            for p in range(parts):
                inside = book[p, order[p, lo:hi]]
                order[p, lo:hi] = order[p, lo:hi][np.argsort(inside[:, np.argmax(np.ptp(inside, axis=0))], kind="stable")]
        halves = [(i, r) for i, (lo, hi) in enumerate(ranges) for r in ([(lo, hi)] if hi - lo == 1 else [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)])]
        parent, ranges = np.array([i for i, _ in halves]), [r for _, r in halves]


def squared(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=-1)


def near_nodes(low: np.ndarray, high: np.ndarray, e_low: np.ndarray, e_high: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Which of the ``live`` pairs (part, point node, entry node) the distances of their boxes leave."""
    gap = np.maximum(e_low[:, None] - high[:, :, None], low[:, :, None] - e_high[:, None])
    least = squared(np.maximum(gap, 0))
    most = squared(np.maximum(e_high[:, None] - low[:, :, None], high[:, :, None] - e_low[:, None]))
    bound = np.where(live, most, LARGEST).min(axis=2, keepdims=True)
    return live & (least <= bound)


def undominated(low: np.ndarray, high: np.ndarray, book: np.ndarray, order: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Which of the ``live`` pairs (part, point node, entry) stay beside the entry nearest to the node's middle."""
    middle = (low + high) >> 1
    distance = np.where(live, squared(middle[:, :, None] - book[:, None]), LARGEST)
    best = distance.argmin(axis=2)
    rival = np.take_along_axis(book, best[:, :, None], axis=1)
    # the greatest (distance to the rival - distance to the entry) over the box
    away = 2 * (book[:, None] - rival[:, :, None])
    most = np.maximum(away * low[:, :, None], away * high[:, :, None]).sum(axis=-1) + squared(rival)[:, :, None] - squared(book)[:, None]
    first = np.take_along_axis(order, best, axis=1)[:, :, None] < order[:, None]
    return live & ~((most < 0) | ((most == 0) & first))


def assign(points: np.ndarray, nodes: tuple[np.ndarray, np.ndarray, np.ndarray] | None, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(entry of each point (part, place), counts (part, entry), sums (part, entry, component), share of points that
    whole nodes assigned). Without ``nodes`` every point is compared with every entry."""
    parts, n, width = points.shape
    k = book.shape[1]
    counts, sums = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), points.dtype)
    entry = np.full((parts, n), -1, np.int64)
    if nodes is None:
        for i in range(n):
            d = squared(points[:, i, None] - book)
            entry[:, i] = [min(range(k), key=row.__getitem__) for row in d.tolist()]
        for p in range(parts):
            np.add.at(counts[p], entry[p], 1)
            for e in range(k):
                sums[p, e] = points[p, entry[p] == e].sum(axis=0)
        return entry, counts, sums, 0.0

    low, high, cached = nodes
    edges = leaf_edges(n)
    order, levels = entry_levels(book)
    sorted_book = np.take_along_axis(book, order[:, :, None], axis=1)
    step, at, size = len(edges) - 1, 0, 1
    live = np.ones((parts, 1, 1), bool)
    depth = 0
    while True:
        lo, hi = low[:, at : at + size], high[:, at : at + size]
        # entries go down a level with the points, or to the end where the points' tree has no more levels
        while depth < len(levels):
            parent, e_low, e_high = levels[depth]
            live = near_nodes(lo, hi, e_low, e_high, live[:, :, parent])
            depth += 1
            if step > 1:
                break
        if depth == len(levels):
            live = undominated(lo, hi, sorted_book, order, live)
            for p, i in zip(*np.nonzero(live.sum(axis=2) == 1), strict=True):
                e = order[p, live[p, i].argmax()]
                a, b = edges[i * step], edges[(i + 1) * step]
                entry[p, a:b] = e
                counts[p, e] += b - a
                sums[p, e] += cached[p, at + i]
                live[p, i] = False
        if step == 1:
            break
        at, size, step = at + size, 2 * size, step // 2
        live = np.repeat(live, 2, axis=1)
    whole = float((entry >= 0).mean())
    for p, i in zip(*np.nonzero(live.any(axis=2)), strict=True):
        a, b = edges[i], edges[i + 1]
        among = np.sort(order[p, live[p, i]])
        nearest = among[squared(points[p, a:b, None] - book[p, among]).argmin(axis=1)]
        entry[p, a:b] = nearest
        np.add.at(counts[p], nearest, 1)
        np.add.at(sums[p], nearest, points[p, a:b])
    return entry, counts, sums, whole


# -- blocks -----------------------------------------------------------------------------------------------------


def integers(vectors: pa.Array, length: int) -> np.ndarray:
    """(row, component): scaled and floored, filled up with zeros to ``length``."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(sizes), length))
    out[np.arange(length)[None, :] < sizes[:, None]] = flat
    return np.clip(np.floor(SCALE * out), -CUT, CUT).astype(np.int64)


def blocks(rows: DataFrame, length: int, parts: int = PARTS) -> DataFrame:
    """``BLOCK`` rows of ``rows`` (vec_id, label, vector)."""
    most = narrow_bound(length // parts, parts)

    def block(ids: list, labels: list, values: np.ndarray) -> pa.RecordBatch:
        points = np.ascontiguousarray(values.reshape(len(values), parts, -1).transpose(1, 0, 2))
        wide = bool(np.abs(values).max(initial=0) >= most)
        if wide:
            stored, trees = points.astype("<i8").tobytes(), (b"", b"", b"", b"")
        else:
            order = tree_order(points)
            points = np.take_along_axis(points, order[:, :, None], axis=1)
            low, high, sums = node_values(points)
            stored = points.astype("<i4").tobytes()
            trees = (order.astype("<i2").tobytes(), low.astype("<i4").tobytes(), high.astype("<i4").tobytes(), sums.astype("<i8").tobytes())
        columns = [pa.array([len(values)], pa.int32()), pa.array([wide]), pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.int64())), *[pa.array([x], pa.binary()) for x in (stored, *trees)]]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in BLOCK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, held = [], [], []
        for b in batches:
            at = 0
            while at < b.num_rows:
                part = b.slice(at, BLOCK_ROWS - len(ids))
                at += part.num_rows
                ids += part.column(0).to_pylist()
                labels += part.column(1).to_pylist()
                held.append(integers(part.column(2), length))
                if len(ids) == BLOCK_ROWS:
                    yield block(ids, labels, np.concatenate(held))
                    ids, labels, held = [], [], []
        if ids:
            yield block(ids, labels, np.concatenate(held))

    return rows.mapInArrow(run, BLOCK)


def read_blocks(batch: pa.RecordBatch, book: np.ndarray) -> Iterator[tuple]:
    """(vec_ids, labels, points, rows, nodes) of each block; without nodes, numbers are Python's."""
    parts, _, width = book.shape
    large = np.abs(book).max(initial=0) >= narrow_bound(width, parts)
    for i in range(batch.num_rows):
        n, wide, ids, labels, points, rows, low, high, sums = (batch.column(j)[i].as_py() for j in range(9))
        points = np.frombuffer(points, "<i8" if wide else "<i4").reshape(parts, n, width)
        rows = np.tile(np.arange(n), (parts, 1)) if wide else np.frombuffer(rows, "<i2").reshape(parts, n)
        if wide or large:
            yield ids, labels, points.astype(object), rows, None
        else:
            nodes = [np.frombuffer(x, t).reshape(parts, -1, width).astype(np.int64) for x, t in ((low, "<i4"), (high, "<i4"), (sums, "<i8"))]
            yield ids, labels, points.astype(np.int64), rows, tuple(nodes)


def typed(book: np.ndarray, points: np.ndarray) -> np.ndarray:
    return book.astype(points.dtype)


def part_sums(stored: DataFrame, book: np.ndarray) -> DataFrame:
    """``SUMS`` of the points assigned to each entry of ``book``, a row for each task, entry and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, k, width = book.shape
        counts, sums = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), object)
        for b in batches:
            for _, _, points, _, nodes in read_blocks(b, book):
                _, n, s, _ = assign(points, nodes, typed(book, points))
                counts += n
                sums += s
        p, e, c = (x.ravel() for x in np.indices((parts, k, width)))
        used = counts[p, e] > 0
        if used.any():
            p, e, c = p[used], e[used], c[used]
            total = pa.array([int(x) for x in sums[p, e, c]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(c, pa.int32()), pa.array(counts[p, e], pa.int64()), total], names=[x.split()[0] for x in SUMS.split(", ")])

    added = stored.mapInArrow(run, SUMS)
    return added.groupBy("part", "entry", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def coded(stored: DataFrame, book: np.ndarray) -> DataFrame:
    """``CODES`` of all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, labels, points, rows, nodes in read_blocks(b, book):
                own = typed(book, points)
                entry, _, _, _ = assign(points, nodes, own)
                code, error = np.zeros((len(ids), len(own)), np.uint8), np.zeros(len(ids), object)
                for p in range(len(own)):
                    code[rows[p], p] = entry[p]
                    error[rows[p]] += squared(points[p] - own[p, entry[p]]).astype(object)
                text = code.tobytes().hex()
                step = 2 * len(own)
                columns = [ids, labels, [text[i : i + step] for i in range(0, len(text), step)], [min(int(x), LARGEST) for x in error]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=[x.split()[0] for x in CODES.split(", ")])

    return stored.mapInArrow(run, CODES)


# -- rounds -----------------------------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(``CODES`` of the usable ``vectors``, codebooks (part, entry, component))."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must have one byte each")
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector")).filter(usable(F.col("vector")))
    longest = rows.agg(F.max(F.size("vector")).alias("n")).first()["n"]
    if longest is None:
        return spark.createDataFrame([], CODES), np.zeros((parts, 0, 1), np.int64)
    length = parts * max(1, -(-longest // parts))
    # as many rows as a codebook has entries
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
    start = integers(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), length)
    book = start.reshape(len(first), parts, -1).transpose(1, 0, 2).astype(object)
    stored = written(blocks(rows, length, parts), "vector-blocks")
    for _ in range(rounds):
        # a row for each component of the codebooks
        for r in part_sums(stored, np.array(book)).collect():
            book[r["part"], r["entry"], r["component"]] = int(r["total"]) // r["n"]
    return written(coded(stored, book), "vector-codes"), book


def book_digest(book: np.ndarray) -> str:
    return sha256(",".join(str(int(x)) for x in book.ravel()).encode()).hexdigest()


def op13_dual_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, book = vector_codes(table(spark, sf_dir, "embeddings"))
    per_label = codes.groupBy(F.col("label").alias("__label")).agg(F.try_sum("error").alias("label_error"))
    out = codes.join(per_label, F.col("label").eqNullSafe(F.col("__label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(book_digest(book)).alias("codebooks_sha256"))


def _rounds_sql() -> str:
    """Codebooks b0 to b6 and assignments a0 to a6 over the parts ``v`` (rn, part, c)."""
    out = []
    for i in range(ROUNDS + 1):
        if i:
            out.append(
                f"b{i} AS (SELECT b.part, b.entry, coalesce(n.c, b.c) AS c FROM b{i - 1} b LEFT JOIN (SELECT part, entry, list(CAST((s - ((s % k) + k) % k) // k AS BIGINT) ORDER BY i) AS c FROM "
                f"(SELECT a.part, entry, i, sum(v.c[i]) AS s, count(*) AS k FROM a{i - 1} a JOIN v ON a.rn = v.rn AND a.part = v.part, range(1, 9) r(i) GROUP BY 1, 2, 3) GROUP BY 1, 2) n ON b.part = n.part AND b.entry = n.entry)"
            )
        out.append(
            f"a{i} AS (SELECT rn, part, arg_min(entry, [d, entry]) AS entry, min(d) AS d FROM (SELECT v.rn, v.part, b.entry, CAST(list_sum([(v.c[i] - b.c[i]) * (v.c[i] - b.c[i]) FOR i IN range(1, 9)]) AS BIGINT) AS d FROM v JOIN b{i} b ON v.part = b.part) GROUP BY 1, 2)"
        )
    return ",\n".join(out)


QUERIES = {"op13_dual_tree_codes": op13_dual_tree_codes}
ORACLE = {
    "op13_dual_tree_codes": f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rn FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT rn, p AS part, q[8 * p + 1:8 * p + 8] AS c FROM k, range({PARTS}) t(p)),
b0 AS (SELECT part, rn - 1 AS entry, c FROM v WHERE rn <= {ENTRIES}),
{_rounds_sql()},
e AS (SELECT rn, string_agg(lpad(format('{{:x}}', entry), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY 1),
s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM k JOIN e ON k.rn = e.rn CROSS JOIN s""",
}
