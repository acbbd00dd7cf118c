"""Quality classifier: random-indexing word vectors, pooled per document, scored by a two-layer network.

Every token (a word in lower case, a run of marks, a class for words in capitals and for numbers) is hashed to
one of ``BUCKETS`` rows. Each row has a sparse ternary index vector, made from a rule. A first pass over all
documents adds up, for every row, the index vectors of the tokens nearby: its context vector, whose direction
is the word vector. A second pass pools the word vectors of a document (mean and spread). A network of two
layers, in numpy, is trained on the pooled vectors of a bounded sample of labelled documents (``SAMPLE``); its
temperature is set on a part of that sample kept back. Context sums are integers, so they do not depend on
the order in which tasks finish.

Cases: null or empty text pools to zeros and gets a score all the same; repeated rows give repeated results;
without labels of both kinds every score is the share of label 1 (0.5 with none); an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import tokens
from labelloom.llm.text import byte_class, column_bytes, lower_table, mix, row_blocks, span_hashes
from labelloom.session import small_batches, table, written

BUCKETS, DIMS, NONZERO, REACH = 1 << 14, 64, 4, 2
#: Labelled documents that train and calibrate the network, at most.
SAMPLE = 20_000
THRESHOLD = 0.3
HIDDEN, EPOCHS, BATCH, RATE = 32, 60, 256, 3e-3
CHUNK = 1 << 18  # bytes of text handled at once

LETTER = byte_class(r"[A-Za-z\x80-\xff]")
DIGIT, UPPER, SPACE = byte_class(r"[0-9]"), byte_class(r"[A-Z]"), byte_class(r"[\x00-\x20\x7f]")
LOWER = lower_table()
CAPITALS, NUMBER = 0, 1  # rows of their own


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each row's index vector."""
    h = mix(np.arange(BUCKETS * NONZERO, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)).reshape(BUCKETS, NONZERO)
    return (h % np.uint64(DIMS)).astype(np.int64), np.where((h >> np.uint64(40)) & np.uint64(1), 1, -1).astype(np.int64)


def token_rows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of every token of some texts, and the number of tokens before each text (n + 1 values)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = np.where(SPACE[raw], 0, np.where(LETTER[raw], 1, np.where(DIGIT[raw], 2, 3)))
    first = np.ones(len(raw), bool)
    first[1:] = kind[1:] != kind[:-1]
    first[offsets[(offsets > 0) & (offsets < len(raw))]] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(raw))
    kept = kind[starts] > 0
    starts, ends = starts[kept], ends[kept]
    kinds = kind[starts]
    rows = (span_hashes(LOWER[raw], starts, ends) % np.uint64(BUCKETS - 2)).astype(np.int64) + 2
    capitals = np.concatenate([[0], np.cumsum(UPPER[raw])])
    size = ends - starts
    rows[(kinds == 1) & (size > 1) & (2 * (capitals[ends] - capitals[starts]) > size)] = CAPITALS
    rows[kinds == 2] = NUMBER
    return rows, np.searchsorted(starts, offsets)


def context_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Context vector of every row over all ``docs`` (BUCKETS x DIMS integers, whatever the corpus)."""
    small_batches(docs.sparkSession)
    schema = "bucket int, vector binary"

    def nearby(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.release()
        place, sign = index_vectors()
        total = np.zeros(BUCKETS * DIMS, np.int64)
        for b in batches:
            raw, off = column_bytes(b.column(0))
            for lo, hi in row_blocks(off, 2 * CHUNK):
                rows, bounds = token_rows(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                text = np.repeat(np.arange(hi - lo), np.diff(bounds))
                more, less = [], []
                for d in range(1, REACH + 1):
                    same = text[d:] == text[:-d]
                    a, c = rows[:-d][same], rows[d:][same]
                    for x, y in ((a, c), (c, a)):
                        at, up = x[:, None] * DIMS + place[y], sign[y] > 0
                        more.append(at[up])
                        less.append(at[~up])
                total += np.bincount(np.concatenate(more), minlength=len(total))
                total -= np.bincount(np.concatenate(less), minlength=len(total))
        yield packed(total.reshape(BUCKETS, DIMS))

    def packed(total: np.ndarray) -> pa.RecordBatch:
        used = np.flatnonzero(total.any(axis=1))
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([v.tobytes() for v in total[used]], pa.binary())], names=["bucket", "vector"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, DIMS), np.int64)
        for b in batches:
            if b.num_rows:
                values = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64).reshape(-1, DIMS)
                np.add.at(total, b.column(0).to_numpy(), values)
        yield packed(total)

    # the sums of a row meet in one task, which adds them up as they come
    out = docs.select(text_col).mapInArrow(nearby, schema).repartition("bucket").mapInArrow(summed, schema)
    vectors = np.zeros((BUCKETS, DIMS), np.int64)
    for r in out.collect():  # at most BUCKETS rows
        vectors[r["bucket"]] += np.frombuffer(r["vector"], np.int64)
    return vectors


def word_vectors(context: np.ndarray) -> np.ndarray:
    """Unit word vectors: a bucket's context less the direction all contexts share."""
    x = context / np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1.0)
    x -= x[context.any(axis=1)].mean(axis=0) if context.any() else 0.0
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(docs: DataFrame, vectors: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, features): mean and mean square of a document's word vectors and the log of its tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(np.concatenate([vectors, vectors**2], axis=1))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = pool_texts(b.column(1), shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([v.tobytes() for v in out], pa.binary())], names=[id_col, "features"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, features binary")


class Network:
    """Two layers (tanh, logistic) on standardised features; probabilities at temperature ``t``."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.prior = float(y.mean()) if len(y) else 0.5
        self.t, self.layers = 1.0, []
        if len(y) < 2 or y.min() == y.max():
            return
        order = rng.permutation(len(y))
        back = max(1, len(y) // 6)
        held, used = order[:back], order[back:]
        self.mean, self.scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-3
        n = x.shape[1]
        p = [rng.normal(0, n**-0.5, (n, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        z = (x - self.mean) / self.scale
        for _ in range(EPOCHS):
            rng.shuffle(used)
            for i in range(0, len(used), BATCH):
                k = used[i : i + BATCH]
                h = np.tanh(z[k] @ p[0] + p[1])
                d = (sigmoid(h @ p[2] + p[3][0]) - y[k]) / len(k)
                back_h = np.outer(d, p[2]) * (1 - h * h)
                grads = [z[k].T @ back_h + 1e-4 * p[0], back_h.sum(axis=0), h.T @ d + 1e-4 * p[2], np.array([d.sum()])]
                step += 1
                for a, g, mm, vv in zip(p, grads, m, v, strict=True):
                    mm *= 0.9
                    mm += 0.1 * g
                    vv *= 0.999
                    vv += 0.001 * g * g
                    a -= RATE * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
        self.layers = p
        logits, target = self.logits(x[held]), y[held]
        grid = np.exp(np.linspace(-1.5, 2.5, 81))
        loss = [np.logaddexp(0, -logits / t).dot(target) + np.logaddexp(0, logits / t).dot(1 - target) for t in grid]
        self.t = float(grid[int(np.argmin(loss))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2[0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.t) if self.layers else np.full(len(x), self.prior)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def pool_texts(column: pa.Array, both: np.ndarray) -> np.ndarray:
    """Pooled features of every row of a string column."""
    raw, off = column_bytes(column)
    out = np.zeros((len(column), 2 * DIMS + 1), np.float32)
    for lo, hi in row_blocks(off, CHUNK):
        rows, bounds = token_rows(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        n = np.diff(bounds)
        for i in np.flatnonzero(n):
            mine = rows[bounds[i] : bounds[i + 1]]
            if n[i] > 4096:  # a long text by its counts
                counts = np.bincount(mine)
                used = np.flatnonzero(counts)
                out[lo + i, :-1] = (counts[used] / n[i]).astype(np.float32) @ both[used]
            else:
                out[lo + i, :-1] = both[mine].mean(axis=0)
        out[lo:hi, -1] = np.log1p(n) / 10
    return out


def features_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, 2 * DIMS + 1).astype(np.float64)


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5


def train(features: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> Network:
    """Fit on at most ``sample`` labelled rows that are not held out: those with the smallest hashes."""
    chosen = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(F.col(id_col)) != 0)).select(id_col, F.col(label_col).cast("double").alias("y"), F.pmod(F.xxhash64(id_col), F.lit(1 << 20)).alias("h"))
    n = chosen.count()
    if n > sample:
        chosen = chosen.filter(F.col("h") <= int((1 << 20) * min(1.0, 1.2 * sample / n)))
    rows = features.join(chosen, id_col).select("h", id_col, "y", "features").orderBy("h", id_col, "features", "y").limit(sample)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(features_of(b.column(1)), b.column(0).to_numpy()) for b in batches if b.num_rows]
        x = np.concatenate([p[0] for p in parts]) if parts else np.zeros((0, 2 * DIMS + 1))
        y = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Network(x, y))], pa.binary())], names=["network"])

    # the bounded sample is fitted in one task; only the weights come to the driver
    fitted = rows.select("y", "features").coalesce(1).mapInArrow(fit, "network binary").first()
    return pickle.loads(fitted["network"]) if fitted else Network(np.zeros((0, 2 * DIMS + 1)), np.zeros(0))


def scored(features: DataFrame, network: Network, id_col: str = "doc_id") -> DataFrame:
    """(id, score): the probability of label 1."""
    kind = features.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(network.probabilities(features_of(b.column(1))), pa.float64())], names=[id_col, "score"])

    return features.select(id_col, "features").mapInArrow(run, f"{id_col} {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row of ``docs``; word vectors from all of them, labels only from ``labels``."""
    vectors = word_vectors(context_vectors(docs, text_col))
    features = written(pooled(docs, vectors, id_col, text_col), "pooled")
    return scored(features, train(features, labels, id_col), id_col)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with all their columns.

    Scores are worked out beside the text in a last pass: texts are not shuffled.
    """
    vectors = word_vectors(context_vectors(docs, text_col))
    network = train(written(pooled(docs, vectors, id_col, text_col), "pooled"), labels, id_col)
    shared = docs.sparkSession.sparkContext.broadcast(np.concatenate([vectors, vectors**2], axis=1))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = network.probabilities(pool_texts(b.column(at), shared.value).astype(np.float64)) >= threshold
            yield b.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op7_quality": op7_quality}
ORACLE: dict[str, str] = {}
