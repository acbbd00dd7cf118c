"""Bulk-synchronous best-fit packing of token sequences.

Documents are encoded to ids; those over the capacity are cut into full pieces and a rest. A piece over half the
capacity opens a sequence of its own. The others, first those over a quarter of the capacity, then the rest, find
their places in rounds, each of them a few Spark jobs over tables of waiting pieces and of gaps:

1. sweep: pieces and gaps are range-sorted together by falling size. A piece takes its successor, the smallest
   free gap that holds it, which is a match of brackets: gaps open, pieces close. Every range is matched by a
   task of its own; what stays open or unclosed there is numbered, and the counts of each range (all that the
   driver sees) tell which numbers of which ranges meet;
2. conflicts over a gap are settled by rank in that order: length, then number of the piece;
3. update: what a sequence took is subtracted from its gap. New sequences are opened for pieces that fit in no
   gap: enough to take them all at once while the volume of all pieces needs as many anyway, else as many as
   their own volume needs.

A gap that holds the longest waiting piece several times offers as many equal slots, so that short pieces fill a
long gap in one round instead of one a round. The rounds needed grow with the capacity, hardly with the documents.

Cases: null or empty text is one piece with the end id only; repeated rows are packed as separate documents;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelloom.llm import tokens
from labelloom.session import small_batches, table, written

CAPACITY = 4096
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SWEPT = "n long, length long, sequence_id long, part int, at long"
MEETINGS = "part int, at_from long, at_to long, slot_part int, slot_last long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", memory: int = tokens.MEMORY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and end id, cut after ``capacity``.

    memory: words that a worker's encoder remembers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer, memory)
        for b in batches:
            ids, off = tokens.with_end(*enc.batch(tokens.texts_of(b.column(1))))
            sizes = np.diff(off)
            n = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, sizes[doc] - start)
            data = memoryview(ids.astype("<u4")).cast("B")
            at = (off[:-1][doc] + start) * 4
            crc = [zlib.crc32(data[a : a + 4 * k]) for a, k in zip(at.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, PIECES)


def swept_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``SWEPT`` from one range of (size, kind, id): slots have kind 0, pieces 1.

    Pieces come out with the sequence they take, or without one and with their number among such (``at``); slots
    that stay free follow, without ``n``, numbered in their order.
    """
    part, free, missed = TaskContext.get().partitionId(), array("q"), 0

    def rows(n: pa.Array, length: pa.Array, sequence: pa.Array, at: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([n, length, sequence, pa.array(np.full(len(at), part, np.int32)), pa.array(at)], names=["n", "length", "sequence_id", "part", "at"])

    for b in batches:
        piece = b.column(1).to_numpy() == 1
        took: list[int | None] = []
        for is_piece, i in zip(piece.tolist(), b.column(2).to_pylist(), strict=True):
            if not is_piece:
                free.append(i)
            else:
                took.append(free.pop() if free else None)
        sequence = pa.array(took, pa.int64())
        none = sequence.is_null().to_numpy(zero_copy_only=False)
        at = np.where(none, missed + np.cumsum(none) - 1, -1).astype(np.int64)
        missed += int(none.sum())
        mask = pa.array(piece)
        yield rows(b.column(2).filter(mask), b.column(0).filter(mask), sequence, at)
    for lo in range(0, len(free), 1 << 16):
        left = free[lo : lo + (1 << 16)]
        none = pa.nulls(len(left), pa.int64())
        yield rows(none, none, pa.array(np.array(left, np.int64)), np.arange(lo, lo + len(left)))


def meetings(totals: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Rows of ``MEETINGS`` from (part, missed pieces, free slots) of each range: at most two for each range.

    Piece ``at_from + i`` of a range takes slot ``slot_last - i`` of an earlier one.
    """
    free: list[list[int]] = []
    out = []
    for part, missed, slots in sorted(totals):
        at = 0
        while at < missed and free:
            other, left = free[-1]
            take = min(left, missed - at)
            out.append((part, at, at + take, other, left - 1))
            at += take
            if take == left:
                free.pop()
            else:
                free[-1][1] -= take
        if slots:
            free.append([part, slots])
    return out


def measures(lengths: Column, name: str = "") -> list[Column]:
    """Number, least and greatest of those ``lengths`` that are not null."""
    return [F.count(lengths).alias(f"count{name}"), F.min(lengths).alias(f"shortest{name}"), F.max(lengths).alias(f"longest{name}")]


def room(longest: int | None) -> list[Column]:
    """The widest gap, and how many gaps hold ``longest``."""
    return [F.coalesce(F.max("gap"), F.lit(0)).alias("widest"), F.count_if(F.col("gap") >= (longest or 0)).alias("wide")]


def settle(waiting: DataFrame, slots: DataFrame, parts: int | None = None, left: Observation | None = None) -> DataFrame:
    """One sweep: (n, length, sequence_id) of every row of ``waiting`` (n, length); sequence_id is null if no slot of
    ``slots`` (sequence_id, size) is left for it.

    parts: number of ranges, if Spark is not to choose it. left: observes the ``measures`` of what still waits.
    """
    spark = waiting.sparkSession
    events = slots.select("size", F.lit(0).alias("kind"), F.col("sequence_id").alias("id")).union(waiting.select("length", F.lit(1), "n"))
    order = [F.desc("size"), F.asc("kind"), F.asc("id")]
    dealt = events.repartitionByRange(parts, *order) if parts else events.repartitionByRange(*order)
    swept = written(dealt.sortWithinPartitions(*order).mapInArrow(swept_range, SWEPT), "swept")
    # one row for each range
    totals = swept.filter("at >= 0").groupBy("part").agg(F.count("n").alias("missed"), F.count_if(F.col("n").isNull()).alias("slots")).collect()
    meet = meetings([tuple(t) for t in totals])
    pieces_ = swept.filter("n IS NOT NULL")
    if not meet:
        settled = pieces_.select("n", "length", "sequence_id")
        return written(observed(settled, left), "settled") if left else settled
    spots = F.broadcast(spark.createDataFrame(meet, MEETINGS))  # two rows for each range at most
    missed = pieces_.filter("at >= 0").alias("p").join(spots.alias("m"), F.expr("p.part = m.part AND p.at >= m.at_from AND p.at < m.at_to"), "left")
    missed = missed.selectExpr("p.n", "p.length", "m.slot_part", "m.slot_last - (p.at - m.at_from) AS slot")
    free = swept.filter("n IS NULL").selectExpr("part AS slot_part", "at AS slot", "sequence_id")
    across = missed.join(free, ["slot_part", "slot"], "left").select("n", "length", "sequence_id")
    return written(observed(pieces_.filter("at < 0").select("n", "length", "sequence_id").union(across), left), "settled")


def observed(settled: DataFrame, left: Observation | None) -> DataFrame:
    return settled.observe(left, *measures(F.when(F.col("sequence_id").isNull(), F.col("length")))) if left else settled


def slots_of(gaps: DataFrame, shortest: int, longest: int, most: int) -> DataFrame:
    """(sequence_id, size): a gap as up to ``most`` equal slots that hold ``longest``, or as one if it doesn't hold it twice."""
    n = F.greatest(F.lit(1), F.least(F.floor(F.col("gap") / longest), F.lit(most))).cast("int")
    split = gaps.filter(F.col("gap") >= shortest).select("sequence_id", "gap", n.alias("slots"))
    return split.select("sequence_id", F.floor(F.col("gap") / F.col("slots")).alias("size"), F.explode(F.array_repeat(F.lit(0), F.col("slots")))).select("sequence_id", "size")


def place(rows: DataFrame, capacity: int, parts: int | None = None) -> DataFrame:
    """(n, sequence_id) for all of ``rows`` (n, length; n unique and not negative).

    A sequence has the number of the piece that opened it, or a negative one if it was opened for several.
    """
    spark = rows.sparkSession
    long_ = F.col("length") > capacity // 2
    placed = [rows.filter(long_).select("n", F.col("n").alias("sequence_id"))]
    gaps = rows.filter(long_ & (F.col("length") < capacity)).select(F.col("n").alias("sequence_id"), (capacity - F.col("length")).alias("gap"))
    classes = [(capacity // 4, capacity // 2), (0, capacity // 4)] if capacity >= 4 else [(0, capacity // 2)]
    within = [(F.col("length") > least) & (F.col("length") <= above) for least, above in classes]
    sizes = rows.agg(F.count_if(long_).alias("own"), F.coalesce(F.sum("length"), F.lit(0)).alias("total"), *[m for i, x in enumerate(within) for m in measures(F.when(x, F.col("length")), f"_{i}")]).first()
    needed, opened = -(-sizes["total"] // capacity) - sizes["own"], 0
    for i, x in enumerate(within):
        waiting = rows.filter(x).select("n", "length")
        count, shortest, longest = (sizes[f"{k}_{i}"] for k in ("count", "shortest", "longest"))
        widest, wide = gaps.agg(*room(longest)).first() if count else (0, 0)
        # what the next round asks of pieces and gaps is observed while they are written
        while count:
            if widest < longest:
                homeless, volume = waiting.filter(F.col("length") > widest).agg(F.count(F.lit(1)), F.sum("length")).first()
                new = max(-(-volume // capacity), min(-(-homeless // (capacity // longest)), needed - opened))
                fresh = spark.range(opened, opened + new).select((-1 - F.col("id")).alias("sequence_id"), F.lit(capacity).cast("long").alias("gap"))
                gaps, opened, wide = gaps.union(fresh), opened + new, wide + new
            left, free = Observation(), Observation()
            settled = settle(waiting, slots_of(gaps, shortest, longest, -(-count // wide)), parts, left)
            count, shortest, longest = (left.get[k] for k in ("count", "shortest", "longest"))
            found = settled.filter("sequence_id IS NOT NULL")
            placed.append(found.select("n", "sequence_id"))
            taken = gaps.union(found.select("sequence_id", -F.col("length")))
            gaps = written(taken.groupBy("sequence_id").agg(F.sum("gap").alias("gap")).filter("gap > 0").observe(free, *room(longest)), "gaps")
            widest, wide = (free.get[k] for k in ("widest", "wide"))
            waiting = settled.filter("sequence_id IS NULL").select("n", "length")
    return reduce(DataFrame.union, placed)


def pack(rows: DataFrame, capacity: int = CAPACITY, parts: int | None = None) -> DataFrame:
    """``rows`` of ``PIECES`` with ``sequence_id`` and ``offset``."""
    rows = written(rows.withColumn("n", F.monotonically_increasing_id()), "pieces")
    out = rows.join(place(rows.select("n", "length"), capacity, parts), "n")
    # a sequence has as many pieces as its capacity at most
    before = W.partitionBy("sequence_id").orderBy("n").rowsBetween(W.unboundedPreceding, -1)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", memory: int = tokens.MEMORY) -> DataFrame:
    """Encode, cut and pack all rows of ``docs``."""
    small_batches(docs.sparkSession)
    return pack(pieces(docs, tokenizer, capacity, id_col, text_col, memory), capacity)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokens.default_path())


QUERIES = {"op3_best_fit_packing": op3_best_fit_packing}
ORACLE: dict[str, str] = {}
