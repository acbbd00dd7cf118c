"""Token files: a static range asymmetric numeral system over shared frequency tables.

Documents are encoded to token ids where they lie, each task counting the ids it makes; the counts become one
shared frequency table of 2 ** 20 slots. The ids, not the texts, are then sorted by document id into range
partitions (equal ids are told apart by a hash, so a third of all rows may share one) and gathered into groups
of whole documents. Each group is then coded on its own, in blocks of at most ``BLOCK`` ids: a block is a grid of segments of
``STEPS`` x ``LANES`` ids, each lane with a state of 64 bits that gives off 32-bit words. A block's header
holds, for each segment, the checkpoint (place in the word stream, lane states) from which it decodes alone,
and the CRC-32 of the ids; a wrong checksum is an error. Files are written by Spark's committer, so a lost
executor leaves no half-written file; readers decode groups in any order.

Layout of ``path``: ``groups`` (Parquet, uncompressed: part, part_start, doc_ids, n_tokens, payloads),
``parts`` (part, start: ids before each part) and ``frequencies`` (id, frequency).

Cases: null or empty text has the end id only; a null id sorts first; repeated rows are separate documents;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelloom.llm import tokens
from labelloom.llm.text import column_bytes
from labelloom.session import shared_dir, small_batches, table, written

SLOT_BITS, LOW = 20, 1 << 31
LANES, STEPS = 32, 512
BLOCK = 1 << 20  # ids
MAGIC = b"RNS1"
PLAIN = "counted boolean, doc_id long, n_tokens long, ids binary, n binary"
GROUPS = "part int, part_start long, doc_ids array<long>, n_tokens array<long>, payloads array<binary>"


# -- the coder -----------------------------------------------------------------------------------------


def frequencies(counts: np.ndarray, bits: int = SLOT_BITS) -> np.ndarray:
    """Integer frequencies with sum 2 ** bits in proportion to ``counts``; an id that occurs gets one at least."""
    total, slots = int(counts.sum()), 1 << bits
    if not total:
        return np.zeros(len(counts), np.int64)
    if np.count_nonzero(counts) > slots:
        raise ValueError("more different ids than slots")
    f = np.where(counts > 0, np.maximum(1, counts * slots // total), 0).astype(np.int64)
    order = np.argsort(-f, kind="stable")
    spare = slots - int(f.sum())
    if spare > 0:
        f[order[0]] += spare
    i = 0
    while spare < 0:  # taken from the most frequent, a share of each
        take = min(-spare, max(1, int(f[order[i]]) // 2)) if f[order[i]] > 1 else 0
        f[order[i]] -= take
        spare += take
        i = (i + 1) % len(order)
    return f


class Coder:
    def __init__(self, f: np.ndarray):
        self.f = f.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(f)])[:-1].astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(f), dtype=np.uint32), f)
        self.common = int(f.argmax()) if len(f) else 0

    def encode(self, ids: np.ndarray) -> bytes:
        n = len(ids)
        if not n:
            return struct.pack("<4sQHHII", MAGIC, 0, LANES, 0, 0, 0)
        steps = min(STEPS, -(-n // LANES))
        segments = -(-n // (steps * LANES))
        grid = np.full(segments * steps * LANES, self.common, np.int64)
        grid[:n] = ids
        grid = grid.reshape(segments, steps, LANES).transpose(1, 0, 2)
        x = np.full((segments, LANES), LOW, np.uint64)
        words = np.empty((steps, segments, LANES), np.uint32)
        out = np.empty((steps, segments, LANES), bool)
        for t in range(steps - 1, -1, -1):
            s = grid[t]
            f = self.f[s]
            full = x >= (f << np.uint64(31 - SLOT_BITS + 32))
            words[t], out[t] = x, full  # the low 32 bits
            x = np.where(full, x >> np.uint64(32), x)
            q = x // f
            x = (q << np.uint64(SLOT_BITS)) + (x - q * f) + self.start[s]
        out = out.transpose(1, 0, 2)
        stream = words.transpose(1, 0, 2)[out]
        sizes = out.sum(axis=(1, 2)).astype("<u4")
        head = struct.pack("<4sQHHII", MAGIC, n, LANES, steps, segments, zlib.crc32(ids.astype("<u4").tobytes()))
        return head + sizes.tobytes() + x.astype("<u8").tobytes() + stream.astype("<u4").tobytes()

    def decode(self, payload: bytes) -> np.ndarray:
        magic, n, lanes, steps, segments, crc = struct.unpack_from("<4sQHHII", payload)
        if magic != MAGIC:
            raise ValueError("not a block of this format")
        if not n:
            return np.zeros(0, np.uint32)
        at = struct.calcsize("<4sQHHII")
        sizes = np.frombuffer(payload, "<u4", segments, at).astype(np.int64)
        at += 4 * segments
        x = np.frombuffer(payload, "<u8", segments * lanes, at).astype(np.uint64).reshape(segments, lanes)
        at += 8 * segments * lanes
        stream = np.concatenate([np.frombuffer(payload, "<u4", -1, at), np.zeros(1, "<u4")]).astype(np.uint64)
        place = np.concatenate([[0], np.cumsum(sizes)])[:-1, None] - 1
        out = np.empty((steps, segments, lanes), np.uint32)
        low, slots = np.uint64(LOW), np.uint64((1 << SLOT_BITS) - 1)
        for t in range(steps):
            slot = x & slots
            s = self.symbol[slot]
            out[t] = s
            x = self.f[s] * (x >> np.uint64(SLOT_BITS)) + slot - self.start[s]
            need = x < low
            at_word = place + np.cumsum(need, axis=1)
            x = np.where(need, (x << np.uint64(32)) | stream.take(at_word, mode="clip"), x)  # a broken stream may point anywhere
            place = at_word[:, -1:]
        ids = out.transpose(1, 0, 2).reshape(-1)[:n]
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError("checksum of a block does not match")
        return ids


# -- writing and reading ---------------------------------------------------------------------------------


def plain_ids(docs: DataFrame, tokenizer: str, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``PLAIN``: the ids of each document with the end id (two bytes each where the vocabulary allows,
    else four), and behind those of a task one row of the ids it has counted and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer)
        size = enc.tokenizer.get_vocab_size(True)
        kind, total = id_type(size), np.zeros(size, np.int64)
        names = ["counted", "doc_id", "n_tokens", "ids", "n"]
        for b in batches:
            ids, off = tokens.with_end(*enc.batch(tokens.texts_of(b.column(1))))
            total += np.bincount(ids, minlength=size)
            n, data = b.num_rows, ids.astype(kind).tobytes()
            column = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer((off * kind.itemsize).astype(np.int64)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, bool)), b.column(0), pa.array(np.diff(off)), column.cast(pa.binary()), pa.nulls(n, pa.binary())], names=names)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([True]), pa.nulls(1, pa.int64()), pa.array([len(used)], pa.int64()), pa.array([used.astype(kind).tobytes()], pa.binary()), pa.array([total[used].tobytes()], pa.binary())], names=names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, PLAIN)


def id_type(size: int) -> np.dtype:
    """The type that plain ids below ``size`` are kept in."""
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> None:
    """Encode all ``docs`` and write the token files of this module's format to ``path``."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    small_batches(spark)
    kind = id_type(Tokenizer.from_file(tokenizer).get_vocab_size(True))
    plain = written(plain_ids(docs, tokenizer, id_col, text_col), "plain-ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for used, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(used, kind).astype(np.int64)), pa.array(np.frombuffer(n, np.int64))], names=["id", "n"])

    # at most one row for each id of the vocabulary
    counted = plain.filter("counted").select("ids", "n").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in counted), default=-1) + 1, np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    f = frequencies(counts)
    spark.createDataFrame([(int(i), int(f[i])) for i in np.flatnonzero(f)], "id long, frequency long").coalesce(1).write.parquet(f"{path}/frequencies")
    shared = spark.sparkContext.broadcast(f)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, before = Coder(shared.value), TaskContext.get().partitionId(), 0
        names: list = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal names, sizes, held, size, before
            ids = np.concatenate(held)
            coded = [coder.encode(ids[i : i + block].astype(np.uint32)) for i in range(0, len(ids), block)]
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())), pa.array([coded], pa.list_(pa.binary()))],
                names=["part", "part_start", "doc_ids", "n_tokens", "payloads"],
            )
            before += size
            names, sizes, held, size = [], [], [], 0
            return row

        for b in batches:
            raw, off = column_bytes(b.column(2))
            ids, n = raw.view(kind) if len(raw) else np.zeros(0, kind), np.diff(off) // kind.itemsize
            ends, lo = np.cumsum(n), 0
            while lo < b.num_rows:  # as many whole documents as fill half a block
                done = int(ends[lo - 1]) if lo else 0
                hi = min(b.num_rows, int(np.searchsorted(ends, done + block // 2 - size)) + 1)
                names += b.column(0).slice(lo, hi - lo).to_pylist()
                sizes += n[lo:hi].tolist()
                held.append(ids[done : int(ends[hi - 1])].copy())
                size += int(ends[hi - 1]) - done
                lo = hi
                if size >= block // 2:
                    yield flush()
        if names:
            yield flush()

    rows = plain.filter("NOT counted").select("doc_id", F.xxhash64("ids").alias("tie"), "ids")
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.mapInArrow(encode, GROUPS).write.option("compression", "none").parquet(f"{path}/groups")
    parts = spark.read.schema(GROUPS).parquet(f"{path}/groups").select("part", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b).alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    # one row for each range partition
    parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("start")).coalesce(1).write.parquet(f"{path}/parts")


def read_groups(spark: SparkSession, path: str, schema: str, per_document) -> DataFrame:
    """Decode all groups of ``path``; ``per_document(doc_id, start, ids)`` makes the values of a row of ``schema``."""
    listed = spark.read.schema("id long, frequency long").parquet(f"{path}/frequencies").collect()
    f = np.zeros(max((r["id"] for r in listed), default=-1) + 1, np.int64)
    for r in listed:
        f[r["id"]] = r["frequency"]
    shared = spark.sparkContext.broadcast(f)
    fields = spark.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for b in batches:
            for start, names, sizes, payloads in zip(*(b.column(k) for k in range(4)), strict=True):
                ids = np.concatenate([coder.decode(p.as_py()) for p in payloads])
                at, first, rows = 0, start.as_py(), []
                for name, n in zip(names.as_py(), sizes.as_py(), strict=True):
                    rows.append(per_document(name, first + at, ids[at : at + n]))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    groups = spark.read.schema(GROUPS).parquet(f"{path}/groups")
    parts = spark.read.schema("part int, start long").parquet(f"{path}/parts")
    placed = groups.join(F.broadcast(parts), "part").select((F.col("part_start") + F.col("start")).alias("start"), "doc_ids", "n_tokens", "payloads")
    return placed.mapInArrow(decode, fields)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of all documents in the files under ``path``."""
    return read_groups(spark, path, "doc_id long, start long, ids array<int>", lambda name, start, ids: (name, start, ids.astype(np.int32).tolist()))


def op4_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), path, tokens.default_path())
    digest = lambda name, start, ids: (name, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
    return read_groups(spark, path, "doc_id long, start long, n_tokens long, ids_crc32 long", digest)


QUERIES = {"op4_rans_token_files": op4_rans_token_files}
ORACLE: dict[str, str] = {}
