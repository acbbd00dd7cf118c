"""Benchmark decontamination with an FM-index for each training shard.

A shard is a block of whole documents inside a task. Its words become numbers of the benchmark's vocabulary
(0 for any other word and between documents); runs too short to hold a window are left out, equal documents
enter once. The suffixes of this sequence are sorted (prefix doubling over unsorted groups only), which gives
the Burrows-Wheeler transform; a wavelet tree over its bits answers rank queries. All test phrases are searched
backwards at once, interval by interval; the rows of the final intervals walk back to the nearest sampled
suffix position, which locates the occurrences. Overlapping occurrences merge into removal spans.

A test phrase is a window of 10 consecutive words of a benchmark item, or the whole item if it is shorter.
A benchmark of up to ``BLOCK`` windows is collected and broadcast as a whole. A larger one is cut into blocks of at
most twice as many, long items too; documents are numbered and written, and each block is collected, broadcast,
searched by a job of its own, which writes the rows it hits, and released before the next one. So neither the driver
nor a task ever holds more than a block.

Cases: null text, or text without words, has no words and no hits; null or wordless items are never found; items
that share an id are one item, found by the windows of any of them; items without an id are one item as well, the
last (counted, but without a name); repeated documents each get their rows; empty tables give no rows, or no hits;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm.text import byte_class, column_bytes, lower_table, row_blocks, span_hashes, word_spans
from labelloom.operators.ranks import dealt_ranges, running_sums
from labelloom.session import small_batches, table, written

WINDOW = 10
SAMPLE = 16  # every so many-th suffix position is kept
#: Benchmark windows searched (and broadcast) at a time, twice as many at most: some 50 MB of hashes.
BLOCK = 500_000
SHARD_BYTES = 1 << 23
WORD_BYTES = ~byte_class(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
LOWER = lower_table()


# -- the index -------------------------------------------------------------------------------------------


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``s`` (non-negative integers); a shorter suffix sorts first."""
    n = len(s)
    width = max(1, int(s.max()).bit_length()) if n else 1
    span = max(1, 62 // (width + 1))  # symbols that one key holds
    key, padded = np.zeros(n, np.int64), np.concatenate([s.astype(np.int64) + 1, np.zeros(span, np.int64)])
    for i in range(span):
        key = (key << (width + 1)) | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    sorted_keys = key[order]
    new = np.empty(n, bool)
    new[:1] = True
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    rank = np.empty(n + 1, np.int64)
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order], rank[n] = group + 1, 0
    h = span
    while True:
        # rows of groups of more than one suffix, in order
        alone = new & np.concatenate([new[1:], [True]])
        rows = np.flatnonzero(~alone)
        if not len(rows):
            return order
        suffixes = order[rows]
        first, second = group[rows], rank[np.minimum(suffixes + h, n)]
        by = np.lexsort((second, first))
        suffixes, first, second = suffixes[by], first[by], second[by]
        order[rows] = suffixes
        fresh = np.empty(len(rows), bool)
        fresh[0] = True
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        new[rows] = fresh
        group[rows] = np.maximum.accumulate(np.where(fresh, rows, 0))
        rank[suffixes] = group[rows] + 1
        h *= 2


class WaveletTree:
    """Rank of any symbol in a sequence: one bit vector with running counts for each bit, high to low."""

    def __init__(self, s: np.ndarray, bits: int):
        self.levels, self.zeros = [], []
        for b in range(bits - 1, -1, -1):
            bit = (s >> b) & 1
            ones = np.zeros(len(s) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((b, ones))
            self.zeros.append(len(s) - int(ones[-1]))
            s = np.concatenate([s[bit == 0], s[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        lo, hi = np.zeros_like(at), at
        for (b, ones), zeros in zip(self.levels, self.zeros, strict=True):
            one = (symbol >> b) & 1 == 1
            l1, h1 = ones[lo].astype(np.int64), ones[hi].astype(np.int64)
            lo, hi = np.where(one, zeros + l1, lo - l1), np.where(one, zeros + h1, hi - h1)
        return hi - lo


class FmIndex:
    """FM-index of a sequence of integers below ``symbols``."""

    def __init__(self, s: np.ndarray, symbols: int, sample: int = SAMPLE):
        n = self.n = len(s)
        order = suffix_array(s)
        # the empty suffix is row 0; the row of the whole sequence has no symbol before it
        self.full_row = int(np.flatnonzero(order == 0)[0]) + 1 if n else 0
        before = np.concatenate([s[n - 1 :], s[order - 1]]) if n else s
        self.bwt = before.astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=symbols))])[:-1] + 1 if n else np.zeros(symbols, np.int64)
        self.tree = WaveletTree(self.bwt, max(1, (symbols - 1).bit_length()))
        place = np.concatenate([[n], order])
        self.sampled = place % sample == 0
        self.row_of_sample = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = place[self.sampled]

    def occurrences(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Symbols of the transform equal to ``symbol`` before row ``at``, without the wrap-around one."""
        wrapped = (symbol == self.bwt[self.full_row]) & (at > self.full_row)
        return self.tree.rank(symbol, at) - wrapped

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals of all phrases (rows of ``phrases``, left-aligned), by backward search."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n + 1, np.int64)
        for step in range(int(sizes.max(initial=0))):
            live = np.flatnonzero((step < sizes) & (lo < hi))
            if not len(live):
                break
            c = phrases[live, sizes[live] - 1 - step]
            lo[live] = self.first[c] + self.occurrences(c, lo[live])
            hi[live] = self.first[c] + self.occurrences(c, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes of ``rows``: walk back to a sampled one."""
        out, rows, walked = np.empty(len(rows), np.int64), rows.copy(), 0
        live = np.arange(len(rows))
        while len(live):
            r = rows[live]
            done = self.sampled[r]
            out[live[done]] = self.samples[self.row_of_sample[r[done]]] + walked
            live, r = live[~done], r[~done]
            c = self.bwt[r]
            rows[live] = self.first[c] + self.occurrences(c, r)
            walked += 1
        return out


# -- the operator ----------------------------------------------------------------------------------------


def split_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word of a column, words before each row, byte offset of each row."""
    raw, off = column_bytes(column)
    raw = LOWER[raw]
    starts, ends, rows = word_spans(raw, off, WORD_BYTES)
    return span_hashes(raw, starts, ends), starts, ends, rows, off


class Phrases:
    """The windows of some benchmark items over their own vocabulary."""

    def __init__(self, items: list[tuple[object, str]], window: int = WINDOW):
        h, _, _, rows, _ = split_words(pa.array([t for _, t in items], pa.string()))
        self.vocabulary = np.unique(h)
        symbols = np.searchsorted(self.vocabulary, h) + 1
        seen: dict[bytes, int] = {}
        windows, self.items = [], []
        for i, (name, _) in enumerate(items):
            w = symbols[rows[i] : rows[i + 1]]
            for j in range(max(len(w) - window, 0) + 1 if len(w) else 0):
                key = w[j : j + window].tobytes()
                k = seen.setdefault(key, len(windows))
                if k == len(windows):
                    windows.append(w[j : j + window])
                    self.items.append([])
                if not self.items[k] or self.items[k][-1] != name:
                    self.items[k].append(name)
        self.sizes = np.array([len(w) for w in windows], np.int64)
        self.table = np.zeros((len(windows), window), np.int64)
        for k, w in enumerate(windows):
            self.table[k, : len(w)] = w
        self.shortest = int(self.sizes.min()) if windows else 0

    def __len__(self) -> int:
        return len(self.sizes)

    def symbols(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == h, at + 1, 0)


def find_windows(phrases: Phrases, h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word index, window) of each occurrence in a shard whose document i has the words rows[i] to rows[i + 1]."""
    none = np.zeros(0, np.int64)
    if not len(h) or not len(phrases):
        return none, none
    s = phrases.symbols(h)
    # runs of vocabulary words inside one document; shorter ones than any window hold none
    edge = np.zeros(len(s) + 1, bool)
    edge[rows] = True
    inside = s > 0
    first = inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]]))
    last = inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    keep = b - a >= phrases.shortest
    a, b = a[keep], b[keep]
    if not len(a):
        return none, none
    # the kept runs, each with a 0 behind it; origin: where each symbol of the sequence was
    size = b - a + 1
    ends = np.cumsum(size)
    origin = np.repeat(a - (ends - size), size) + np.arange(ends[-1])
    sequence = s[np.minimum(origin, len(s) - 1)]
    sequence[ends - 1] = 0
    index = FmIndex(sequence, len(phrases.vocabulary) + 1)
    lo, hi = index.search(phrases.table, phrases.sizes)
    n = hi - lo
    which = np.repeat(np.arange(len(phrases)), n)
    where = index.locate(np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum()))
    return origin[where], which


def in_order(items: set) -> list:
    return sorted(items, key=lambda x: (x is None, x if x is not None else 0))


def scan_shard(phrases: Phrases, column: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[list], list[np.ndarray]]:
    """Per row of a string column: words, merged hit word spans (k x 2), items found, byte spans to remove."""
    encoded = column.dictionary_encode()
    texts, index = encoded.dictionary, encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    h, starts, ends, rows, off = split_words(texts)
    at, which = find_windows(phrases, h, rows)
    n = len(texts)
    doc = np.searchsorted(rows, at, "right") - 1
    order = np.lexsort((at, doc))
    at, which, doc = at[order], which[order], doc[order]
    bounds = np.searchsorted(doc, np.arange(n + 1))
    words, spans, items, cuts = np.diff(rows), [], [], []
    empty = np.zeros((0, 2), np.int64)
    for i in range(n):
        lo, hi = bounds[i], bounds[i + 1]
        if lo == hi:
            spans.append(empty)
            items.append([])
            cuts.append(empty)
            continue
        a, b = at[lo:hi], np.maximum.accumulate(at[lo:hi] + phrases.sizes[which[lo:hi]])
        new = np.concatenate([[True], a[1:] > b[:-1]])
        first, last = a[new], b[np.concatenate([new[1:], [True]])]
        spans.append(np.stack([first - rows[i], last - rows[i]], axis=1))
        cuts.append(np.stack([starts[first] - off[i], ends[last - 1] - off[i]], axis=1))
        items.append(in_order({x for k in np.unique(which[lo:hi]).tolist() for x in phrases.items[k]}))
    zero = np.zeros(1, words.dtype)
    words = np.concatenate([words, zero])[index]  # index -1: null
    spans, items, cuts = [*spans, empty], [*items, []], [*cuts, empty]
    return words, [spans[i] for i in index], [items[i] for i in index], [cuts[i] for i in index]


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, most: int) -> tuple[DataFrame, int]:
    """(i, t, block) of the benchmark's items, and the number of blocks.

    Where there are several, items are cut into pieces of at most ``most`` windows, which overlap by a word less than
    a window, and pieces are dealt in the order of a hash until a block is full.
    """
    items = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).filter("t IS NOT NULL")
    words = F.regexp_extract_all(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("[0-9a-z\\x{80}-\\x{10FFFF}]+"), 0)
    counted = items.withColumn("w", F.greatest(F.size(words) - (window - 1), F.lit(1)))
    # one row: the number of windows
    total = int(counted.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0])
    if total <= most:
        return items.withColumn("block", F.lit(0).cast("long")), 1
    cut = counted.select("i", words.alias("words"), F.explode(F.sequence(F.lit(0), F.col("w") - 1, F.lit(most))).alias("at"))
    pieces = cut.select("i", "at", F.array_join(F.slice("words", F.col("at") + 1, F.lit(most + window - 1)), " ").alias("t"), F.greatest(F.least(F.size("words") - F.col("at") - (window - 1), F.lit(most)), F.lit(1)).alias("n"))
    pieces = pieces.withColumn("o", F.xxhash64("i", "at", "t")).withColumn("r", F.monotonically_increasing_id())
    placed = running_sums(dealt_ranges(pieces, "o", "r"), (), ("o", "r"), {"before": F.col("n")})
    return written(placed.select("i", "t", F.expr(f"before DIV {most}").alias("block")), "benchmark-blocks"), -(-total // most)


FOUND = "n_words long, spans array<array<long>>, items array<{item}>, cuts array<array<long>>"


def merged(parts: list[list]) -> list[list[int]]:
    """Spans of several lists, overlapping and touching ones as one."""
    out: list[list[int]] = []
    for a, b in sorted((a, b) for p in parts for a, b in p):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` with n_words, spans (merged word ranges that are hit),
    items (sorted) and cuts (the spans as byte ranges of the text)."""
    spark = docs.sparkSession
    small_batches(spark)
    items, blocks = benchmark_blocks(benchmark, item_id, item_text, window, block)
    item_type = benchmark.schema[item_id].dataType.simpleString()
    phrases = lambda rows: Phrases([(r["i"], r["t"]) for r in rows.select("i", "t").collect()], window)
    chosen = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text"))
    if blocks == 1:
        return scan_block(chosen, spark.sparkContext.broadcast(phrases(items)), item_type)
    # names of our own, and a number for each row, by which the blocks' hits meet again
    own = [f"__{i}" for i in range(len(keep))]
    numbered = written(chosen.toDF(*own, "__text").withColumn("__row", F.monotonically_increasing_id()), "scanned-texts")
    hits = None
    for k in range(blocks):
        shared = spark.sparkContext.broadcast(phrases(items.filter(F.col("block") == k)))
        found = scan_block(numbered.select("__row", "__text"), shared, item_type)
        found = written(found.filter((F.size("spans") > 0) | F.lit(k == 0)), "block-hits")
        shared.destroy()
        hits = found if hits is None else hits.unionByName(found)
    per = hits.groupBy("__row").agg(F.max("n_words").alias("n_words"), *[F.collect_list(c).alias(c) for c in ("spans", "items", "cuts")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, n, *lists = b.columns
            spans, names, cuts = (x.to_pylist() for x in lists)
            values = [[merged(x) for x in spans], [in_order({i for x in found for i in x}) for found in names], [merged(x) for x in cuts]]
            yield pa.RecordBatch.from_arrays([row, n, *[pa.array(v, x.type.value_type) for v, x in zip(values, lists, strict=True)]], names=b.schema.names)

    joined = per.mapInArrow(run, f"__row long, {FOUND.format(item=item_type)}")
    return numbered.drop("__text").join(joined, "__row").drop("__row").toDF(*keep, "n_words", "spans", "items", "cuts")


def scan_block(chosen: DataFrame, shared, item_type: str) -> DataFrame:
    """The columns of ``chosen``, but for its last one, ``__text``, with what a broadcast block of phrases finds there."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = chosen.sparkSession
    kept = chosen.drop("__text").schema
    schema = StructType([*kept.fields, *spark.createDataFrame([], FOUND.format(item=item_type)).schema.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def shard() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            column = whole.column(whole.num_columns - 1).combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            _, off = column_bytes(column)
            for lo, hi in row_blocks(off, SHARD_BYTES):
                words, spans, items, cuts = scan_shard(shared.value, column.slice(lo, hi - lo))
                values = [pa.array(words, pa.int64()), pa.array([x.tolist() for x in spans], arrow.field("spans").type), pa.array(items, arrow.field("items").type), pa.array([x.tolist() for x in cuts], arrow.field("cuts").type)]
                for b in pa.Table.from_arrays([*[whole.column(k).slice(lo, hi - lo).cast(arrow.field(k).type) for k in range(len(kept))], *values], schema=arrow).combine_chunks().to_batches():
                    yield b

        for b in batches:
            held.append(b)
            size += b.nbytes
            if size >= SHARD_BYTES:
                yield from shard()
                held, size = [], 0
        if held:
            yield from shard()

    return chosen.mapInArrow(run, schema)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the benchmark passages: every removal span is cut from the text.

    The columns stay as they are; ``n_chars``, if there, follows the new text. A row of whose text nothing but
    separators is left is dropped; rows without a hit stay untouched.
    """
    # names of our own: the columns of docs may be called anything
    own = [f"__{i}" for i in range(len(docs.columns))]
    text = own[docs.columns.index(text_col)]
    found = scan(docs.toDF(*own), benchmark, text, keep=tuple(own), **options)

    raw = F.col(text).cast("binary")
    piece = lambda lo, n: F.substring(raw, lo.cast("int") + 1, n.cast("int"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.unhex(F.lit("")).alias("out"))
    step = lambda s, c: F.struct(c[1].alias("at"), F.concat(s["out"], piece(s["at"], c[0] - s["at"])).alias("out"))
    left = F.decode(F.aggregate("cuts", start, step, lambda s: F.concat(s["out"], piece(s["at"], F.octet_length(raw)))), "UTF-8")
    hit = F.size("cuts") > 0
    out = found.withColumn("__new", F.when(hit, left).otherwise(F.col(text)))
    out = out.filter(~hit | F.col("__new").rlike("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]")).withColumn(text, F.col("__new"))
    if "n_chars" in docs.columns:
        size = own[docs.columns.index("n_chars")]
        out = out.withColumn(size, F.when(hit, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col(size)))
    return out.select(*own).toDF(*docs.columns)


def op8_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


QUERIES = {"op8_fm_decontamination": op8_fm_decontamination}
ORACLE = {
    "op8_fm_decontamination": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), 10) AS size FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase FROM sized),
starts AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM words, (SELECT DISTINCT size FROM sized)),
found AS (
  SELECT p.doc_id, p.pos, p.size, v.item FROM (SELECT doc_id, pos, size, array_to_string(w[pos:pos + size - 1], ' ') AS phrase FROM starts) p
  JOIN windows v ON v.size = p.size AND v.phrase = p.phrase),
hits AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
  sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM words t LEFT JOIN hits h ON h.doc_id = t.doc_id LEFT JOIN named i ON i.doc_id = t.doc_id""",
}
