"""Near-duplicate classes by HyperMinHash.

Signature: ``REGISTERS`` buckets, each fed by a hash function of its own, keep the smallest hash of a
document's shingles as its count of leading zeros (6 bits) and the ``MANTISSA`` bits after the leading one.
Documents with equal shingle sets become one representative first, so copies never meet as pairs.
Candidates: four compressed registers make a band key; representatives that share one are candidates. At
similarity 0.8, all 32 bands miss a pair with a chance of 5e-8.
Estimate: the share of equal registers, corrected for the registers that two unrelated minima share by chance
(compression makes that chance 0.69 * 2 ** -MANTISSA * n * m / (n + m) ** 2), drops pairs far below the
threshold: by more than five standard deviations.
Verification: what is left is compared on the full shingle sets.

A group of near copies is never expanded into pairs. First each band's members are compared with its leader only
(a star; the leader is the member that meets the most others). Bands that still hold more than one component
(by labels that two steps along the links give) may hide links across them: their members are described by how they differ from a centre, and an inverted index
of the differences finds and decides all links between them (see ``by_differences``). The centre is the most
central leader of a member's bands, its home, which members of a band mostly share; where they don't, the
band's own leader is a centre too. So two members of a band always meet in some star. Pairs inside a component
need no check, and no other pair is left out.

Cases: null text, or text without words, has an empty set and is linked with nothing; a text of fewer words
than a shingle has one shingle, its whole sequence; rows that share an id are one document, which is linked with
whatever any of its texts is linked with (each distinct set of such an id is a node of its own, and the nodes of an
id are tied); rows with a null id stay alone (component null, kept); an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelloom.llm.text import byte_class, column_bytes, lower_table, mix, row_blocks, shingle_hashes, span_hashes, word_spans
from labelloom.operators.components import connected_components
from labelloom.operators.ranks import dealt_ranges, running_sums
from labelloom.session import checkpointed, small_batches, table, written

REGISTERS, ROWS = 128, 4
MANTISSA = 10
PERCENT = 80
#: Pairs estimated this far below the threshold are dropped: over five standard deviations at 128 registers.
MARGIN = 0.18
#: Members of a star that one leader's text travels with.
FAN = 64
#: Ids (8 bytes each) that are broadcast at most.
FEW_IDS = 1_000_000
WORD_BYTES = ~byte_class(r"[\x20\x09-\x0D]")
LOWER = lower_table()
SIGNATURE = "doc_id long, text_key long, n_shingles long, set_a long, set_b long, registers binary"


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    raw, off = column_bytes(column)
    for lo, hi in row_blocks(off):
        part = LOWER[raw[off[lo] : off[hi]]]
        starts, ends, rows = word_spans(part, off[lo : hi + 1] - off[lo], WORD_BYTES)
        words = span_hashes(part, starts, ends)
        for i in range(hi - lo):
            w = words[rows[i] : rows[i + 1]]
            yield np.unique(shingle_hashes(w, min(k, len(w)))) if len(w) else w


def multipliers(registers: int = REGISTERS) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * registers + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return x[:registers] | np.uint64(1), x[registers:]


def compress(least: np.ndarray) -> np.ndarray:
    """Leading zeros and the mantissa bits after the leading one, in 16 bits."""
    part, exponent = np.frexp(least.astype(np.float64))
    return ((64 - exponent).astype(np.int64).clip(0, 63) << MANTISSA | np.floor((part * 2 - 1) * (1 << MANTISSA)).astype(np.int64).clip(0)).astype("<u2")


def registers_of(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        h = shingles[i : i + 1024, None] * a
        h += b
        np.minimum(least, h.min(axis=0), out=least)
    return compress(least)


def signatures(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``SIGNATURE`` per row of ``docs``; (set_a, set_b, n_shingles) stands for the set, text_key for the text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = multipliers()
        for batch in batches:
            n, x, y, regs = [], [], [], []
            for s in shingle_sets(batch.column(1), k):
                n.append(len(s))
                x.append(int(s.sum(dtype=np.uint64)))
                y.append(int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)) if len(s) else 0)
                regs.append(registers_of(s, a, b).tobytes() if len(s) else None)
            digest = [pa.array(np.array(v, np.uint64).astype(np.int64), pa.int64()) for v in (x, y)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), *digest, pa.array(regs, pa.binary())], names=["doc_id", "text_key", "n_shingles", "set_a", "set_b", "registers"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col), F.xxhash64(text_col).alias("text_key")).mapInArrow(run, SIGNATURE)


def bands(reps: DataFrame) -> DataFrame:
    """(bucket, rep, n): a row for each band of each representative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mix(np.arange(1, REGISTERS // ROWS + 1, dtype=np.uint64))
        for b in batches:
            if b.num_rows:
                keys = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u8").reshape(b.num_rows, -1)
                bucket = mix(mix(keys.copy()) ^ seeds).astype(np.int64).reshape(-1)
                each = np.repeat(np.arange(b.num_rows), keys.shape[1])
                rep, n = (b.column(i).take(pa.array(each)) for i in (0, 2))
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), rep, n], names=["bucket", "rep", "n"])

    return reps.select("rep", "registers", "n").mapInArrow(run, "bucket long, rep long, n long")


def similar_size(x: str, y: str) -> str:
    return f"100 * least({x}, {y}) >= {PERCENT} * greatest({x}, {y})"


def estimated(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """``pairs`` (a, b) whose corrected register estimate is not far below the threshold."""
    side = lambda c: reps.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("registers").alias(f"r_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "r_a", "r_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            n, m = (b.column(i).to_numpy().astype(np.float64) for i in (2, 3))
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), "<u2").reshape(b.num_rows, -1) for i in (4, 5))
            chance = 0.69 * 2.0**-MANTISSA * n * m / (n + m) ** 2
            j = ((x == y).mean(axis=1) - chance) / (1 - chance)
            yield b.select(["a", "b"]).filter(pa.array(j >= PERCENT / 100 - MARGIN))

    return both.mapInArrow(run, "a long, b long")


def compared(pairs: DataFrame, docs: DataFrame, k: int, id_col: str, text_col: str, compare, schema: str) -> DataFrame:
    """Rows that ``compare(a, set of a, b, set of b)`` yields for each of the ``pairs`` (a, b).

    The texts of an ``a`` and of its ``b`` meet in a sorted stream, the ``a`` in front of every FAN or so of
    its ``b``; a task holds one set of an ``a`` and one text at a time.
    """
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "candidate-ids")
    if ids.count() <= FEW_IDS:  # a bounded list of ids goes to the texts; a longer one meets them in a shuffle
        ids = F.broadcast(ids)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(ids, "id", "left_semi").dropDuplicates(["id"])
    texts = written(texts, "candidate-texts")
    fans = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / FAN).cast("int").alias("fans"))
    dealt = pairs.join(fans, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("fans")).cast("int").alias("fan"))
    heads = dealt.select("a", "fan").distinct().select("a", "fan", F.lit(0).alias("role"), F.col("a").alias("id"))
    rows = heads.union(dealt.select("a", "fan", F.lit(1).alias("role"), F.col("b").alias("id"))).join(texts, "id")
    rows = rows.select("a", "fan", "role", "id", "text").repartition("a", "fan").sortWithinPartitions("a", "fan", "role", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.zeros(0, np.uint64)
        for batch in batches:
            out = []
            for a, role, i, s in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), shingle_sets(batch.column(4), k), strict=True):
                if role == 0:
                    head = s
                else:
                    out += compare(a, head, i, s)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), ARROW[schema], strict=True)], names=[x.split()[0] for x in schema.split(", ")])

    return rows.mapInArrow(run, schema)


LINKS, DIFFERENCES = "a long, b long", "c long, x long, n_c long, weight long, items array<long>"
ARROW = {LINKS: [pa.int64()] * 2, DIFFERENCES: [pa.int64()] * 4 + [pa.list_(pa.int64())]}


def members_of(s: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which elements of the sorted set ``s`` are in ``other``."""
    if not len(other):
        return np.zeros(len(s), bool)
    return other[np.minimum(np.searchsorted(other, s), len(other) - 1)] == s


def verified(pairs: DataFrame, docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """The ``pairs`` (a, b) linked by their full shingle sets."""

    def linked(a: int, head: np.ndarray, b: int, s: np.ndarray) -> list[tuple]:
        same = int(members_of(s, head).sum())
        return [(a, b)] if same and 100 * same >= PERCENT * (len(head) + len(s) - same) else []

    return checkpointed(compared(pairs, docs, k, id_col, text_col, linked, LINKS))


def by_differences(stars: DataFrame, docs: DataFrame, component: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """Links (a, b) between members of different labels (``component``), among the members of each star (c, x) of ``stars``: all of them.

    Members are described by how they differ from the centre c: the shingles they add and those they lack.
    With the weight H = 5 * lacking + 4 * added, x and y are linked if and only if nine times the number of
    differences they share reaches H(x) + H(y) - |c|, and x is linked with c if and only if H(x) <= |c|. So the
    lists decide, no text is read again. Two members that are both linked with c are connected already; of others, let
    x be one that is not. Then y shares more than H(y) / 9 differences with it, and x at least (H(x) - |c|) / 9
    with y. In any fixed order of the differences, rarest first here, their first common one lies so far in
    front in either list that enough can follow it: only such meetings become pairs. Differences of one member
    alone are shared with nobody and leave first.
    """

    def differences(c: int, head: np.ndarray, x: int, s: np.ndarray) -> list[tuple]:
        added, lacking = s[~members_of(s, head)], head[~members_of(head, s)]
        return [(c, x, len(head), 5 * len(lacking) + 4 * len(added), np.concatenate([added, lacking]).astype(np.int64).tolist())]

    found = written(compared(stars, docs, k, id_col, text_col, differences, DIFFERENCES), "differences")
    # the component joins before a member's differences become rows of their own
    placed = found.join(component.withColumnRenamed("id", "x"), "x", "left").withColumn("component", F.coalesce("component", "x"))
    rows = placed.select("c", "x", "n_c", "weight", "component", F.explode("items").alias("item"))
    shared = rows.groupBy("c", "item").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    rows = rows.join(shared, ["c", "item"])
    mine = W.partitionBy("c", "x")
    # follow: how many differences of the member stand at this one or behind it
    rows = rows.withColumn("follow", F.count(F.lit(1)).over(mine) - F.row_number().over(mine.orderBy("df", "item")) + 1)
    rows = written(rows.filter("9 * follow >= weight - n_c").drop("df"), "shared-differences")
    probe = rows.filter("weight > n_c AND 9 * follow >= weight - n_c").select("c", "item", "n_c", "x", "weight", "component", "follow")
    index = rows.filter("9 * follow > weight").select("c", "item", F.col("x").alias("y"), F.col("weight").alias("weight_y"), F.col("component").alias("component_y"), F.col("follow").alias("follow_y"))
    met = probe.join(index, ["c", "item"]).filter("component <> component_y AND 9 * least(follow, follow_y) >= weight + weight_y - n_c")
    met = written(met.select("c", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "crossing-pairs")
    side = lambda x: found.select("c", F.col("x").alias(x), "n_c", F.col("weight").alias(f"weight_{x}"), F.col("items").alias(f"items_{x}"))
    both = met.join(side("a"), ["c", "a"]).join(side("b").drop("n_c"), ["c", "b"])
    return both.filter(9 * F.size(F.array_intersect("items_a", "items_b")) >= F.col("weight_a") + F.col("weight_b") - F.col("n_c")).select("a", "b")


def nearby_labels(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id within two links or so. Equal labels mean one component, which is all
    that pruning needs; different ones may be one component too."""
    both = links.select(F.col("a").alias("id"), F.col("b").alias("other")).union(links.select(F.col("b").alias("id"), F.col("a").alias("other")))
    low = both.groupBy("id").agg(F.min("other").alias("low")).select("id", F.least("id", "low").alias("low"))
    return both.join(low.withColumnRenamed("id", "other"), "other").groupBy("id").agg(F.min(F.least("id", "low")).alias("component"))


def near_duplicates(docs: DataFrame, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    sig = written(signatures(docs, k, id_col, text_col), "signatures")
    one_set = F.struct("n_shingles", "set_a", "set_b")
    several = sig.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(one_set).alias("low"), F.max(one_set).alias("high")).filter("low <> high")
    if several.isEmpty():
        return classes(sig, docs, k, id_col, text_col)
    return tied_classes(sig, docs, k, id_col, text_col)


def tied_classes(sig: DataFrame, docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """``near_duplicates`` where ids have several sets: the sets of all ids are numbered in the order of ids, numbers
    take the place of ids, and the numbers of an id are tied."""
    key = ("doc_id", "n_shingles", "set_a", "set_b")
    sets = sig.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(F.min("text_key").alias("text_key"), F.min_by("registers", "text_key").alias("registers"))
    nodes = written(running_sums(dealt_ranges(sets, *key), (), key, {"node": F.lit(1).cast("long")}).drop("__part"), "document-sets")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
    texts = written(texts.join(nodes.select("doc_id", "text_key", "node"), ["doc_id", "text_key"]).select("node", "text").dropDuplicates(["node"]), "set-texts")
    first = nodes.groupBy("doc_id").agg(F.min("node").alias("a"))
    ties = written(nodes.join(first, "doc_id").filter("node <> a").select("a", F.col("node").alias("b")), "ties")
    found = classes(nodes.select(F.col("node").alias("doc_id"), "text_key", "n_shingles", "set_a", "set_b", "registers"), texts, k, "node", "text", ties)
    named = nodes.select("node", "doc_id")
    component = found.select(F.col("doc_id").alias("node"), F.col("component_id").alias("top"))
    component = component.join(named, "node").join(named.toDF("top", "component_id"), "top").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = sig.select("doc_id", "n_shingles").join(component, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def classes(sig: DataFrame, docs: DataFrame, k: int, id_col: str, text_col: str, ties: DataFrame | None = None) -> DataFrame:
    """``near_duplicates`` from signatures, where every id has one set. ties: (a, b) of ids that belong together."""
    linked = sig.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = linked.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep"), F.min_by("registers", "doc_id").alias("registers"))
    sets = written(sets, "sets")
    reps = sets.select("rep", F.col("n_shingles").alias("n"), "registers")
    every = bands(reps)
    sizes = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = written(every.join(sizes, "bucket"), "shared-bands")
    # the member that meets the most others leads a band: it lies in the middle of its group
    central = shared.groupBy("rep").agg(F.sum("members").alias("meets"))
    first_of = F.min(F.struct((-F.col("meets")).alias("order"), "rep", "n"))
    leaders = shared.join(central, "rep").groupBy("bucket").agg(first_of.alias("leader"))
    shared = shared.join(leaders, "bucket").select("bucket", "rep", "n", "members", F.col("leader.rep").alias("leader"), F.col("leader.n").alias("leader_n"), F.col("leader.order").alias("leader_order"))
    shared = written(shared, "led-bands")

    star = shared.filter("rep <> leader").filter(similar_size("n", "leader_n")).select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    star = written(estimated(star, reps), "star-pairs")
    first = verified(star, docs, k, id_col, text_col)
    component = written(nearby_labels(first), "nearby-labels")

    # bands that hold more than one component: links across them
    placed = shared.join(component.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("bucket")
    # two members: the star has settled the only pair
    placed = written(placed.join(mixed, "bucket", "left_semi").filter("members > 2"), "mixed-bands")
    # a representative's home is the most central leader of its bands; members of one band mostly share it
    home = placed.groupBy("rep").agg(F.min(F.struct("leader_order", F.col("leader").alias("home"))).alias("h")).select("rep", "h.home")
    placed = placed.join(home, "rep")
    homes = placed.groupBy("bucket").agg(F.min("home").alias("low"), F.max("home").alias("high")).filter("low <> high").select("bucket", F.lit(True).alias("several"))
    placed = written(placed.join(homes, "bucket", "left"), "homes")
    # members of one home meet in its star; those of a band with several homes in the band's own star
    stars = placed.select(F.col("home").alias("a"), F.col("rep").alias("b"))
    stars = stars.union(placed.filter("several").select(F.col("leader").alias("a"), F.col("rep").alias("b")))
    stars = written(stars.filter("a <> b").distinct(), "stars")
    second = by_differences(stars, docs, component, k, id_col, text_col)

    links = first.union(second)
    if ties is not None:
        of_set = linked.join(sets.drop("registers"), ["set_a", "set_b", "n_shingles"]).select("doc_id", "rep")
        links = links.union(ties.join(of_set.toDF("a", "rep_a"), "a").join(of_set.toDF("b", "rep_b"), "b").select("rep_a", "rep_b"))
    component = checkpointed(connected_components(links))
    by_set = sets.join(component.withColumnRenamed("id", "rep"), "rep", "left").select("set_a", "set_b", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    out = sig.join(by_set, ["set_a", "set_b", "n_shingles"], "left")
    component_id = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", component_id.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate class: the one with the smallest id."""
    # names of our own: the columns of docs may be called anything
    own = [f"__{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*own)
    doc_id, text = own[docs.columns.index(id_col)], own[docs.columns.index(text_col)]
    dropped = near_duplicates(rows, k, doc_id, text).filter(~F.col("kept")).select(F.col("doc_id").alias("dropped"))
    return rows.join(dropped, F.col(doc_id).cast("long") == F.col("dropped"), "left_anti").toDF(*docs.columns)


def op1_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4)


QUERIES = {"op1_hyperminhash": op1_hyperminhash}
ORACLE = {
    "op1_hyperminhash": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) END AS s FROM words),
classes AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT rep, n, unnest(s) AS item FROM classes),
links AS (
  SELECT x.rep AS a, y.rep AS b FROM items x JOIN items y ON x.item = y.item AND x.rep <> y.rep
  GROUP BY x.rep, y.rep, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (SELECT rep AS a, rep AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT t.doc_id, CAST(len(t.s) AS BIGINT) AS n_shingles, coalesce(l.low, t.doc_id) AS component_id, coalesce(l.low, t.doc_id) = t.doc_id AS kept
FROM sets t LEFT JOIN classes c ON t.s = c.s LEFT JOIN least_of l ON l.a = c.rep""",
}
