"""Mixing of sources to target weights by Sainte-Laguë apportionment. DataFrame and SQL functions only.

1. Targets: ``share`` of all words is dealt to the sources by weight; a source stops at ``most`` times its own
   words, and what it leaves is dealt again by weight. Sorted by the level at which they stop, sources are
   capped up to a point that running sums of caps and weights show, so no round-by-round resharing is needed.
2. Blocks: the documents of a source stand in a seeded order (by a digest of seed, id and size) and are cut, in
   that order, into blocks of ``block`` words. A seat stands for one block in the mix. Seats go to the highest
   quotients target / 1, target / 3, target / 5, ... of all sources; a source has as many seats as ``most``
   passes over its blocks allow. The divisor where all seats are dealt is searched from both sides, with sums
   over the sources only, and the few quotients between its bounds are ranked exactly.
3. Shards: seats are numbered source by source and dealt to the shards in turn, which gives each shard an integer
   quota of every source: quotas of a source differ by one at most over the shards, and so do shard sizes.
4. Selection: a source's quota is filled with the first blocks of its seeded order, then with a second pass.
   Each shard takes a run of neighbouring blocks, so documents are cut only where a run ends.

A source may hold any share of the rows: its order comes from range partitions with carried sums, never from
one sorted group. Blocks and seats are numbers, never rows.

Cases: null text or text without words has size 0 and takes nothing; null sources are one source, the last;
null ids and repeated rows are documents of their own; sources of equal quotients are served by code point; an
empty table gives no rows; sources without words have target 0; other columns are ignored.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.operators.ranks import dealt_ranges, running_sums
from labelloom.session import table, written

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)
MOST = 2
BLOCK = 64
SHARDS = 16
SEED = 42
WORD = r"[^\x20\x09-\x0D]+"
PIECES = "array<struct<shard:int,pass:int,word_from:long,word_to:long>>"
#: Divisors that one pass over the sources tries.
TRIED = 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """``totals`` (source, source_size) with ``place`` (by code point, from 0, null last) and ``target``.

    share: the mix as a fraction (above, below) of all words.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    if not 0 < share[0] <= most * share[1]:
        raise ValueError("the share must be positive and at most what all sources may give")
    named = totals.select("source", "source_size", F.col("source").isNull().alias("__last"))
    placed = running_sums(dealt_ranges(named, "__last", "source"), (), ("__last", "source"), {"place": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("long")
    # the level at which a source stops, as an integer
    level = F.col("source_size").cast("decimal(38,0)") * F.expr(f"CAST({lcm(*weights)} AS BIGINT) DIV weight")
    rows = placed.drop("__part", "__last").withColumn("weight", weight).withColumn("__level", level.cast("decimal(38,0)"))
    rows = running_sums(dealt_ranges(rows, "__level", "place"), (), ("__level", "place"), {"__full": F.col("source_size"), "__w": F.col("weight")})
    rows = rows.drop("__part")
    # one row: all words, all weights
    whole = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("__all"), F.sum("weight").alias("__weights"))
    big = lambda c: F.col(c).cast("decimal(38,0)")
    left = share[0] * big("__all") - most * share[1] * big("__full")
    capped = most * share[1] * big("source_size") * (big("__weights") - big("__w")) < big("weight") * left
    rows = rows.crossJoin(F.broadcast(whole)).withColumn("__capped", capped)
    free = rows.agg(F.coalesce(F.sum(F.when(F.col("__capped"), F.col("source_size"))), F.lit(0)).alias("__gone"), F.coalesce(F.sum(F.when(~F.col("__capped"), F.col("weight"))), F.lit(0)).alias("__open"))
    level = (big("weight") * (share[0] * big("__all") - most * share[1] * big("__gone"))).cast("double") / (share[1] * F.col("__open")).cast("double")
    target = F.when(F.col("__capped"), (most * F.col("source_size")).cast("double")).otherwise(level)
    return rows.crossJoin(F.broadcast(free)).select("source", "source_size", F.col("place").cast("long").alias("place"), "weight", target.alias("target"))


def seats_above(threshold: Column) -> Column:
    """How many seats a source gets if every quotient from ``threshold`` on gets one."""
    return F.least(F.col("available"), F.greatest(F.lit(0), F.floor(F.least(F.col("target") / threshold + 1, F.lit(8e18)) / 2)).cast("long"))


def apportion(targets: DataFrame, block: int = BLOCK, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """``targets`` with ``blocks`` (of the source) and ``seats``: the source's blocks in the mix.

    All seats together are the mix in blocks, rounded; the highest quotients get them, equal ones by place.
    """
    rows = written(targets.withColumn("blocks", F.expr(f"(source_size + {block - 1}) DIV {block}")).withColumn("available", most * F.col("blocks")), "mix-targets")
    # one row; the search below sees nothing but sums over sources
    whole = rows.agg(F.coalesce(F.sum(F.col("source_size").cast("decimal(38,0)")), F.lit(0)).alias("n"), F.coalesce(F.sum("available"), F.lit(0)).alias("a"), F.max("target").alias("t"), F.count(F.lit(1)).alias("sources")).first()
    every = min((2 * int(whole["n"]) * share[0] + share[1] * block) // (2 * share[1] * block), int(whole["a"]))
    if not every:
        return rows.select("source", "source_size", "place", "weight", "target", "blocks", F.lit(0).cast("long").alias("seats"))
    high, low, above = 2.0 * whole["t"], None, 0
    step = 2.0
    while low is None or below - above > 8 * whole["sources"] + 1000:
        tried = [high / step ** (i + 1) for i in range(TRIED)] if low is None else [high * (low / high) ** ((i + 1) / (TRIED + 1)) for i in range(TRIED)]
        if low is not None and not low < tried[-1] < tried[0] < high:
            break
        sums = rows.agg(*[F.sum(seats_above(F.lit(t))).alias(f"s{i}") for i, t in enumerate(tried)]).first()
        for i, t in enumerate(tried):
            if sums[i] >= every:
                low, below = t, sums[i]
                break
            high, above = t, sums[i]
    # a seat more on either side, since thresholds and quotients round differently
    sure = F.greatest(F.lit(0).cast("long"), seats_above(F.lit(high)) - 1)
    rows = rows.withColumn("sure", sure).withColumn("open", F.least(F.col("available"), seats_above(F.lit(low)) + 1))
    open_seats = every - int(rows.agg(F.sum("sure")).first()[0])
    quotients = rows.filter("open > sure").select("place", F.explode(F.sequence("sure", F.col("open") - 1)).alias("seat"), "target")
    quotients = quotients.select("place", F.struct((-F.col("target") / (2 * F.col("seat") + 1)).alias("q"), "place", "seat").alias("__q"))
    ranked = running_sums(dealt_ranges(quotients, "__q"), (), ("__q",), {"rank": F.lit(1)})
    won = ranked.filter(F.col("rank") < open_seats).groupBy("place").agg(F.count(F.lit(1)).alias("won"))
    out = rows.join(won, "place", "left").withColumn("seats", F.col("sure") + F.coalesce("won", F.lit(0).cast("long")))
    return out.select("source", "source_size", "place", "weight", "target", "blocks", "seats")


def shard_quotas(apportioned: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(source, place, shard, quota): the blocks of each source in each shard."""
    numbered = running_sums(dealt_ranges(apportioned, "place"), (), ("place",), {"first_seat": F.col("seats")})
    rows = numbered.select("source", "place", "seats", "first_seat", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    turn = F.pmod(F.col("shard") - F.col("first_seat"), F.lit(shards))
    return rows.select("source", "place", "shard", "seats", turn.alias("turn")).select("source", "place", "shard", F.floor((F.col("seats") + shards - 1 - F.col("turn")) / shards).cast("long").alias("quota"))


def pieces_of(start: Column, size: Column, shards: int, block: int) -> Column:
    """The pieces of a document that begins at word ``start`` of its source; see ``mixed`` for the other columns.

    In a pass, a seat's place in its source's seats tells its run, a run its shard; the document meets the runs
    between its first and its last seat.
    """
    base, extra = F.expr(f"seats DIV {shards}"), F.col("seats") % shards
    wide = extra * (base + 1)
    run_of = lambda seat: F.when(seat < wide, F.floor(seat / (base + 1))).otherwise(extra + F.floor((seat - wide) / F.greatest(base, F.lit(1))))
    run_start = lambda run: F.least(run, extra) * (base + 1) + F.greatest(run - extra, F.lit(0)) * base

    def one_pass(number: int) -> Column:
        shift = number * F.col("blocks")
        first = F.floor(start / block) + shift
        last = F.least(F.floor((start + size - 1) / block) + shift, F.col("seats") - 1)

        def piece(run: Column) -> Column:
            lo, hi = (run_start(run) - shift) * block, (run_start(run + 1) - shift) * block
            return F.struct(
                F.pmod(F.col("first_seat") + run, F.lit(shards)).cast("int").alias("shard"),
                F.lit(number).alias("pass"),
                (F.greatest(lo, start) - start).cast("long").alias("word_from"),
                (F.least(hi, start + size) - start).cast("long").alias("word_to"),
            )

        found = F.transform(F.sequence(run_of(first).cast("long"), run_of(last).cast("long")), piece)
        return F.when((size > 0) & (first <= last), found).otherwise(F.array().cast(PIECES))

    return F.concat(*[one_pass(i) for i in range(MOST)])


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row for each of ``docs``: doc_id, source, size, source_size, target, pieces.

    pieces: what the mix takes of the document, as (shard, pass, word_from, word_to): its words from
    ``word_from`` up to, not including, ``word_to``. ``piece_texts`` makes texts of them.
    """
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("size").cast("string")).cast("binary"))
    # rows of equal key are equal in all that follows, so their order (by number of the row read) doesn't matter
    rows = sized.withColumn("__key", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")).withColumn("__row", F.monotonically_increasing_id())
    rows = written(rows.withColumn("__last", F.col("source").isNull()), "mix-sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    seats = apportion(source_targets(totals, weights), block)
    seats = written(running_sums(dealt_ranges(seats, "place"), (), ("place",), {"first_seat": F.col("seats")}).drop("__part"), "mix-seats")
    order = ("__key", "doc_id", "size", "__row")
    placed = running_sums(dealt_ranges(rows, "__last", "source", *order), ("source",), order, {"__start": F.col("size")})
    both = placed.join(seats.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
    return both.select("doc_id", "source", "size", "source_size", "target", pieces_of(F.col("__start"), F.col("size"), shards, block).alias("pieces"))


def piece_texts(text: Column, piece: Column, size: Column) -> Column:
    """The text of a piece: a whole document as it is, else its words from ``word_from`` on, with single spaces."""
    words = F.slice(F.regexp_extract_all(text, F.lit(WORD), 0), (piece["word_from"] + 1).cast("int"), (piece["word_to"] - piece["word_from"]).cast("int"))
    return F.when((piece["word_from"] == 0) & (piece["word_to"] == size), text).otherwise(F.array_join(words, " "))


def op11_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixed(table(spark, sf_dir, "documents"))
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["word_to"] - p["word_from"])
    return out.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


QUERIES = {"op11_sainte_lague": op11_sainte_lague}
ORACLE = {
    "op11_sainte_lague": rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
k AS (SELECT *, md5(concat('{SEED}:', coalesce(CAST(doc_id AS VARCHAR), '-'), ':', size)) AS m FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][place % 3 + 1] AS weight FROM s),
t AS (SELECT sum(source_size) AS n, sum(weight) AS weights FROM w),
l AS (SELECT *, coalesce(sum(source_size) OVER o, 0) AS gone, coalesce(sum(weight) OVER o, 0) AS w0 FROM w
  WINDOW o AS (ORDER BY source_size * (6 // weight), place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT l.*, n, 4 * source_size * (weights - w0) < weight * (3 * n - 4 * gone) AS capped FROM l, t),
f AS (SELECT coalesce(sum(source_size) FILTER (capped), 0) AS g, coalesce(sum(weight) FILTER (NOT capped), 0) AS open FROM c),
g AS (SELECT source, source_size, place, n, (source_size + {BLOCK - 1}) // {BLOCK} AS blocks,
  CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE) ELSE CAST(weight * (3 * n - 4 * f.g) AS DOUBLE) / CAST(2 * open AS DOUBLE) END AS target FROM c, f),
q AS (SELECT place, n, row_number() OVER (ORDER BY target / (2 * seat + 1) DESC, place, seat) AS r FROM (SELECT *, unnest(range(2 * blocks)) AS seat FROM g)),
a AS (SELECT place, count(*) AS seats FROM q WHERE r <= (6 * n + {2 * BLOCK}) // {4 * BLOCK} GROUP BY place),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY CAST(concat('0x', substr(m, 1, 15)) AS BIGINT), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM k)
SELECT doc_id, size, source_size, target, CAST(greatest(0, least(start + size, coalesce(seats, 0) * {BLOCK}) - start) + greatest(0, least(start + size, (coalesce(seats, 0) - blocks) * {BLOCK}) - start) AS BIGINT) AS taken
FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source LEFT JOIN a ON g.place = a.place""",
}
