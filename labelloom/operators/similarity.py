"""Hamming similarity join of 64-bit hashes by an index of Hamming balls.

The 64 bits are cut into bands. If the radii of the bands, each plus one, add up to the distance plus one, two hashes
within the distance lie within the radius of some band. There they have a value in the middle of their ways: the
one flips the lower half of the bits that differ, the other the upper half. So each hash is listed under all values
that a few flips of a band make, and an equi-join on (band, differing bits, value) finds every pair, once: in its
first band, at its own middle. No pairs outside of shared values are formed.

A value that very many hashes share (all black images, say) is not joined. Its hashes go on to another level, which
cuts the bits outside the band the same way, for the distance that the band leaves. (Distances to pivots would
split such a group worse: over 40 or more free bits, they hardly differ.)

Wide distances over many hashes (16 of 64 bits, 100,000 hashes: 1,000 listed values each) make the index dearer than
comparing all hashes, which takes two nanoseconds a pair. There the hashes are dealt to blocks, and each pair of blocks is
compared by a task (see ``block_pairs``): exact, in bounded memory, and spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions.boxes import hamming
from labelloom.session import small_batches, written

BITS = tuple(range(64))
#: Pairs that one value may make before its hashes go to the next level.
CROWDED = 100_000_000
LEVELS = 4
#: Values that one level lists a hash under at most.
LISTED = 20_000
#: Rows listed and met up to which the index is used in any case, and what comparing a pair in a block costs against one.
INDEXED, COMPARED = 10_000_000, 0.004
#: Blocks that all hashes are dealt to, and the least and most hashes of a block.
BLOCKS, BLOCK = 48, (1024, 65_536)
#: Pairs found that a task holds before it hands them on.
FOUND = 100_000
#: Pairs that a task compares at least, where that leaves each core a few tasks, and the most tasks.
COMPARES, TASKS = 200_000_000, 400


def radii(budget: int, bands: int) -> list[int]:
    """A radius for each band; each plus one, they add up to the budget plus one."""
    return [(budget + 1) // bands - 1 + (i < (budget + 1) % bands) for i in range(bands)]


def cut(bits: tuple[int, ...], bands: int) -> list[tuple[int, ...]]:
    n, extra = divmod(len(bits), bands)
    edges = [i * n + min(i, extra) for i in range(bands + 1)]
    return [bits[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def effort(bits: tuple[int, ...], budget: int, bands: int, hashes: int) -> float:
    """Rows listed and pairs met, about, for so many hashes."""
    rows = pairs = 0.0
    for band, r in zip(cut(bits, bands), radii(budget, bands), strict=True):
        for k in range(r + 1):
            rows += comb(len(band), (k + 1) // 2) + comb(len(band), k // 2)
            pairs += comb(len(band), k) * comb(k, k // 2) / 2 ** len(band)
    return hashes * rows + hashes**2 / 2 * pairs if rows <= LISTED else float("inf")


def best_bands(bits: tuple[int, ...], budget: int, hashes: int) -> list[tuple[tuple[int, ...], int]]:
    """(bits, radius) of the bands that cost least for so many hashes."""
    n = min(range(1, min(budget + 1, len(bits)) + 1), key=lambda m: effort(bits, budget, m, hashes))
    return list(zip(cut(bits, n), radii(budget, n), strict=True))


def as_long(bits: tuple[int, ...]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


class Level:
    """A way to cut the bits that are left: what is listed, and what tells a pair's first band."""

    def __init__(self, bits: tuple[int, ...], budget: int, hashes: int, checks: tuple = ()):
        self.bits, self.budget, self.checks = bits, budget, checks
        self.bands = best_bands(bits, budget, hashes)

    def entries(self) -> list[tuple[int, int, tuple[int, ...]]]:
        """(band, differing bits, the band's bits): one more than the budget, over all bands."""
        return [(i, k, band) for i, (band, r) in enumerate(self.bands) for k in range(r + 1)]

    def below(self, band: int, k: int, hashes: int) -> Level | None:
        """The level for pairs that differ by ``k`` bits of ``band``; none if no bits are left."""
        rest = tuple(b for b in self.bits if b not in self.bands[band][0])
        return Level(rest, min(self.budget - k, len(rest)), hashes, self.checked(band, k)) if rest else None

    def checked(self, band: int, k: int) -> tuple:
        earlier = [(as_long(b), r) for b, r in self.bands[:band]]
        return (*self.checks, (as_long(self.bands[band][0]), k, earlier))


FLIPS = "way long, side int, band_mask long, flip long, next_way long"
CHECKS = "next_way long, checks array<struct<mask:long,k:int,earlier:array<struct<mask:long,radius:int>>>>"


def listings(nodes: DataFrame, distance: int, crowded: int = CROWDED) -> Iterator[tuple[DataFrame, DataFrame]]:
    """(index, checks) of each level: the rows of an index of equal ``way`` and ``path`` and unequal ``side`` meet.

    nodes: id, h, of distinct hashes.
    """
    spark = nodes.sparkSession
    ways = {0: Level(BITS, min(distance, 64), max(nodes.count(), 1))}
    both = F.explode(F.array(F.lit(0), F.lit(1))).alias("side")
    rows = nodes.select("id", "h", F.lit(0).cast("long").alias("way"), F.lit(0).cast("long").alias("path"), F.array().cast("array<long>").alias("flips"), both)
    for depth in range(LEVELS):
        flips, checks, below = [], [], {}
        for way, level in ways.items():
            for step, (band, k, bits) in enumerate(level.entries()):
                name = way * (len(BITS) + 2) + step + 1
                below[name] = (level, band, k)
                checks.append((name, level.checked(band, k)))
                for side, n in ((0, (k + 1) // 2), (1, k // 2)):
                    flips += [(way, side, as_long(bits), as_long(f), name) for f in combinations(bits, n)]
        # a row for each flip: bounded by LISTED for each way, not by hashes
        flipped = rows.join(F.broadcast(spark.createDataFrame(flips, FLIPS)), ["way", "side"])
        value = F.col("h").bitwiseAND(F.col("band_mask")).bitwiseXOR(F.col("flip"))
        index = flipped.select("id", "h", "side", F.col("next_way").alias("way"), F.xxhash64("path", "next_way", value).alias("path"), F.array_append("flips", F.col("flip")).alias("flips"))
        ways = {}
        if depth < LEVELS - 1:
            index = written(index, "hamming-index")
            sides = index.groupBy("way", "path").agg(F.count_if(F.col("side") == 0).alias("l"), F.count_if(F.col("side") == 1).alias("r"))
            hot = sides.filter(F.col("l").cast("double") * F.col("r") > crowded).select("way", "path")
            # at most as many as the level has entries
            found = [r["way"] for r in hot.select("way").distinct().collect()]
            ways = {w: level for w in found if (level := below[w][0].below(*below[w][1:], crowded)) is not None}
        if ways:
            going = written(hot.filter(F.col("way").isin(list(ways))), "hamming-crowded")
            rows, index = index.join(going, ["way", "path"], "left_semi"), index.join(going, ["way", "path"], "left_anti")
        yield index, spark.createDataFrame(checks, CHECKS)
        if not ways:
            return


def in_blocks(distance: int, hashes: int, indexed: int = INDEXED) -> bool:
    """Whether comparing blocks costs less than an index of so many hashes."""
    budget = min(distance, 64)
    index = min(effort(BITS, budget, n, hashes) for n in range(1, min(budget + 1, len(BITS)) + 1))
    return index > max(indexed, hashes + hashes**2 / 2 * COMPARED)


def block_pairs(nodes: DataFrame, distance: int, hashes: int, block: int | None = None, spanning: bool = False) -> DataFrame:
    """(a, ha, b, hb) of hashes at most ``distance`` apart, each pair once, by comparing all blocks of hashes.

    A block is one row; each pair of blocks is joined by its numbers and compared by itself. What is shuffled grows with
    the hashes times ``BLOCKS``, until blocks are at their largest. ``spanning``: of each pair of blocks only pairs
    that connect what is not connected there (see ``forest``), fewer than its hashes however many are near.
    """
    small_batches(nodes.sparkSession)
    block = block or min(max(hashes // BLOCKS, BLOCK[0]), BLOCK[1])
    n = max(1, -(-hashes // block))
    dealt = nodes.select(F.pmod(F.xxhash64("h"), F.lit(n)).cast("int").alias("block"), F.struct("id", "h").alias("node"))
    blocks = written(dealt.groupBy("block").agg(F.collect_list("node").alias("held")), "hash-blocks")
    tasks = min(TASKS, n * (n + 1) // 2, max(4 * nodes.sparkSession.sparkContext.defaultParallelism, hashes**2 // (2 * COMPARES)))
    left = blocks.select(F.col("block").alias("low"), F.explode(F.sequence("block", F.lit(n - 1))).alias("high"), F.col("held").alias("left"))
    right = blocks.select(F.explode(F.sequence(F.lit(0), "block")).alias("low"), F.col("block").alias("high"), F.col("held").alias("right"))
    both = left.repartition(tasks, "low", "high").join(right.repartition(tasks, "low", "high"), ["low", "high"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                (ids, hashes), (other_ids, others) = ([nodes.field(c) for c in ("id", "h")] for side in ("left", "right") for nodes in [batch.column(side).slice(k, 1).flatten()])
                same = batch.column("low")[k].as_py() == batch.column("high")[k].as_py()
                found = near(hashes.to_numpy(), others.to_numpy(), distance, same)
                for i, j in forest(found, len(hashes), 0 if same else len(hashes), len(others)) if spanning else found:
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(i)), hashes.take(pa.array(i)), other_ids.take(pa.array(j)), others.take(pa.array(j))], ["x", "hx", "y", "hy"])

    kind = nodes.schema["id"].dataType
    out = T.StructType([T.StructField("x", kind), T.StructField("hx", T.LongType()), T.StructField("y", kind), T.StructField("hy", T.LongType())])
    met, first = both.mapInArrow(compare, out), F.col("x") < F.col("y")
    pick = lambda a, b, name: F.when(first, F.col(a)).otherwise(F.col(b)).alias(name)
    return met.select(pick("x", "y", "a"), pick("hx", "hy", "ha"), pick("y", "x", "b"), pick("hy", "hx", "hb"))


def near(left: np.ndarray, right: np.ndarray, distance: int, same: bool, step: int = 32) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of hashes at most ``distance`` apart, in parts; of a block with itself (``same``), each pair once."""
    held, size = [], 0
    for lo in range(0, len(left), step):
        i, j = np.nonzero(np.bitwise_count(left[lo : lo + step, None].view(np.uint64) ^ right[None].view(np.uint64)) <= distance)
        i = i + lo
        if same:
            i, j = i[i < j], j[i < j]
        if len(i):
            held, size = [*held, (i, j)], size + len(i)
        if size > FOUND:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def forest(found: Iterator[tuple[np.ndarray, np.ndarray]], left: int, after: int, right: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of the pairs found of a block of ``left`` places with one of ``right`` (numbered from ``after``; 0: the same
    block), as many as connect all that they connect: a spanning forest, held as one root for each place."""
    root = np.arange(max(left, after + right))
    for i, j in found:
        while True:
            a, b = root[i], root[j + after]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            # each root hooks on to a smaller one, by one of its pairs, so no circle forms
            tops, first = np.unique(np.maximum(a, b), return_index=True)
            root[tops] = np.minimum(a, b)[first]
            yield i[first], j[first]
            while (root[root] != root).any():
                root = root[root]


def hamming_candidates(nodes: DataFrame, distance: int, crowded: int = CROWDED, indexed: int = INDEXED, spanning: bool = False) -> DataFrame:
    """(a, ha, b, hb) of hashes at most ``distance`` apart, each pair once; ``spanning``: where blocks are compared, only
    as many as connect the same hashes."""
    hashes = max(nodes.count(), 1)
    if in_blocks(distance, hashes, indexed):
        return block_pairs(nodes, distance, hashes, spanning=spanning)
    found = []
    for index, checks in listings(nodes, distance, crowded):
        left = index.filter("side = 0").select("way", "path", F.col("id").alias("a"), F.col("h").alias("ha"), F.col("flips").alias("fa"))
        right = index.filter("side = 1").select("way", "path", F.col("id").alias("b"), F.col("h").alias("hb"), F.col("flips").alias("fb"))
        met = left.join(right, ["way", "path"]).filter((F.col("a") < F.col("b")) & (hamming(F.col("ha"), F.col("hb")) <= distance))
        # a row for each entry of the level
        met = met.join(F.broadcast(checks), F.col("way") == F.col("next_way"))
        found.append(met.filter(F.forall(F.arrays_zip("checks", "fa", "fb"), own_place)).select("a", "ha", "b", "hb"))
    return reduce(DataFrame.unionByName, found)


def own_place(x: Column) -> Column:
    """Whether a pair meets here at its own middle, in the first band that is near enough."""
    check, low, high = x["checks"], x["fa"], x["fb"]
    difference = F.col("ha").bitwiseXOR(F.col("hb"))
    bits = lambda mask: F.bit_count(difference.bitwiseAND(mask))
    # every bit of the lower half lies below the lowest one of the upper half
    from_lowest = -(high.bitwiseAND(-high))
    middle = (low.bitwiseAND(high) == 0) & ((high == 0) | (low.bitwiseAND(from_lowest) == 0))
    return middle & (bits(check["mask"]) == check["k"]) & F.forall(check["earlier"], lambda e: bits(e["mask"]) > e["radius"])


def hamming_pairs(df: DataFrame, id_col: str, hash_col: str, distance: int = 2, crowded: int = CROWDED) -> DataFrame:
    """(a, b, distance) of all pairs of distinct hashes at most ``distance`` bits apart, a before b.

    ``a`` and ``b`` are the smallest ids of their hash (equal hashes are one node: see ``equal_links``).
    """
    met = hamming_candidates(distinct_hashes(df, id_col, hash_col, distance), distance, crowded)
    return met.select("a", "b", hamming(F.col("ha"), F.col("hb")).alias("distance"))


def hamming_links(df: DataFrame, id_col: str, hash_col: str, distance: int = 2) -> DataFrame:
    """(a, b): pairs of ``hamming_pairs`` that connect all that those connect.

    A cluster of near hashes makes pairs with the square of its size; where blocks are compared, each pair of blocks hands on
    fewer than its hashes.
    """
    return hamming_candidates(distinct_hashes(df, id_col, hash_col, distance), distance, spanning=True).select("a", "b")


def distinct_hashes(df: DataFrame, id_col: str, hash_col: str, distance: int) -> DataFrame:
    """(h, id): each hash with its smallest id, written."""
    if distance < 0:
        raise ValueError("distance must not be negative")
    nodes = df.filter(F.col(hash_col).isNotNull()).groupBy(F.col(hash_col).cast("long").alias("h")).agg(F.min(id_col).alias("id"))
    return written(nodes, "hashes")


def equal_links(df: DataFrame, id_col: str, key_col: str) -> DataFrame:
    """(a, b): each row of a non-empty key linked to the smallest id of that key."""
    keyed = df.filter(F.col(key_col).isNotNull() & (F.col(key_col).cast("string") != "")).select(F.col(key_col).alias("k"), F.col(id_col).alias("b"))
    return keyed.join(keyed.groupBy("k").agg(F.min("b").alias("a")), "k").filter("a <> b").select("a", "b")
