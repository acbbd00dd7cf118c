"""Merkle manifest of a dataset, its subtrees stored in van Emde Boas layout.

Every row of the dataset is a leaf, every language a tree over its leaves by id, and the trees' roots, by
language, the leaves of one more tree, whose root stands for the dataset.

A tree is stored as aligned blocks: subtrees of ``HEIGHT`` levels over 2 ** HEIGHT neighbouring nodes. A block is
one row of the manifest; its nodes lie in one binary column in van Emde Boas order: a tree of height h is its
upper half (h // 2 levels more than its root) followed by the lower subtrees from left to right, each laid out the
same way, so that any path from leaf to root meets few stretches of neighbouring memory whatever the size of a
cache line. ``layout`` gives the address of a node; building, reading siblings and checking all go by it.

Block roots are the nodes of the next layer, which is cut into blocks again, until a tree has one root. A proof is
read the other way round: a block finds the siblings above it in its parent's block, layer by layer, and every
leaf adds its own. Blocks bound what a task holds; a language may have any share of the rows.

Cases: null values are marked and differ from empty texts; leaves with null id come first, leaves of equal id go by
digest; null is a language of its own, the first; a lone leaf is the root of its tree; a run of one node is
digested alone; repeated rows are leaves of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.operators.ranks import dealt_ranges, running_sums
from labelloom.session import small_batches, table, written

#: Levels of a block above its leaves.
HEIGHT = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A block: its tree, layer (0: over the leaves), place in the layer, leaves, levels used, nodes, root.
BLOCK = "tree string, layer int, block long, leaves int, levels int, nodes binary, root string"
#: The way from a node of a layer up to its tree's root: siblings' digests, and L, R or - (none) for each level.
PATH = "tree string, layer int, pos long, siblings string, sides string"
PROOF = "doc_id long, leaf string, subroot string, root string, siblings string, sides string, folded_root string"


# -- layout ---------------------------------------------------------------------------------------------------


@lru_cache(maxsize=32)
def layout(levels: int) -> tuple[np.ndarray, ...]:
    """For each level of a full tree, from the leaves (0) up to the root (``levels``), the addresses of its nodes."""
    if levels == 0:
        return (np.zeros(1, np.int64),)
    upper = levels // 2
    lower = levels - upper - 1
    top, bottom = layout(upper), layout(lower)
    first, size = 2 ** (upper + 1) - 1, 2 ** (lower + 1) - 1
    below = first + size * np.arange(2 ** (upper + 1))[:, None]
    return (*[(below + b[None, :]).ravel() for b in bottom], *top)


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def levels_of(total: int, height: int) -> int:
    """Levels of a block above its leaves: all, or those that the whole tree needs if it is one block."""
    return height if total > 2**height else max(0, int(total - 1).bit_length())


def build(leaves: list[str], levels: int) -> tuple[bytes, str]:
    """(nodes, root) of a block. Nodes that the last block of a layer lacks stay zero."""
    at = layout(levels)
    nodes = np.zeros((2 ** (levels + 1) - 1, 32), np.uint8)
    row = leaves
    for level in range(levels + 1):
        nodes[at[level][: len(row)]] = np.frombuffer(bytes.fromhex("".join(row)), np.uint8).reshape(-1, 32)
        if level < levels:
            row = [digest(*row[i : i + 2]) for i in range(0, len(row), 2)]
    return nodes.tobytes(), row[0]


def paths(nodes: bytes, leaves: int, levels: int) -> Iterator[tuple[list[str], str]]:
    """(siblings, sides) of each leaf of a block, from its level up."""
    stored, at = np.frombuffer(nodes, np.uint8).reshape(-1, 32), layout(levels)
    rows, count = [], leaves
    for level in range(levels):
        text = stored[at[level][:count]].tobytes().hex()
        rows.append([text[64 * i : 64 * i + 64] for i in range(count)])
        count = (count + 1) // 2
    for i in range(leaves):
        found, sides = [], []
        for row in rows:
            other = i ^ 1
            sides.append("-" if other >= len(row) else "L" if other < i else "R")
            if other < len(row):
                found.append(row[other])
            i >>= 1
        yield found, "".join(sides)


def fold(leaf: str, siblings: str, sides: str) -> str:
    """The root that ``leaf`` leads to with these siblings."""
    at = 0
    for side in sides:
        other = siblings[at : at + 64] if side != "-" else ""
        at += len(other)
        leaf = digest(other, leaf) if side == "L" else digest(leaf, other)
    return leaf


# -- leaves -----------------------------------------------------------------------------------------------------


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:``, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(columns[f]) for f in FIELDS]), 256)


def leaves(docs: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, tree, pos, total, leaf, ...): the leaves of ``docs``, numbered in their tree.

    tree is ``=`` and the language, or empty for null. extra: more columns, made from the table's.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    rows = docs.select("doc_id", tree.alias("tree"), leaf_digest({f: F.col(f) for f in FIELDS}).alias("leaf"), *[c.alias(n) for n, c in (extra or {}).items()])
    # equal leaves are interchangeable: the number of the row read keeps them from sharing one range
    rows = written(rows.withColumn("__row", F.monotonically_increasing_id()), "manifest-leaves")
    order = ("doc_id", "leaf", "__row")
    placed = running_sums(dealt_ranges(rows, "tree", *order), ("tree",), order, {"pos": F.lit(1).cast("long")})
    totals = rows.groupBy("tree").agg(F.count(F.lit(1)).alias("total"))
    return written(placed.drop("__part", "__row").join(totals, "tree"), "manifest-numbered")


# -- manifest ---------------------------------------------------------------------------------------------------


def blocks(nodes: DataFrame, layer: int, height: int = HEIGHT) -> DataFrame:
    """Blocks of a layer from its nodes (tree, pos, total, leaf)."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        levels = levels_of(int(pdf.total.iloc[0]), height)
        stored, root = build(pdf.leaf.tolist(), levels)
        return pd.DataFrame([(pdf.tree.iloc[0], layer, int(pdf.pos.iloc[0]) >> height, len(pdf), levels, stored, root)], columns=["tree", "layer", "block", "leaves", "levels", "nodes", "root"])

    return nodes.select("tree", "pos", "total", "leaf", F.shiftright("pos", height).alias("block")).groupBy("tree", "block").applyInPandas(one, BLOCK)


def tree_layers(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """The layers of blocks over ``nodes`` (tree, pos, total, leaf), written, until every tree has its root."""
    out = []
    while True:
        layer = len(out)
        out.append(written(blocks(nodes, layer, height), f"manifest-layer-{layer}"))
        # trees of more than one block go on; a layer has 2 ** height times fewer rows than the one below
        totals = out[-1].groupBy("tree").agg(F.count(F.lit(1)).alias("total")).filter("total > 1")
        nodes = out[-1].join(totals, "tree").select("tree", F.col("block").alias("pos"), "total", F.col("root").alias("leaf"))
        nodes = written(nodes, "manifest-nodes")
        if nodes.isEmpty():
            return out


def tree_roots(layers: list[DataFrame]) -> DataFrame:
    """(tree, root) of every tree: the root of its only block in the highest layer that it has."""
    every = layers[0]
    for layer in layers[1:]:
        every = every.unionByName(layer)
    return every.groupBy("tree").agg(F.max_by("root", "layer").alias("root"))


def build_manifest(numbered: DataFrame, height: int = HEIGHT) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """(layers of the trees, layers of the tree over their roots, roots): roots has tree, pos, total, leaf."""
    trees = tree_layers(numbered, height)
    named = dealt_ranges(tree_roots(trees), "tree")
    roots = running_sums(named, (), ("tree",), {"pos": F.lit(1).cast("long")}).select("tree", "pos", F.col("root").alias("leaf"))
    total = roots.agg(F.count(F.lit(1)).alias("total"))
    roots = written(roots.crossJoin(F.broadcast(total)), "manifest-roots")
    return trees, tree_layers(roots.withColumn("tree", F.lit("")), height), roots


# -- proofs -----------------------------------------------------------------------------------------------------


def layer_paths(layer: DataFrame, above: DataFrame) -> DataFrame:
    """``PATH`` of every node of a layer: its siblings in its block, then those of its block's root (``above``)."""
    up = above.select("tree", F.col("pos").alias("block"), "siblings", "sides")
    rows = layer.join(up, ["tree", "block"], "left").select("tree", "layer", "block", "leaves", "levels", "nodes", F.coalesce("siblings", F.lit("")), F.coalesce("sides", F.lit("")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for tree, number, block, n, levels, nodes, siblings, sides in b.itertuples(index=False):
                found = list(paths(nodes, n, levels))
                # a block with fewer levels than others is the only one of its layer, number 0
                first = int(block) << int(levels)
                yield pd.DataFrame({"tree": tree, "layer": number, "pos": first + np.arange(n), "siblings": ["".join(s) + siblings for s, _ in found], "sides": [t + sides for _, t in found]})

    return rows.mapInPandas(run, PATH)


def top_paths(over: list[DataFrame], roots: DataFrame) -> DataFrame:
    """(tree, subroot, siblings, sides): each tree's root and the way from it to the dataset's."""
    above = roots.sparkSession.createDataFrame([], PATH)
    for layer in reversed(over):
        above = written(layer_paths(layer, above), "manifest-over")
    return roots.join(above.drop("tree"), "pos").select("tree", F.col("leaf").alias("subroot"), "siblings", "sides")


def proofs(numbered: DataFrame, trees: list[DataFrame], over: list[DataFrame], roots: DataFrame, check_col: str = "leaf", height: int = HEIGHT) -> DataFrame:
    """``PROOF`` of every leaf: the roots of its tree and of the dataset, its siblings on the way, and the root that
    ``check_col`` (a digest, the leaf's own or another) leads to with them."""
    small_batches(numbered.sparkSession)
    tops = written(top_paths(over, roots), "manifest-tops")
    above = None
    for layer in reversed(trees):
        # a tree's highest block has its tree's way above it, any other one its block's in the layer above
        ends = layer.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").join(tops, "tree")
        own = ends.select("tree", F.lit(0).cast("long").alias("pos"), "siblings", "sides")
        above = own if above is None else above.select("tree", "pos", "siblings", "sides").unionByName(own)
        if layer is not trees[0]:
            above = written(layer_paths(layer, above), "manifest-paths")
    up = above.select("tree", F.col("pos").alias("block"), "siblings", "sides")
    # one row: the dataset's root
    whole = tree_roots(over).select(F.col("root").alias("whole"))
    stored = trees[0].join(up, ["tree", "block"]).join(tops.select("tree", "subroot"), "tree").crossJoin(F.broadcast(whole))
    stored = stored.select("tree", "block", "leaves", "levels", "nodes", "siblings", "sides", "subroot", "whole")
    rows = numbered.select("tree", F.shiftright("pos", height).alias("block"), "pos", "doc_id", "leaf", F.col(check_col).alias("__check"))

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, block = left.sort_values("pos"), right.iloc[0]
        found = list(paths(block.nodes, int(block.leaves), int(block.levels)))
        siblings, sides = ["".join(s) + block.siblings for s, _ in found], [t + block.sides for _, t in found]
        folded = [fold(leaf, s, t) for leaf, s, t in zip(left["__check"], siblings, sides, strict=True)]
        return pd.DataFrame({"doc_id": left.doc_id.to_numpy(), "leaf": left.leaf.to_numpy(), "subroot": block.subroot, "root": block.whole, "siblings": siblings, "sides": sides, "folded_root": folded})

    return rows.groupBy("tree", "block").cogroup(stored.groupBy("tree", "block")).applyInPandas(one, PROOF)


def op12_veb_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = {f: F.col(f) for f in FIELDS} | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    numbered = leaves(docs, {"shown": F.when(tampered, leaf_digest(changed))}).withColumn("shown", F.coalesce("shown", "leaf"))
    out = proofs(numbered, *build_manifest(numbered), "shown")
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str = "n_chars") -> str:
    return f"sha256({' || '.join(_field(n_chars if f == 'n_chars' else f) for f in FIELDS)})"


QUERIES = {"op12_veb_merkle": op12_veb_merkle}
ORACLE = {
    "op12_veb_merkle": f"""
WITH RECURSIVE c AS (SELECT *, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
    lambda a, b: list_reduce(range(8), lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END), xor(a, b)), 4294967295) AS crc FROM documents),
l AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf()} AS leaf, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf()} END AS shown FROM c),
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
n AS (SELECT tree, 0 AS lvl, pos AS idx, leaf AS h FROM p
  UNION ALL SELECT tree, any_value(lvl) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS k FROM n) WHERE k > 1 GROUP BY tree, idx // 2),
s AS (SELECT tree, max(lvl) AS top, arg_max(h, lvl) AS subroot FROM n GROUP BY tree),
r AS (SELECT *, row_number() OVER (ORDER BY tree) - 1 AS rpos FROM s),
o AS (SELECT 0 AS lvl, rpos AS idx, subroot AS h FROM r
  UNION ALL SELECT any_value(lvl) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM (SELECT *, count(*) OVER () AS k FROM o) WHERE k > 1 GROUP BY idx // 2),
w AS (SELECT max(lvl) AS otop, arg_max(h, lvl) AS root FROM o),
f AS (SELECT p.tree, pos, 0 AS lvl, shown AS h, '' AS proof FROM p
  UNION ALL SELECT f.tree, f.pos, f.lvl + 1, sha256(CASE WHEN x.idx < (f.pos >> f.lvl) THEN x.h || f.h ELSE f.h || coalesce(x.h, '') END), f.proof || coalesce(x.h, '')
  FROM f JOIN s ON f.tree = s.tree AND f.lvl < s.top LEFT JOIN n x ON x.tree = f.tree AND x.lvl = f.lvl AND x.idx = xor(f.pos >> f.lvl, 1)),
g AS (SELECT f.tree, f.pos, rpos, 0 AS lvl, f.h, f.proof FROM f JOIN r ON f.tree = r.tree AND f.lvl = r.top
  UNION ALL SELECT g.tree, g.pos, g.rpos, g.lvl + 1, sha256(CASE WHEN x.idx < (g.rpos >> g.lvl) THEN x.h || g.h ELSE g.h || coalesce(x.h, '') END), g.proof || coalesce(x.h, '')
  FROM g JOIN w ON g.lvl < w.otop LEFT JOIN o x ON x.lvl = g.lvl AND x.idx = xor(g.rpos >> g.lvl, 1))
SELECT p.doc_id, p.leaf, r.subroot, w.root, sha256(g.proof) AS proof_sha256, g.h AS folded_root, g.h = w.root AS verified
FROM p JOIN r ON p.tree = r.tree JOIN g ON g.tree = p.tree AND g.pos = p.pos CROSS JOIN w WHERE g.lvl = w.otop""",
}
