import hashlib
import zlib

import numpy as np
import pytest
from labelloom.llm import manifest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos int, tree string, block int, root string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree_of(leaves):
    """(root, siblings of each leaf), node lists level by level."""
    row, at, found, sides = list(leaves), list(range(len(leaves))), [[] for _ in leaves], [[] for _ in leaves]
    while len(row) > 1:
        runs = [row[i : i + 2] for i in range(0, len(row), 2)]
        for k, i in enumerate(at):
            run = runs[i // 2]
            found[k] += [x for j, x in enumerate(run) if j != i % 2]
            sides[k].append((i % 2, len(run)))
            at[k] = i // 2
        row = [h(*r) for r in runs]
    return row[0], found, sides


def climb(leaf, siblings, sides):
    siblings = iter(siblings)
    for place, size in sides:
        leaf = h(leaf) if size == 1 else h(*((leaf, next(siblings)) if place == 0 else (next(siblings), leaf)))
    return leaf


def brute(docs):
    langs = sorted({d[2] for d in docs}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        rows = sorted(([d, h(*map(field, d))] for d in docs if d[2] == lang), key=lambda r: (r[0][0] is not None, r[0][0] or 0, r[1]))
        trees.append((rows, *tree_of([r[1] for r in rows])))
    root, above, above_sides = tree_of([t[1] for t in trees])
    out = []
    for k, (rows, subroot, found, sides) in enumerate(trees):
        for (d, leaf), siblings, side in zip(rows, found, sides, strict=True):
            way = siblings + above[k]
            shown = leaf
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0 and d[3] is not None:
                shown = h(*map(field, (*d[:3], d[3] + 1, d[4])))
            folded = climb(shown, way, side + above_sides[k])
            out.append((d[0], leaf, subroot, root, h(*way), folded, folded == root))
    return sorted(out, key=repr)


def fixture():
    docs = [(i, f"s{i % 3}", "en", i * 3, f"text {i} é中") for i in range(45)]
    docs += [(100 + i, "s", "de", i, "x" * i) for i in range(9)] + [(200, None, "fr", None, None)]
    docs += [(300 + i, "q", None, 1, "n") for i in range(6)] + [(None, "s", "en", 1, "null id"), (None, "s", "en", 1, "null id"), (7, "s1", "en", 21, "other"), (8, "s2", "en", 24, "text 8 é中")]
    return docs + [(400, "", "", 0, ""), (401, None, "", 0, None), (500, "s", "es", 2**63 - 1, "long " * 100000), (503, "s", "es", None, ""), (510, "s", "é", 3, "a|b:c")]


def got(spark, docs, height):
    df = spark.createDataFrame([(*d, 1, "t", 2, "r") for d in docs], SCHEMA).repartition(3)
    changed = {f: F.col(f) for f in manifest.FIELDS} | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    numbered = manifest.leaves(df, {"shown": F.when(tampered, manifest.leaf_digest(changed))}).withColumn("shown", F.coalesce("shown", "leaf"))
    out = manifest.proofs(numbered, *manifest.build_manifest(numbered, height), "shown", height)
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, h(r.siblings), r.folded_root, r.folded_root == r.root) for r in out.collect()), key=repr)


@pytest.mark.parametrize("height", [1, 2, 10])
def test_manifest_against_brute_force(spark, height):
    docs = fixture()
    rows = got(spark, docs, height)
    assert rows == brute(docs)
    assert any(not r[-1] for r in rows) and any(r[-1] for r in rows)


def test_lone_rows_and_empty_tables(spark):
    for docs in ([(1, "s", "en", 1, "a")], [(None, None, None, None, None)], [(7, "s", None, 1, "a"), (8, "s", "en", 1, "a")]):
        assert got(spark, docs, 3) == brute(docs)
    assert got(spark, [], 3) == []


def test_layout_is_recursive_and_whole():
    for levels in range(13):
        at = manifest.layout(levels)
        assert [len(x) for x in at] == [2 ** (levels - i) for i in range(levels + 1)]
        assert sorted(np.concatenate(at).tolist()) == list(range(2 ** (levels + 1) - 1))
    # four levels of nodes: the upper two first, then each lower tree of three nodes in one stretch
    leaves, low, high, root = manifest.layout(3)
    assert root.tolist() == [0] and high.tolist() == [1, 2]
    assert low.tolist() == [3, 6, 9, 12] and leaves.tolist() == [4, 5, 7, 8, 10, 11, 13, 14]


def test_any_change_breaks_the_proof():
    leaves = [h(str(i)) for i in range(11)]
    nodes, root = manifest.build(leaves, 4)
    for leaf, (siblings, sides) in zip(leaves, manifest.paths(nodes, 11, 4), strict=True):
        assert manifest.fold(leaf, "".join(siblings), sides) == root
        assert manifest.fold(h("other"), "".join(siblings), sides) != root


def test_query(spark, sf_dir):
    rows = manifest.op12_veb_merkle(spark, sf_dir)
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert rows.count() == n and rows.select("root").distinct().count() == 1
