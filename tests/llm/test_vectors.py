import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from labelloom.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, n int, points string"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [float(x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    length = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts)) * parts
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[min(max(math.floor(4096 * x), -(2**62)), 2**62) for x in v] + [0] * (length - len(v)) for _, v, _ in kept]
    w = length // parts
    cut = [[v[p * w : p * w + w] for p in range(parts)] for v in ints]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda c, p: min(range(len(books[p])), key=lambda e: (dist(c[p], books[p][e]), e))
    for _ in range(rounds):
        at = [[nearest(c, p) for p in range(parts)] for c in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, a in zip(cut, at, strict=True) if a[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = []
    for (i, _, label), c in zip(kept, cut, strict=True):
        code = [nearest(c, p) for p in range(parts)]
        out.append((i, label, "".join(f"{e:02x}" for e in code), min(sum(dist(c[p], books[p][e]) for p, e in enumerate(code)), 2**63 - 1)))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(out, key=repr), digest if kept else hashlib.sha256(b"").hexdigest()


def got(spark, rows, **options):
    df = spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows], SCHEMA).repartition(3)
    codes, book = vectors.vector_codes(df, **options)
    return sorted(((r.vec_id, r.label, r.code, r.error) for r in codes.collect()), key=repr), vectors.book_digest(book)


def clusters(rng, n, length=64, spread=0.02):
    centres = [[rng.gauss(0, 0.1) for _ in range(length)] for _ in range(7)]
    return [np.float32([x + rng.gauss(0, spread) for x in rng.choice(centres)]).tolist() for _ in range(n)]


def test_codes_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, v, i % 3 if i % 5 else None) for i, v in enumerate(clusters(rng, 400))]
    rows += [(500, None, 1), (501, [0.1] * 63 + [None], 1), (502, [float("nan")] + [0.0] * 63, 1), (503, [float("inf")] * 64, 2), (3, rows[9][1], 1), (None, rows[4][1], None)]
    rows += [(600 + i, rows[0][1], 0) for i in range(150)]
    assert got(spark, rows) == brute(rows)


def test_ties_and_few_vectors(spark):
    rng = random.Random(2)
    coarse = [(i, [rng.randrange(3) / 4096 for _ in range(16)], 0) for i in range(300)]
    assert got(spark, coarse, parts=8) == brute(coarse)
    few = [(i, [float(i)] * 8, 0) for i in range(5)] + [(9, [1.0] * 8, 0)]
    assert got(spark, few) == brute(few)
    assert got(spark, []) == ([], hashlib.sha256(b"").hexdigest())
    assert got(spark, [(1, None, 0)])[0] == []


def test_short_and_huge_vectors(spark):
    rng = random.Random(3)
    rows = [(i, v, 0) for i, v in enumerate(clusters(rng, 60, 20))] + [(100, [], 1), (101, [0.5] * 3, 1)]
    assert got(spark, rows) == brute(rows)
    huge = rows + [(200, [1e5] * 20, 0), (201, [-3e38] * 20, 0), (202, [7e4] + [0.0] * 19, 0)]
    assert got(spark, huge) == brute(huge)


def test_nodes_are_assigned_whole_and_exactly():
    rng = np.random.default_rng(0)
    centres = rng.integers(-3000, 3000, (12, 8))
    values = (centres[rng.integers(0, 12, 2000)][:, None, :] + rng.integers(-60, 60, (2000, 4, 8))).astype(np.int64)
    points = np.ascontiguousarray(values.transpose(1, 0, 2))
    order = vectors.tree_order(points)
    assert all(sorted(o) == list(range(2000)) for o in order)
    points = np.take_along_axis(points, order[:, :, None], axis=1)
    low, high, sums = vectors.node_values(points)
    assert (sums[:, 0] == points.sum(axis=1)).all() and (low[:, 0] == points.min(axis=1)).all() and (high[:, 0] == points.max(axis=1)).all()
    for k in (1, 2, 12, 16):
        book = np.ascontiguousarray(points[:, :: 2000 // k][:, :k])
        fast, slow = vectors.assign(points, (low, high, sums), book), vectors.assign(points.astype(object), None, book.astype(object))
        for a, b in zip(fast[:3], slow[:3], strict=True):
            assert (a == b).all()
    book = np.repeat(centres[None], 4, axis=0)
    entry, counts, _, whole = vectors.assign(points, (low, high, sums), book)
    assert whole > 0.5 and (counts.sum(axis=1) == 2000).all() and (entry >= 0).all()


def test_integers_floor_downwards():
    values = vectors.integers(pa.array([[-0.0001, 0.0001, 1.0], [2.0]], pa.list_(pa.float32())), 4)
    assert values.tolist() == [[-1, 0, 4096, 0], [8192, 0, 0, 0]]


def test_label_errors(spark, sf_dir):
    rows = vectors.op13_dual_tree_codes(spark, sf_dir).collect()
    per = {}
    labels = {r.vec_id: r.label for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    for r in rows:
        per[labels[r.vec_id]] = per.get(labels[r.vec_id], 0) + r.error
    assert rows and all(r.label_error == per[labels[r.vec_id]] and len(r.code) == 16 for r in rows)


@pytest.mark.parametrize("entries", [0, 257])
def test_entries_have_a_byte(spark, entries):
    with pytest.raises(ValueError):
        vectors.vector_codes(spark.createDataFrame([], SCHEMA), entries=entries)
