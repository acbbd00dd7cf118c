import random
import re

import numpy as np
import pytest
from labelloom.llm import minhash

SCHEMA = "doc_id long, text string, n_shingles string"


def brute(docs, k):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(max(len(w) - k, 0) + 1)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def brute_rows(docs, k):
    """Rows (id, text): an id is linked with what any of its texts is linked with."""
    sets = [brute([(0, t)], k)[0][0] for _, t in docs]
    every = brute([((i, j), t) for j, (i, t) in enumerate(docs)], k)
    parent = {i: i for i, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, _), (_, (other, _)) in every.items():
        x, y = find(i), find(other)
        parent[max(x, y)] = min(x, y)
    return sorted((i, n, find(i), find(i) == i) for (i, _), n in zip(docs, sets, strict=True))


def near_copies(rng, n, size, edits):
    base = [f"w{rng.randrange(500)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            at = rng.randrange(len(w))
            if rng.random() < 0.3:
                del w[at]
            else:
                w[at] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("k", [4, 5])
def test_classes_against_brute_force(spark, k):
    rng = random.Random(k)
    texts = near_copies(rng, 70, 120, 9) + near_copies(rng, 12, 40, 4) + near_copies(rng, 10, 12, 2)
    texts += ["", None, " \n", "one", "ONE", "one two three", "one two three", "a b c d", "a b c d e", "é ü", "É ü"]
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(30)) for _ in range(20)]
    texts += [texts[0]] * 15
    docs = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "clash") for i, t in docs], SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, k).collect()}
    assert got == brute(docs, k)
    kept = {r.doc_id for r in minhash.keep_one(df, k).collect()}
    assert kept == {i for i, (_, c) in got.items() if i == c}


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c d e f", ""), (1, "a b c d e f", ""), (None, "a b c d e f", ""), (2, "A B C D E F", "")], SCHEMA)
    rows = sorted(minhash.near_duplicates(df, 4).collect(), key=str)
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in rows) == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False)]


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA), 4).count() == 0


def test_registers_estimate_similarity():
    rng = np.random.default_rng(0)
    a, b = minhash.multipliers()
    x = np.unique(rng.integers(0, 2**63, 2000, dtype=np.uint64))
    y = np.concatenate([x[:1800], rng.integers(0, 2**63, 200, dtype=np.uint64)])
    same = (minhash.registers_of(x, a, b) == minhash.registers_of(np.unique(y), a, b)).mean()
    assert abs(same - 1800 / 2200) < 0.12
    z = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    assert (minhash.registers_of(x, a, b) == minhash.registers_of(z, a, b)).mean() < 0.03


def test_a_thousand_near_copies(spark):
    """Most of them too far from any centre to be linked with it: links come from differences, and stay few."""
    rng = random.Random(9)
    texts = near_copies(rng, 1000, 80, 8) + [" ".join(f"u{rng.randrange(10**6)}" for _ in range(30)) for _ in range(100)]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, 4).collect()}
    assert got == brute(docs, 4)


def test_very_long_texts(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(120_000)]
    docs = [(0, " ".join(words)), (1, " ".join(words[:110_000])), (2, " ".join(words[:40_000])), (3, "x" * 1_000_000)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 4).collect()}
    assert got == brute(docs, 4)


BASE, OTHER = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
REPEATED = [
    [(3, BASE), (3, OTHER), (4, BASE + " q"), (6, OTHER + " q")],
    [(1, BASE), (5, BASE), (5, OTHER), (9, OTHER)],
    [(1, BASE), (5, BASE), (5, ""), (5, None), (7, "x y"), (7, OTHER), (8, "x y"), (9, OTHER + " z"), (2, "alone"), (2, "lone")],
    [(2, BASE), (2, BASE), (1, BASE + " q")],
]


@pytest.mark.parametrize("docs", REPEATED)
def test_repeated_ids_lose_no_link(spark, docs):
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA)
    assert sorted(tuple(r) for r in minhash.near_duplicates(df, 4).collect()) == brute_rows(docs, 4)


def test_repeated_ids_among_many(spark):
    rng = random.Random(9)
    texts = near_copies(rng, 40, 60, 6) + near_copies(rng, 20, 50, 5) + near_copies(rng, 20, 30, 3)
    docs = [(rng.randrange(60), t) for t in texts] + [(100 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(20))) for i in range(20)] + [(-5, texts[0]), (2**63 - 1, texts[-1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs] + [(None, texts[0], "x")], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in minhash.near_duplicates(df, 4).filter("doc_id IS NOT NULL").collect())
    assert got == brute_rows(docs, 4)


def test_one_of_each_class_stays_whatever_columns_are_called(spark):
    docs = [(1, BASE), (2, BASE + " q"), (3, OTHER), (None, BASE), (4, None)]
    df = spark.createDataFrame([(i, t, 7, "d", 1) for i, t in docs], "doc_id long, text string, __dropped long, rep string, __0 int")
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(1, BASE), (3, OTHER), (None, BASE), (4, None)], key=repr)
