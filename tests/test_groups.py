import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.functions.boxes import bool_text, hamming, hex_hash, median_bits
from labelloom.operators import checks, dedup, similarity, splits
from labelloom.operators.components import connected_components
from labelloom.operators.ranks import dense_positions
from labelloom.operators.similarity import BITS, best_bands, block_pairs, hamming_candidates, hamming_pairs, in_blocks, listings


def naive_components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components_against_naive(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = naive_components({x for e in edges for x in e}, edges)
    assert got == {n: c for n, c in want.items() if n in got}
    assert {n for e in edges if e[0] != e[1] for n in e} == set(got)


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("distance", "crowded"), [(0, 50), (1, 10**9), (2, 10**9), (2, 20), (5, 10**9), (9, 40), (16, 10**9), (17, 200), (40, 10**9)])
def test_hamming_join_is_exact(spark, distance, crowded):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(12)]
    values = [b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) for b in base for _ in range(5)]
    values = [(v & (1 << 64) - 1) - (1 << 64 if v & (1 << 63) else 0) for v in values]
    df = spark.createDataFrame(list(enumerate(values)), "id long, h long")
    rows = hamming_pairs(df, "id", "h", distance, crowded).collect()
    got = {(r.a, r.b, r.distance) for r in rows}
    assert len(got) == len(rows)
    first = {}
    for i, v in enumerate(values):
        first.setdefault(v, i)
    nodes = sorted((i, v) for v, i in first.items())
    want = {(i, j, bin((v ^ w) & (1 << 64) - 1).count("1")) for i, v in nodes for j, w in nodes if i < j}
    assert got == {x for x in want if x[2] <= distance}


def test_hashes(spark):
    row = spark.range(1).select(hamming(hex_hash(F.lit("0" * 16)), hex_hash(F.lit("f" * 16))), hamming(hex_hash(F.lit("0" * 16)), hex_hash(F.lit("0" * 15 + "1"))), hex_hash(F.lit("f" * 16)), median_bits(F.array(*[F.lit(float(v)) for v in (1, 5, 2, 9)]))).first()
    assert tuple(row) == (64, 1, -1, 0b0101)


def test_bands_add_up_and_stay_few():
    for budget in range(65):
        for n in (10, 10**4, 10**12):
            bands = best_bands(BITS, budget, n)
            assert sum(r + 1 for _, r in bands) == budget + 1 and sorted(b for bits, _ in bands for b in bits) == list(BITS)
    assert [r for _, r in best_bands(BITS, 2, 10**6)] == [0, 0, 0]


def test_wide_distances_meet_few_pairs(spark):
    rng = random.Random(4)
    values = [rng.getrandbits(63) for _ in range(3000)]
    nodes = spark.createDataFrame(list(enumerate(values)), "id long, h long")
    want = {(i, j) for i in range(3000) for j in range(i + 1, 3000) if bin(values[i] ^ values[j]).count("1") <= 16}
    assert {(r.a, r.b) for r in hamming_candidates(nodes, 16).collect()} == want
    plan = hamming_candidates(nodes, 16)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert meetings(nodes, 12) < 3000 * 2999 // 2 / 2


@pytest.mark.parametrize("block", [7, 300, 5000])
def test_blocks_of_hashes_are_exact(spark, block):
    rng = random.Random(block)
    values = sorted({(b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(20)))) & (1 << 64) - 1 for b in (0, (1 << 64) - 1, rng.getrandbits(64)) for _ in range(100)})
    rows = [(f"n{i:03d}", v - (1 << 64 if v >> 63 else 0)) for i, v in enumerate(values)]
    got = [tuple(r) for r in block_pairs(spark.createDataFrame(rows, "id string, h long"), 16, len(rows), block).collect()]
    want = {(*rows[i], *rows[j]) for i in range(len(rows)) for j in range(i + 1, len(rows)) if bin(values[i] ^ values[j]).count("1") <= 16}
    assert len(got) == len(want) and set(got) == want


def test_wide_distances_over_many_hashes_list_nothing(spark):
    # an index at 16 bits would list 1,000 values for each of 100,000 hashes
    assert in_blocks(16, 100_000) and not in_blocks(2, 10**7) and not in_blocks(16, 1000)
    values = [random.Random(i).getrandbits(63) for i in range(500)]
    nodes = spark.createDataFrame(list(enumerate(values)), "id long, h long")
    got = {(r.a, r.b) for r in hamming_candidates(nodes, 20, indexed=0).collect()}
    assert got == {(i, j) for i in range(500) for j in range(i + 1, 500) if bin(values[i] ^ values[j]).count("1") <= 20}


def test_groups_over_blocks_of_hashes(spark, monkeypatch):
    # as variant_groups and near_duplicate_links run from 0.5 GB on
    monkeypatch.setattr(similarity, "in_blocks", lambda *_: True)
    monkeypatch.setattr(similarity, "BLOCK", (40, 40))
    rng = random.Random(5)
    bases = [rng.getrandbits(63) for _ in range(20)]
    rows = [(i, f"k{rng.randrange(150)}", rng.choice(bases) ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(12)))) for i in range(300)]
    rows += [(300, "", None), (301, "k1", None), (302, "other", rows[0][2])]
    records = spark.createDataFrame(rows, "ord long, original_key string, phash long")
    same_key = [(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] != ""]
    near = [(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and None not in (a[2], b[2]) and bin(a[2] ^ b[2]).count("1") <= 16]
    origins, want = (naive_components([r[0] for r in rows], e) for e in (same_key, same_key + near))
    assert {r.ord: r.group_ord for r in dedup.variant_groups(records, distance=16).collect()} == want
    assert dedup.links_made(records, distance=16) == len(set(origins.values())) - len(set(want.values()))


def test_a_cluster_of_near_hashes_makes_few_links(spark, monkeypatch):
    # 300 hashes of three set bits each, all within 6 bits, and 200 far from all others; blocks of 100
    monkeypatch.setattr(similarity, "in_blocks", lambda *_: True)
    monkeypatch.setattr(similarity, "BLOCK", (100, 100))
    rng = random.Random(6)
    values = list(dict.fromkeys(sum(1 << b for b in rng.sample(range(63), 3)) for _ in range(320)))[:300]
    values += [rng.getrandbits(63) for _ in range(200)]
    records = spark.createDataFrame([(i, f"k{i}", v) for i, v in enumerate(values)], "ord long, original_key string, phash long")
    edges = []
    monkeypatch.setattr(dedup, "connected_components", lambda e: edges.append(e.persist()) or connected_components(edges[-1]))
    got = {r.ord: r.group_ord for r in dedup.variant_groups(records, distance=8).collect()}
    pairs = {(i, j) for i in range(500) for j in range(i + 1, 500) if bin(values[i] ^ values[j]).count("1") <= 8}
    links = [tuple(r) for r in edges[0].collect()]
    assert len(pairs) >= 300 * 299 / 2 and set(links) <= pairs
    # each of 15 pairs of blocks hands on fewer than its hashes
    assert len(links) == len(set(links)) < 15 * 200
    assert got == naive_components(range(500), pairs)


@pytest.mark.parametrize(("left", "after", "right"), [(50, 0, 50), (40, 40, 30)])
def test_forest_connects_what_pairs_connect(left, after, right):
    rng = random.Random(left)
    pairs = [(i, j) for i in range(left) for j in range(right) if (i < j or after) and rng.random() < 0.04]
    parts = [np.array(pairs[k : k + 9]).T for k in range(0, len(pairs), 9)]
    kept = [(int(a), int(b)) for i, j in similarity.forest(iter(parts), left, after, right) for a, b in zip(i, j, strict=True)]
    places = range(max(left, after + right))
    want = naive_components(places, [(a, b + after) for a, b in pairs])
    assert set(kept) <= set(pairs) and len(kept) == len(places) - len(set(want.values()))
    assert naive_components(places, [(a, b + after) for a, b in kept]) == want


def meetings(nodes, distance):
    total = 0
    for index, _ in listings(nodes, distance):
        sides = index.groupBy("way", "path").agg(F.count_if(F.col("side") == 0).alias("l"), F.count_if(F.col("side") == 1).alias("r"))
        total += sides.agg(F.sum(F.col("l") * F.col("r"))).first()[0] or 0
    return total


def test_one_crowded_band_value(spark):
    # 50,000 hashes that share their upper 22 bits, in two shapes: spread, and close to each other
    n = 50_000
    spread = spark.range(n).select("id", F.xxhash64("id").bitwiseAND(F.lit((1 << 42) - 1)).bitwiseOR(F.lit(5 << 42)).alias("h"))
    close = spark.createDataFrame([(n + 42 * i + j, (5 << 42) | (1 << i) | (1 << j)) for i in range(42) for j in range(i)], "id long, h long")
    nodes = spread.union(close).dropDuplicates(["h"])
    m = nodes.count()
    assert m > 50_000 and meetings(nodes, 2) < m * (m - 1) / 2 / 10
    got = {(r.a, r.b) for r in hamming_candidates(nodes, 2).collect()}
    rows = {r.h: r.id for r in nodes.collect()}
    flips = [*[1 << i for i in range(42)], *[(1 << i) | (1 << j) for i in range(42) for j in range(i)]]
    want = {(min(i, rows[h ^ f]), max(i, rows[h ^ f])) for h, i in rows.items() for f in flips if h ^ f in rows}
    assert got == want


def test_negative_distance(spark):
    with pytest.raises(ValueError):
        hamming_pairs(spark.createDataFrame([(1, 1)], "id long, h long"), "id", "h", -1)
    with pytest.raises(ValueError):
        dedup.variant_groups(spark.createDataFrame([(1, "a", 1)], "ord long, original_key string, phash long"), distance=-1)


def test_exact_dedup_and_conflicts(spark):
    df = spark.createDataFrame([("h1", 0, "x"), ("h1", 1, "x"), ("h2", 2, "x"), ("h2", 3, "y"), ("h3", 4, None), ("h3", 5, "[]")], "sha256 string, ord long, signature string")
    unique, conflicts, removed = dedup.exact_dedup(df)
    assert [r.ord for r in unique.orderBy("ord").collect()] == [0]
    assert {r.sha256: list(r.ids) for r in conflicts.collect()} == {"h2": [2, 3], "h3": [4, 5]}
    assert [r.ord for r in removed.collect()] == [1]


def test_signature_rounds_to_five_places(spark):
    box = "array<struct<class_id:int,x:double,y:double,w:double,h:double>>"
    df = spark.createDataFrame([([(0, 0.1000001, 0.2, 0.3, 0.4), (1, 0.5, 0.5, 0.1, 0.1)],), ([(1, 0.5, 0.5, 0.1, 0.1), (0, 0.1, 0.2, 0.3, 0.4)],), ([(0, 0.1001, 0.2, 0.3, 0.4)],)], f"b {box}")
    a, b, c = [r[0] for r in df.select(dedup.annotation_signature(F.col("b"))).collect()]
    assert a == b != c


@pytest.mark.parametrize(("hashes", "origins", "same"), [(("00", "01"), ("a", "b"), True), (("00", "ff"), ("a", "a"), True), (("00", "ff"), ("a", "b"), False), (("00", "ff"), ("", ""), False)])
def test_variant_groups(spark, hashes, origins, same):
    df = spark.createDataFrame([(i, o, int(h, 16)) for i, (h, o) in enumerate(zip(hashes, origins))], "ord long, original_key string, phash long")
    got = dedup.variant_groups(df, distance=2).orderBy("ord").collect()
    assert (got[0].group_id == got[1].group_id) is same and got[0].group_id == "group_000000"


def test_chain_and_links(spark):
    df = spark.createDataFrame([(0, "a", 0), (1, "b", 3), (2, "c", 15), (3, "d", 0xFFF << 40), (4, "d", 0xFFF << 20)], "ord long, original_key string, phash long")
    got = {r.ord: r.group_ord for r in dedup.variant_groups(df, distance=2).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3}
    assert dedup.links_made(df, distance=2) == 2


def records(spark, groups):
    return spark.createDataFrame(groups, "group_id string, source string, instances_class_0 long, instances_class_1 long")


def choices(rows, seed, split_of, ratios=splits.RATIOS):
    """(vectors, choices) in the order in which groups are placed."""
    groups = sorted({r[0] for r in rows})
    sources = sorted({r[1] for r in rows})
    held = {g: np.zeros(3 + len(sources)) for g in groups}
    for g, s, a, b in rows:
        held[g] += [1, a, b, *(s == x for x in sources)]
    placed = sorted(groups, key=lambda g: (-held[g][0], -held[g][1:3].sum(), g))
    placed = np.roll(np.array(placed, object), -(seed % len(placed)))
    return np.stack([held[g] for g in placed]), np.array([list(ratios).index(split_of[g]) for g in placed])


def least_cost_everywhere(vectors, chosen, rule, ratios=splits.RATIOS):
    """Whether every choice costs least given the choices before it, all steps at once."""
    n, want = len(vectors), np.outer(list(ratios.values()), vectors.sum(axis=0))
    picked = np.eye(len(ratios))[chosen]
    before = np.cumsum(picked[:, :, None] * vectors[:, None], axis=0) - picked[:, :, None] * vectors[:, None]
    groups = np.cumsum(picked, axis=0) - picked
    over = before + vectors[:, None] - want
    cost = over**2 / want**2 if rule == "own" else (over**2 - (before - want) ** 2) / (want * want.sum(axis=0))
    cost = np.nan_to_num(cost).sum(axis=2).round(9)
    must_fill = (groups == 0).sum(axis=1) == n - np.arange(n)
    cost[must_fill[:, None] & (groups > 0)] = np.inf
    names = np.argsort(np.argsort(list(ratios)))
    best = [min(range(len(ratios)), key=lambda s: (cost[i, s], groups[i, s], names[s])) for i in range(n)]
    return best == chosen.tolist()


@pytest.mark.parametrize("rule", ["own", "marginal"])
@pytest.mark.parametrize("seed", [0, 42])
def test_each_choice_costs_least(spark, seed, rule):
    rng = random.Random(seed)
    rows = [(f"g{rng.randrange(25):02d}", f"s{rng.randrange(3)}", rng.randrange(4), rng.randrange(3)) for _ in range(90)]
    got = {r.group_id: r.split for r in splits.assign_splits(records(spark, rows), seed=seed, rule=rule, shards=1).collect()}
    assert set(got) == {r[0] for r in rows} and least_cost_everywhere(*choices(rows, seed, got), rule)
    # the property tells a wrong choice
    wrong = got | {min(got): next(s for s in splits.RATIOS if s != got[min(got)])}
    assert not least_cost_everywhere(*choices(rows, seed, wrong), rule)


@pytest.mark.parametrize("rule", ["own", "marginal"])
def test_more_groups_than_a_fold_takes(spark, rule):
    rng = random.Random(6)
    rows = [(f"g{rng.randrange(70):02d}", f"s{rng.randrange(3)}", rng.randrange(4), rng.randrange(3)) for _ in range(150)]
    one = {(r.group_id, r.split) for r in splits.assign_splits(records(spark, rows), rule=rule, shards=1).collect()}
    for most in (9, 60):
        assert {(r.group_id, r.split) for r in splits.assign_splits(records(spark, rows), rule=rule, shards=1, most=most).collect()} == one
    few = [(f"g{i}", "s", 9 - i, 1) for i in range(5)]
    got = lambda **k: {(r.group_id, r.split) for r in splits.assign_splits(records(spark, few), rule=rule, shards=1, **k).collect()}
    assert got(most=1) == got()


def test_marginal_rule_meets_ratios(spark):
    rows = [(f"g{i:03d}", "s", 1, 1) for i in range(300)]
    got = [r.split for r in splits.assign_splits(records(spark, rows)).collect()]
    assert {s: got.count(s) for s in set(got)} == {"train": 210, "val": 45, "test": 45}
    sharded = splits.assign_splits(records(spark, rows), shards=4).groupBy("split").count().collect()
    assert all(abs(r["count"] / 300 - splits.RATIOS[r.split]) < 0.05 for r in sharded)


def test_three_groups_each_get_a_split(spark):
    rows = [("a", "s", 0, 0), ("b", "s", 0, 0), ("c", "s", 0, 0)]
    assert {r.split for r in splits.assign_splits(records(spark, rows)).collect()} == {"train", "val", "test"}
    with pytest.raises(Exception, match="at least 3 groups"):
        splits.assign_splits(records(spark, rows[:2])).collect()


def manifest(spark, rows):
    return spark.createDataFrame(rows, "split string, group_id string, sha256 string, original_key string, instances_class_0 long, instances_class_1 long")


def even(n0=5, n1=5, sizes=(("train", 10), ("val", 5), ("test", 5))):
    return [(s, f"{s}{i}", f"h{s}{i}", f"k{s}{i}", n0, n1) for s, n in sizes for i in range(n)]


def test_checks(spark):
    assert checks.check_split(manifest(spark, even())).count() == 0
    few = {(r.check, r.key) for r in checks.check_split(manifest(spark, even(sizes=(("train", 5), ("val", 2), ("test", 2))))).collect()}
    assert {("groups", "train"), ("groups", "val"), ("groups", "test")} <= few
    scarce = {(r.check, r.key) for r in checks.check_split(manifest(spark, even(n1=0))).collect()}
    assert scarce == {("boxes", "val:1"), ("boxes", "test:1")}
    rows = even()
    rows[0] = ("train", "val0", "h", "kval1", 5, 5)
    leak = checks.check_split(manifest(spark, rows))
    assert {r.check for r in leak.collect()} == {"leak_group_id", "leak_original_key"}
    with pytest.raises(ValueError, match="leak_group_id"):
        checks.assert_checks(leak)
    assert "empty" in {r.check for r in checks.check_split(manifest(spark, [])).collect()}


def test_null_keys_do_not_leak(spark):
    rows = [(s, g, None, None, a, b) for s, g, _, _, a, b in even()]
    assert checks.check_split(manifest(spark, rows)).count() == 0


def test_stems(spark):
    images = spark.createDataFrame([("train", "a"), ("train", "b")], "split string, stem string")
    labels = spark.createDataFrame([("train", "b"), ("train", "c")], "split string, stem string")
    assert {(r.key, r.detail) for r in checks.check_stems(images, labels).collect()} == {("train/a", "no label"), ("train/c", "no image")}


def test_bool_text(spark):
    df = spark.createDataFrame([("True",), ("no",), (" 1 ",)], "t string")
    assert [r[0] for r in df.select(bool_text(F.col("t"))).collect()] == [True, False, True]
    with pytest.raises(Exception, match="not a boolean"):
        spark.createDataFrame([("maybe",)], "t string").select(bool_text(F.col("t"))).collect()


def test_dense_positions(spark):
    df = spark.range(100).select((F.col("id") * 37 % 101).alias("v"))
    got = dense_positions(df, "v", "p").orderBy("p").collect()
    assert [r.p for r in got] == list(range(100)) and [r.v for r in got] == sorted(r.v for r in got)
