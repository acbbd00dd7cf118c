import hashlib
import re
from collections import Counter
from fractions import Fraction

import pytest
from labelloom.llm import mixing
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, source string, __part int, pieces string"


def water(sizes, weights, most, share):
    """Targets by resharing round after round, as fractions."""
    targets, left, open_sources = [Fraction(0)] * len(sizes), Fraction(share[0] * sum(sizes), share[1]), set(range(len(sizes)))
    while left and open_sources:
        per, left = left / sum(weights[i] for i in open_sources), Fraction(0)
        for i in sorted(open_sources):
            targets[i] += per * weights[i]
            if targets[i] > most * sizes[i]:
                left += targets[i] - most * sizes[i]
                targets[i] = Fraction(most * sizes[i])
        open_sources = {i for i in open_sources if targets[i] < most * sizes[i]}
    return targets


def highest_quotients(targets, available, every):
    seats = [0] * len(targets)
    for _ in range(every):
        best = min((i for i in range(len(targets)) if seats[i] < available[i]), key=lambda i: (-float(targets[i]) / (2 * seats[i] + 1), i))
        seats[best] += 1
    return seats


def brute(docs, weights=(3, 1, 2), block=64, shards=16, seed=42):
    sized = [(i, len(re.findall(mixing.WORD, t or "")), s) for i, t, s in docs]
    sources = sorted({s for _, _, s in sized}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(n for _, n, s in sized if s == x) for x in sources]
    w = [weights[i % len(weights)] for i in range(len(sources))]
    targets = water(sizes, w, 2, (3, 2))
    blocks = [-(-n // block) for n in sizes]
    every = min(int(Fraction(3 * sum(sizes), 2 * block) + Fraction(1, 2)), 2 * sum(blocks))
    seats = highest_quotients(targets, [2 * b for b in blocks], every)
    taken, per_shard, first = Counter(), Counter(), 0
    for k, source in enumerate(sources):
        def key(d):
            i, n, _ = d
            m = hashlib.md5(f"{seed}:{'-' if i is None else i}:{n}".encode()).hexdigest()
            return int(m[:15], 16), (i is not None, i or 0), n

        words = [(d[0], d[1]) for d in sorted((d for d in sized if d[2] == source), key=key) for _ in range(d[1])]
        cut = [words[j : j + block] for j in range(0, len(words), block)]
        for j in range(seats[k]):
            taken.update(cut[j % len(cut)])
            per_shard[source, (first + j) % shards] += 1
        first += seats[k]
    count = Counter((i, n) for i, n, _ in sized)
    return dict(zip(sources, map(float, targets), strict=True)), taken, per_shard, count, every


def fixture():
    text = lambda n: " ".join(["wé"] * n)
    docs = [(i, text(7 * i % 53), "hot") for i in range(150)] + [(1000 + i, text(3 + i), f"s{i % 4}") for i in range(40)]
    docs += [(None, text(9), None), (None, text(9), None), (5, None, "hot"), (6, "", "empty"), (7, " \t\n", "empty"), (8, text(5), "Z"), (8, text(5), "Z"), (9, text(40000), "long"), (10, "a b c", "é")]
    return docs


def test_mix_against_brute_force(spark):
    docs = fixture()
    df = spark.createDataFrame([(i, t, s, 1, "x") for i, t, s in docs], SCHEMA).repartition(3)
    targets, taken, per_shard, count, every = brute(docs)
    rows = mixing.mixed(df).collect()
    assert len(rows) == len(docs)
    got, shard_words = Counter(), Counter()
    for r in rows:
        assert r.target == pytest.approx(targets[r.source], rel=1e-12)
        n = sum(p.word_to - p.word_from for p in r.pieces)
        assert 0 <= n <= 2 * r.size and all(0 <= p.word_from < p.word_to <= r.size for p in r.pieces)
        got[r.doc_id, r.size] += n
        for p in r.pieces:
            shard_words[p.shard] += p.word_to - p.word_from
    assert {k: v for k, v in got.items() if v} == dict(taken)
    assert sum(per_shard.values()) == every
    per_source = Counter()
    for r in rows:
        per_source[r.source] += sum(p.word_to - p.word_from for p in r.pieces)
    assert all(abs(per_source[s] - t) <= 2 * mixing.BLOCK for s, t in targets.items())
    # integer quotas: within one block of each other for a source, shards within one block of each other
    totals = df.select("source", mixing.word_count(F.col("text")).alias("n")).groupBy("source").agg(F.sum("n").alias("source_size"))
    quotas = mixing.shard_quotas(mixing.apportion(mixing.source_targets(totals))).collect()
    by_source = {}
    for q in quotas:
        by_source.setdefault(q.source, []).append(q.quota)
    seats = Counter()
    for (s, _), n in per_shard.items():
        seats[s] += n
    assert all(max(v) - min(v) <= 1 and sum(v) == seats[s] for s, v in by_source.items())
    assert max(shard_words.values()) - min(shard_words.values()) <= (len(by_source) + 1) * mixing.BLOCK


def test_pieces_cover_the_quotas(spark):
    docs = fixture()
    df = spark.createDataFrame([(i, t, s, 1, "x") for i, t, s in docs], SCHEMA)
    rows = mixing.mixed(df, block=5, shards=3).filter("source = 'hot'").select("doc_id", F.explode("pieces").alias("p")).select("doc_id", "p.*").collect()
    per = Counter()
    for r in rows:
        per[r.shard] += r.word_to - r.word_from
    _, taken, per_shard, _, _ = brute(docs, block=5, shards=3)
    assert {k: 5 * per_shard["hot", k] for k in range(3)} == pytest.approx(dict(per), abs=5)
    joined = mixing.mixed(df, block=5, shards=3).join(df.select("doc_id", "text", "source", mixing.word_count(F.col("text")).alias("size")).distinct(), ["doc_id", "source", "size"]).select("doc_id", "size", "text", F.explode("pieces").alias("p"))
    for r in joined.select("*", mixing.piece_texts(F.col("text"), F.col("p"), F.col("size")).alias("cut")).collect():
        assert re.findall(mixing.WORD, r.cut) == re.findall(mixing.WORD, r.text)[r.p.word_from : r.p.word_to]


def test_many_small_sources_and_empty_tables(spark):
    docs = [(i, " ".join(["a"] * (1 + i % 9)), f"src{i % 60:03d}") for i in range(300)]
    df = spark.createDataFrame([(i, t, s, 1, "x") for i, t, s in docs], SCHEMA)
    _, taken, _, _, _ = brute(docs)
    got = {r.doc_id: sum(p.word_to - p.word_from for p in r.pieces) for r in mixing.mixed(df).collect()}
    assert {k: v for k, v in got.items() if v} == {i: n for (i, _), n in taken.items()}
    assert mixing.mixed(df.limit(0)).collect() == []
    no_words = mixing.mixed(spark.createDataFrame([(1, None, None, 1, "x"), (2, "", "a", 1, "x")], SCHEMA)).collect()
    assert {(r.doc_id, r.size, r.target, len(r.pieces)) for r in no_words} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}
    with pytest.raises(ValueError):
        mixing.source_targets(df.select("source", F.lit(1).alias("source_size")), weights=(0, 1))


def test_large_counts_need_no_rows_per_seat(spark):
    totals = spark.createDataFrame([("a", 9 * 10**12), ("b", 10**12), ("c", 5), (None, 64)], "source string, source_size long")
    rows = {r.source: r for r in mixing.apportion(mixing.source_targets(totals)).collect()}
    assert sum(r.seats for r in rows.values()) == (3 * (10**13 + 69) + 64) // 128
    assert all(abs(r.seats * 64 - r.target) <= 128 for r in rows.values())


def test_query(spark, sf_dir):
    rows = mixing.op11_sainte_lague(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    again = {tuple(r) for r in mixing.op11_sainte_lague(spark, sf_dir).collect()}
    assert {tuple(r) for r in rows} == again
