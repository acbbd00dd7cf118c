import bisect
import hashlib
import json
import re
import zlib

import numpy as np
import pytest
from labelloom.llm import decontaminate, licenses, media, packing, pii, quality, sharding, token_files, tokens
from pyspark.sql import functions as F

ODD = [None, "", " ", "\n\n", "x", "Ünïcode 😀 text\x00\x1c", "a" * 5000, "word " * 9000, "same text", "same text", "+1 (743) 555-3824", "mail me: a.b@c.example.org now", "4111 1111 1111 1111 and 10.0.0.255", "Released under the MIT License."]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans string, cuts string"


def docs(spark, texts=None):
    rows = [(i, t, ("en", None)[i % 2], ("s", None)[i % 3 == 0], len(t or ""), "clash", "clash") for i, t in enumerate(ODD if texts is None else texts)]
    return spark.createDataFrame(rows, DOCS)


def encoded():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_path())
    return {i: [*t.encode(x or "", add_special_tokens=False).ids, 1] for i, x in enumerate(ODD)}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# -- tokens, packing, token files ---------------------------------------------------------------------------


def test_encoder_equals_the_library():
    import random

    rng = random.Random(1)
    alphabet = "abcXYZéÉßÀ'’st re ll d m!?.,_-%$#<>|()  \t\n\x0b\x1c\x85\xa0 01Ⅷ日本ñ̸̌ΣςİıǰK<|endoftext|>😀"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(50))) for _ in range(3000)]
    enc = tokens.WordEncoder(tokens.default_path(), memory=500)  # forgets all the time
    for lo in range(0, len(texts), 100):
        part = texts[lo : lo + 100]
        ids, off = enc.batch([t.encode() for t in part])
        want = enc.tokenizer.encode_batch(part, add_special_tokens=False)
        assert [ids[off[i] : off[i + 1]].tolist() for i in range(len(part))] == [w.ids for w in want]


MARKED = ["a <|endoftext|> b", "A<|endoftext|>B", "<|startoftext|>", "<|ENDOFTEXT|> X", "<|EndOfText|>", "<|endoftext| >", "e<|endoftext|>\u0301 É", "é.<|endoftext|>__", "<|endoftext|><|startoftext|>'s", "<|endóftext|>", "<|"]


def test_added_tokens_as_an_untouched_tokenizer_has_them(spark, tmp_path):
    import random

    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_path())
    rng = random.Random(8)
    pieces = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", "A", "é", "Σ", "'s", ".", "_", " ", "\n", "\x1c", "\xa0", "\u0301", "7"]
    texts = MARKED + ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(2000)]
    assert plain.encode(texts[0], add_special_tokens=False).ids == [320, 49407, 321]
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    for memory in (50, 5000):
        ids, off = tokens.WordEncoder(tokens.default_path(), memory).batch([t.encode() for t in texts])
        assert [ids[off[i] : off[i + 1]].tolist() for i in range(len(texts))] == want
    path, at = f"file://{tmp_path}/t", 0
    token_files.write_tokens(docs(spark, MARKED), path, tokens.default_path())
    back = {r.doc_id: (r.start, r.ids) for r in token_files.read_tokens(spark, path).collect()}
    packed = {r.doc_id: r for r in packing.pack_documents(docs(spark, MARKED), tokens.default_path()).collect()}
    for i in range(len(MARKED)):
        assert back[i] == (at, [*want[i], 1]) and packed[i].ids_crc32 == crc([*want[i], 1])
        at += len(want[i]) + 1


def test_packing(spark):
    rows = packing.pack_documents(docs(spark), tokens.default_path(), capacity=512).collect()
    ids = encoded()
    by_doc = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == 512 * r.piece and r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length])
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + r.length
    assert by_doc == {i: len(x) for i, x in ids.items()}
    fill = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 512 and len(fill) == -(-sum(by_doc.values()) // 512)
    assert packing.pack_documents(docs(spark, []), tokens.default_path()).count() == 0


def best_fit(slots, lengths):
    """Sequential best fit: (slot, length) of each match, the longest first; slots are used once."""
    free, out = sorted(slots), []
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(free, n)
        if k < len(free):
            out.append((free.pop(k), n))
    return sorted(out)


@pytest.mark.parametrize(("seed", "parts"), [(0, 1), (1, 7), (2, 7), (3, 20)])
def test_sweep_is_sequential_best_fit(spark, seed, parts):
    rng = np.random.default_rng(seed)
    slots = [int(x) for x in rng.integers(1, [500, 500, 20, 500][seed], 300)]
    lengths = [int(x) for x in rng.integers(1, [500, 300, 20, 700][seed], 400)]
    waiting = spark.createDataFrame(list(enumerate(lengths)), "n long, length long")
    free = spark.createDataFrame(list(enumerate(slots)), "sequence_id long, size long")
    got = packing.settle(waiting, free, parts).collect()
    assert sorted((r.n, r.length) for r in got) == list(enumerate(lengths))
    used = [r.sequence_id for r in got if r.sequence_id is not None]
    assert len(set(used)) == len(used)
    assert sorted((slots[r.sequence_id], r.length) for r in got if r.sequence_id is not None) == best_fit(slots, lengths)


def test_sweep_without_slots_or_pieces(spark):
    none = spark.createDataFrame([], "n long, length long")
    free = spark.createDataFrame([(3, 5)], "sequence_id long, size long")
    assert packing.settle(none, free).collect() == []
    assert [tuple(r) for r in packing.settle(spark.createDataFrame([(0, 6)], "n long, length long"), free).collect()] == [(0, 6, None)]


@pytest.mark.parametrize(("mean", "parts"), [(30, None), (300, 5), (3000, 5)])
def test_packing_needs_no_more_than_best_fit_decreasing(spark, mean, parts):
    sizes = np.minimum(4096, np.random.default_rng(mean).geometric(1 / mean, 3000)).tolist()
    rows = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(sizes)], packing.PIECES)
    fill = {}
    for r in sorted(packing.pack(rows, parts=parts).collect(), key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0) and r.length == sizes[r.doc_id]
        fill[r.sequence_id] = r.offset + r.length
    assert sum(fill.values()) == sum(sizes) and max(fill.values()) <= 4096
    gaps = []  # best fit decreasing, one after the other
    for n in sorted(sizes, reverse=True):
        k = bisect.bisect_left(gaps, n)
        bisect.insort(gaps, (gaps.pop(k) if k < len(gaps) else 4096) - n)
    assert len(fill) <= len(gaps) * 1.002 + 1


def test_equal_pieces_fill_sequences_in_few_rounds(spark, monkeypatch):
    rounds, settle = [], packing.settle
    monkeypatch.setattr(packing, "settle", lambda *a: rounds.append(1) or settle(*a))
    rows = spark.range(20_000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "IF(id % 3 = 0, 20L, 1L) AS length", "0L AS ids_crc32")
    out = packing.pack(rows)
    assert out.count() == 20_000 and out.select("sequence_id").distinct().count() == -(-146_676 // 4096)
    assert len(rounds) <= 6


def test_a_round_of_packing_takes_few_jobs(spark, monkeypatch):
    # the driver keeps a record of every job: what a round asks of its tables is observed while they are written
    rounds, settle, context = [], packing.settle, spark.sparkContext
    monkeypatch.setattr(packing, "settle", lambda *a: rounds.append(1) or settle(*a))
    sizes = np.random.default_rng(5).integers(1, 2049, 2000).tolist()
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "n long, length long")
    context.setJobGroup("packing-rounds", "")
    placed = packing.place(rows, 4096)
    jobs = len(context.statusTracker().getJobIdsForGroup("packing-rounds"))
    context.setJobGroup("", "")
    assert placed.count() == 2000 and len(rounds) >= 4
    assert jobs <= 10 * len(rounds)


def test_coder_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 31, 33, 5000, 40000):
        ids = (rng.zipf(1.4, n) % 49000).astype(np.uint32)
        coder = token_files.Coder(token_files.frequencies(np.bincount(ids, minlength=5)))
        payload = coder.encode(ids)
        assert (coder.decode(payload) == ids).all()
        if n > 100:
            broken = bytearray(payload)
            broken[len(payload) // 2] ^= 255
            with pytest.raises(ValueError, match="checksum"):
                coder.decode(bytes(broken))


def test_token_files(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    token_files.write_tokens(docs(spark), path, tokens.default_path())
    at = 0
    back = {r.doc_id: (r.start, r.ids) for r in token_files.read_tokens(spark, path).collect()}
    for i, ids in encoded().items():
        assert back[i] == (at, ids)
        at += len(ids)
    token_files.write_tokens(docs(spark, []), f"file://{tmp_path}/e", tokens.default_path())
    assert token_files.read_tokens(spark, f"file://{tmp_path}/e").count() == 0


# -- personal data ------------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, m):
    d = [int(c) for c in m if c.isdigit()]
    luhn = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0
    return {"email": True, "ip": all(int(p) <= 255 for p in m.split(".")) if kind == "ip" else True, "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]


def base_spans(text):
    found = [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for k, kind in enumerate(PATTERNS) for m in re.finditer(PATTERNS[kind], text or "") if passes(kind, m.group())]
    return [s for _, _, s in sorted(found)]


def test_base_spans_against_plain_regex(spark):
    import random

    rng = random.Random(4)
    pieces = ["a@b.c", "@", ".", "x_y@d-e.f.g@h.i", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111111111111111", "4111-1111 1111 1111", "+1 (555) 123-4567", "+", "12", " ", "-", "é", "😀", "\n", "00000000000000000000", "0.0.0.0", "a.b"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(400)] + ODD
    model = pii.PiiModel([], [], {})
    got = pii.find_pii(docs(spark, texts).select("doc_id", "text"), model).select("doc_id", pii.joined(F.col("pii_spans")).alias("s")).collect()
    for r in got:
        assert r.s == ",".join(base_spans(texts[r.doc_id])), texts[r.doc_id]


def test_long_runs_are_found_whole(spark):
    texts = ["token = " + "a" * 201 + "1" + "b" * 30, "token = " + "7" * 300 + "x" * 30, "x" * 400, "write to " + "l" * 70 + " [at] host [dot] com now"]
    model = pii.PiiModel([], [], {})
    df = docs(spark, texts)
    rows = pii.with_candidates(df).select("doc_id", F.explode("__more").alias("c")).filter("c.kind IN ('secret', 'contact')").collect()
    assert {(r.doc_id, r.c.kind, r.c.start, r.c.end) for r in rows} == {(0, "secret", 8, 240), (1, "secret", 8, 338), (3, "contact", 9, 9 + 70 + 20)}
    clash = df.withColumn("__base", F.lit("mine")).withColumn("__email", F.lit(1)).withColumn("pii_base", F.lit(2))
    out = pii.find_pii(clash, model).filter("doc_id = 0").first()
    assert (out["__base"], out["__email"], out["pii_base"]) == ("mine", 1, [])


def test_training_and_redaction(spark):
    texts = ODD + [f'use token = "{hashlib.sha1(str(i).encode()).hexdigest()}" here' for i in range(30)] + [f"call +1 (555) 000-{1000 + i} or n{i}@mail.example.com" for i in range(30)] + [f"plain number {10**9 + i * 7919} in text" for i in range(30)]
    df = docs(spark, texts)
    model = pii.train(df)
    out = {r.doc_id: r for r in pii.redact(df, model).collect()}
    assert out[11].text == "mail me: [EMAIL] now" and out[12].text == "[CARD] and [IP]" and out[10].text == "[PHONE]"
    assert [out[i].text for i in range(10)] == ODD[:10] and out[11].spans == "clash" and out[11].n_chars == len(out[11].text)
    assert sum("[SECRET]" in (r.text or "") for r in out.values()) == 30
    assert not any("[" in out[i].text for i in range(len(texts) - 30, len(texts)))
    assert pii.redact(docs(spark, []), pii.train(docs(spark, []))).count() == 0


def test_rare_kinds_have_thresholds_on_tables_of_any_size(spark):
    rare = [f"write to person{i} [at] host{i} [dot] com please" for i in range(3)]
    for n in (40, 600):
        texts = rare + [f"call +1 (555) 000-{1000 + i} or n{i}@mail.example.com" for i in range(n)] + [f"plain number {10**9 + i * 7919} in text" for i in range(n)]
        model = pii.train(docs(spark, texts), sample=100)
        assert set(model.thresholds) == {"email", "phone", "number", "contact"} and model.thresholds["contact"] < 1
        out = {r.doc_id: r.text for r in pii.redact(docs(spark, texts), model).collect()}
        assert [out[i] for i in range(3)] == ["write to [CONTACT] please"] * 3 and out[len(texts) - 1] == texts[-1]
    assert pii.shares({"a": 2, "b": 50, "c": 9}, 30) == {"a": 2, "c": 9, "b": 19}
    assert pii.shares({"a": 5, "b": 5}, 1) == {"a": 0, "b": 1}


# -- decontamination ----------------------------------------------------------------------------------------


def brute_hits(texts, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for i, t in items:
        w = words(t)
        for j in range(max(len(w) - 10, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[j : j + 10]), set()).add(i)
    out = {}
    for d, t in enumerate(texts):
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit |= set(range(j, j + n))
                    found |= windows[tuple(w[j : j + n])]
        out[d] = (len(w), len(hit), sorted(found))
    return out


@pytest.mark.parametrize("block", [500_000, 12])
def test_decontamination(spark, block):
    import random

    rng = random.Random(5)
    pool = [f"w{i}" for i in range(12)] + ["é", "Ü9"]
    phrase = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    items = [(0, phrase(25)), (1, phrase(10)), (2, "w1 W2, w3"), (3, ""), (4, None), (5, "w1 w2 w3"), (6, phrase(11))]
    texts = ODD + [phrase(40) + "; " + (items[rng.randrange(7)][1] or "").upper() + " " + phrase(5) for _ in range(40)] + [items[0][1]] * 5
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.scan(docs(spark, texts), bench, block=block)
    n_hit = {r.doc_id: (r.n_words, sum(b - a for a, b in r.spans), list(r["items"])) for r in got.collect()}
    assert n_hit == brute_hits(texts, items)
    clean = decontaminate.remove_spans(docs(spark, texts), bench)
    rows = {r.doc_id: r for r in clean.collect()}
    assert all(rows[i].text == t for i, t in enumerate(texts) if not n_hit[i][1]) and len(texts) - 1 not in rows
    assert all(r.n_chars == len(r.text or "") and r.cuts == "clash" for r in rows.values())
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.scan(docs(spark, texts[:3]), empty).filter("size(spans) > 0").count() == 0
    assert decontaminate.scan(docs(spark, []), bench).count() == 0


@pytest.mark.parametrize("block", [500_000, 50])
def test_benchmark_of_many_blocks_and_odd_items(spark, block):
    import random

    rng = random.Random(11)
    pool = [f"W{i}" for i in range(40)] + ["é", "Ü9"]
    phrase = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    # ids that are null or shared, one item of many blocks
    items = [(None, "one TWO three four"), (None, "five six"), (2, phrase(150)), (3, phrase(12)), (3, phrase(14)), (4, phrase(10)), (5, None), (6, ";")]
    names = {t: i for i, t in items if t}
    texts = ["one two three four five six", items[2][1], None, "", phrase(30) + " " + items[3][1]] + [phrase(20) + ", " + rng.choice(list(names)) + "\n" + phrase(4) for _ in range(30)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.scan(docs(spark, texts), bench, block=block)
    brute = brute_hits(texts, [(-1 if i is None else i, t) for i, t in items])
    rows = {r.doc_id: (r.n_words, sum(b - a for a, b in r.spans), sorted(-1 if i is None else i for i in r["items"])) for r in got.collect()}
    assert rows == brute and rows[0][2] == [-1]
    assert all(i is not None or k == len(r["items"]) - 1 for r in got.collect() for k, i in enumerate(r["items"]))
    blocks, n = decontaminate.benchmark_blocks(bench, "item_id", "text", 10, block)
    sizes = {}
    for r in blocks.collect():
        sizes[r.block] = sizes.get(r.block, 0) + len(decontaminate.Phrases([(0, r.t)]))
    assert (n == 1) == (block > 1000) and max(sizes.values()) <= max(2 * block, 14) and len(sizes) <= n
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs(spark, texts), bench, block=block).collect()}
    assert cut == {r.doc_id: r.text for r in decontaminate.remove_spans(docs(spark, texts), bench).collect()}
    if block < 1000:
        repeated = docs(spark, texts[:6]).union(docs(spark, texts[:6]))
        assert decontaminate.scan(repeated, bench, block=block).count() == 12


@pytest.mark.parametrize("seed", range(3))
def test_fm_index(seed):
    rng = np.random.default_rng(seed)
    s = rng.integers(0, 4, 200)
    index = decontaminate.FmIndex(s, 4)
    assert decontaminate.suffix_array(s).tolist() == sorted(range(200), key=lambda i: s[i:].tolist())
    phrases = np.stack([s[i : i + 3] for i in range(0, 190, 5)])
    lo, hi = index.search(phrases, np.full(len(phrases), 3))
    for p, a, b in zip(phrases, lo, hi, strict=True):
        assert sorted(index.locate(np.arange(a, b)).tolist()) == [i for i in range(198) if (s[i : i + 3] == p).all()]


# -- quality ------------------------------------------------------------------------------------------------


def test_quality_learns_and_handles_odd_texts(spark):
    import random

    rng = random.Random(6)
    good = [" ".join(rng.choice(("the", "cat", "sat", "on", "a", "mat")) for _ in range(30)) + "." for _ in range(120)]
    bad = [" ".join(rng.choice(("BUY", "NOW", "$$$", "%%%")) + "!!" for _ in range(30)) for _ in range(120)]
    texts = ODD + good + bad
    labels = spark.createDataFrame([(i + len(ODD), int(i < 120)) for i in range(240)], "doc_id long, quality int")
    df = docs(spark, texts)
    rows = quality.quality_scores(df, labels).collect()
    score = {r.doc_id: r.score for r in rows}
    assert len(rows) == len(texts) and all(0 <= v <= 1 for v in score.values())
    held = [i for i in range(len(ODD), len(texts)) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((score[i] >= 0.5) == (i < len(ODD) + 120) for i in held) and len(held) > 20
    kept = {r.doc_id for r in quality.keep_good(df, labels).collect()}
    assert kept == {i for i, v in score.items() if v >= quality.THRESHOLD}
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.quality_scores(df, none).collect()} == {0.5}
    assert quality.quality_scores(docs(spark, []), labels).count() == 0


# -- licences, sharding, media ------------------------------------------------------------------------------


def test_licenses(spark):
    mit = next(t for n, t in licenses.KNOWN if n == "MIT" and len(t) > 500)
    whole = "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace("SUBLICENSE", "sub-licence").replace(",", " ,")
    texts = [whole, "intro\nLICENSED under the Apache licence, version 2.0\nmore", None, "", "no licence here", mit + " extra"]
    rows = {r.doc_id: r for r in licenses.scan_licenses(docs(spark, texts), licenses.known_digests(spark)).collect()}
    assert rows[0].text_license == "MIT" and rows[1].licenses == "Apache-2.0" and rows[1].n_notices == 1
    assert all(rows[i].licenses == "" and rows[i].text_license is None for i in (2, 3, 4, 5))
    assert licenses.scan_licenses(docs(spark, []), licenses.known_digests(spark)).count() == 0


def test_license_lists_of_any_kind(spark, monkeypatch):
    mine = licenses.known_digests(spark, (("X", "All rights reserved."), ("Y", "Second text\nof two lines")), ())
    texts = ["intro\nALL rights reserved\nend", "second  text, of two lines!", "all rights reserved", None, "x" * 200_000, "intro\nALL rights reserved\nend"]
    df = docs(spark, texts).withColumnRenamed("doc_id", "license").withColumn("digest", F.lit(1)).withColumn("__lines", F.lit(2))
    want = {(0, None, 1, "X"), (1, "Y", 1, "Y"), (2, "X", 1, "X"), (3, None, 0, ""), (4, None, 0, ""), (5, None, 1, "X")}
    for most in (licenses.LIST, 1):  # broadcast, and by shuffles
        monkeypatch.setattr(licenses, "LIST", most)
        assert {tuple(r) for r in licenses.scan_licenses(df, mine, "license").collect()} == want


def test_long_licenses_are_known_by_digest(spark):
    from pathlib import Path

    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    found = {k: (folder / k).read_text() for k in names if (folder / k).is_file()}
    if not found:
        pytest.skip("no licence texts here")
    whole = list(found.values())
    other = [t.upper().replace(" ", "  ").replace(",", " ,") for t in whole]
    cut = [t[: t.index("END OF TERMS AND CONDITIONS") + 27] for k, t in found.items() if k in ("Apache-2.0", "GPL-2", "GPL-3")]
    less = [t[:-200] for t in whole]
    rows = {r.doc_id: r.text_license for r in licenses.scan_licenses(docs(spark, whole + other + cut + less), licenses.known_digests(spark)).collect()}
    want = [names[k] for k in found]
    n = len(want)
    assert [rows[i] for i in range(2 * n)] == want * 2 and [rows[2 * n + i] for i in range(len(cut))] == [names[k] for k in found if k in ("Apache-2.0", "GPL-2", "GPL-3")]
    assert all(rows[2 * n + len(cut) + i] is None for i in range(n))


def test_every_known_license(spark):
    """One altered copy of each known text is found under its name."""
    texts = ["(c) 1999 Nobody\n" + t.upper().replace(".", " . ").replace("LICENSE", "LICENCE") for _, t in licenses.KNOWN]
    rows = {r.doc_id: r.text_license for r in licenses.scan_licenses(docs(spark, texts), licenses.known_digests(spark)).collect()}
    assert [rows[i] for i in range(len(texts))] == [n for n, _ in licenses.KNOWN]


def test_sharding(spark):
    df = docs(spark, ODD * 7).withColumn("size", F.length(F.coalesce("text", F.lit(""))) + 1)
    rows = sharding.hilbert_shards(df, sharding.document_dims(df)).collect()
    n = len(ODD) * 7
    assert sorted(r.position for r in rows) == list(range(n))
    counts = {}
    for r in sorted(rows, key=lambda r: r.position):
        assert r.slot == counts.get(r.shard, 0)
        counts[r.shard] = r.slot + 1
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    cells = [r.cell for r in sorted(rows, key=lambda r: r.position)]
    assert cells == sorted(cells)
    assert sharding.hilbert_shards(df.limit(0), sharding.document_dims(df.limit(0))).count() == 0


def test_cuts_follow_the_rows(spark):
    df = spark.createDataFrame([(x,) for x in ["hot"] * 60 + [f"s{i:02d}" for i in range(40)] + [None] * 3], "source string")
    cuts = sharding.quantile_cuts(df, "source")
    assert cuts == sorted(cuts) and len(cuts) <= 15 and cuts[0] > "hot"
    codes = {r.source: r.c for r in df.select("source", sharding.code_of(F.col("source"), cuts).alias("c")).collect()}
    assert codes[None] == 0 and codes["hot"] == 0 and [codes[f"s{i:02d}"] for i in range(40)] == sorted(codes[f"s{i:02d}"] for i in range(40))
    assert max(list(codes.values()).count(c) for c in set(codes.values()) - {0}) <= 8
    assert sharding.quantile_cuts(df.limit(0), "source") == [] and sharding.quantile_cuts(df.filter("source IS NULL"), "source") == []


def test_shards_are_written_and_skipped(spark, tmp_path):
    import random

    rng = random.Random(3)
    rows = [(i, rng.choice(["hot"] * 5 + [f"s{k}" for k in range(9)] + [None]), rng.choice(["en", "en", "de", "fr"]), 2 ** rng.randrange(12) + rng.randrange(9), f"t{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, size long, text string")
    keep = ("doc_id", "source", "lang", "size", "text")
    path = f"file://{tmp_path}/shards"
    sharding.write_shards(sharding.hilbert_shards(df, sharding.document_dims(df), 64, keep=keep), path)
    everything = sharding.read_shards(spark, path)
    assert {tuple(r[c] for c in keep) for r in everything.collect()} == set(rows)
    skipped = []
    for wanted in ({"source": ("s1", "s2")}, {"size": (1, 4)}, {"lang": ("fr", "fr"), "size": (500, 9999)}, {"source": ("s8", "s8"), "lang": ("de", "de"), "size": (1, 40)}, {"source": ("x", "z")}):
        found = sharding.read_shards(spark, path, **wanted)
        at = dict(zip(keep, range(5), strict=True))
        assert {r.doc_id for r in found.collect()} == {r[0] for r in rows if all(r[at[c]] is not None and a <= r[at[c]] <= b for c, (a, b) in wanted.items())}
        skipped.append(64 - len(sharding.shards_left(spark, path, **wanted)))
        scan = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x]
        assert all("shard" in x.split("PartitionFilters")[1].split("]")[0] for x in scan)
    assert skipped[-1] == 64 and min(skipped) > 0 and skipped[3] > 32, skipped
    # slots of the shards on disk
    per = {}
    for r in everything.collect():
        per.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in per.values())


def test_op9_by_its_contract(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = sharding.op9_hilbert_shards(spark, sf_dir).collect()
    data = lambda t: (t or "").encode()
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in rows) == sorted((d.doc_id, len(data(d.text)) + 1, zlib.crc32(data(d.text))) for d in table)
    per = {}
    for r in rows:
        per.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 16
    assert all(sorted(v) == list(range(len(v))) for v in per.values()) and max(map(len, per.values())) - min(map(len, per.values())) <= 1


def test_hilbert_curve_is_continuous(spark):
    cells = spark.range(512).select(*[(F.shiftright("id", 3 * i) % 8).cast("int").alias(c) for i, c in enumerate("xyz")])
    rows = sorted(tuple(r) for r in cells.select(sharding.hilbert_index(F.col("x"), F.col("y"), F.col("z"), 3).alias("h"), "x", "y", "z").collect())
    assert [r[0] for r in rows] == list(range(512))
    assert all(sum(abs(a - b) for a, b in zip(p[1:], q[1:], strict=True)) == 1 for p, q in zip(rows, rows[1:], strict=False))


def test_media(spark):
    features = {r.digest: r for r in media.read_features(media.store_texts(docs(spark))).collect()}
    for t in ODD:
        raw = (t or "").encode()
        r = features[hashlib.sha256(raw).hexdigest()]
        payload = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    page = f'<html><head><title>t</title></head><body>one <b>two</b><figure><img src="sha256:{hashlib.sha256(b"x").hexdigest()}" alt="A"><img src="http://e/x.png"><figcaption>cap <i>tion</i></figcaption></figure><script>no()</script>three</body></html>'
    pages = spark.createDataFrame([(1, page, "clash"), (2, None, ""), (3, "<p>broken <img", "")], "page_id long, html string, kind string")
    rows = media.resolve(media.sequences(pages), media.read_features(media.store_texts(docs(spark)))).orderBy("page_id", "position").collect()
    assert [(r.page_id, r.position, r.kind, r.text or r.source[:6], r.caption) for r in rows][:4] == [(1, 0, "text", "one two", None), (1, 1, "media", "sha256", "cap tion"), (1, 2, "media", "http:/", "cap tion"), (1, 3, "text", "three", None)]
    assert rows[1].n_bytes == 1 and rows[2].n_bytes is None and not any(r.page_id == 2 for r in rows)
    assert media.sequences(pages.limit(0)).count() == 0


def kinds_of(html):
    return [(x["kind"], x.get("text") or x.get("source"), x.get("caption")) for x in media.elements(html)]


def test_pages_with_missing_end_tags_lose_nothing():
    assert kinds_of("<html><head><title>t</title><p>one<p>two") == [("text", "one", None), ("text", "two", None)]
    assert kinds_of("<head><meta charset=u>bare text") == [("text", "bare text", None)]
    assert kinds_of("a<template>b") == [("text", "a", None), ("text", "b", None)]
    assert kinds_of("a<template>gone <img src=x></template>b") == [("text", "a", None), ("text", "b", None)]
    assert kinds_of("<figure><figcaption>cap</figcaption><img src=x></figure>z") == [("media", "x", "cap"), ("text", "z", None)]
    assert kinds_of("<figure><img src=x><figcaption>cap") == [("media", "x", "cap")]
    assert kinds_of("<figure><figcaption>alone</figcaption></figure>z") == [("text", "alone", None), ("text", "z", None)]
    assert kinds_of("<figcaption>orphan</figcaption>z") == [("text", "orphan", None), ("text", "z", None)]
    nested = "<figure><img src=a><figure><img src=b><figcaption>in</figcaption></figure><figcaption>out</figcaption></figure>"
    assert kinds_of(nested) == [("media", "a", "out"), ("media", "b", "in")]


def test_media_query_against_brute_force(spark, tmp_path):
    df = docs(spark, ODD + ["one\n<b>two</b> & three\n\nfour", None]).union(docs(spark, ["same id"])).select("doc_id", "text", "lang")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted(media.op10_interleaved_media(spark, str(tmp_path)).collect(), key=str)
    want = []
    for r in df.collect():
        raw = (r.text or "").encode()
        tiles = max(1, -(-len(raw) // 576))
        payload = raw + b"\xff" * (576 * tiles - len(raw))
        stored = b"P5\n24 %d\n255\n" % (24 * tiles) + payload
        image = np.frombuffer(payload, np.uint8).astype(int).reshape(-1, 24)
        n = image.size
        parts = (1000 * int(image.sum()) // n, 1000 * int((image**2).sum()) // n - 1000 * int(image.sum()) ** 2 // n**2, 1000 * int(np.abs(np.diff(image, axis=1)).sum()) // n)
        hist = ",".join(str(int(((image >= 32 * i) & (image < 32 * (i + 1))).sum())) for i in range(8))
        feature = f"24x{24 * tiles};mean={parts[0]};var={parts[1]};step={parts[2]};hist={hist}"
        first = (r.text or "").split("\n")[0].split()
        want.append((r.doc_id, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), feature, int(bool(first)), r.lang or None))
    assert [tuple(r) for r in rows] == sorted((spark.createDataFrame([w], media_schema()).first() for w in want), key=str)


def media_schema():
    return "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, position int, caption string"


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline
    from labelloom.session import written

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = documents.count()
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, documents, sf_dir), name)
        if name != "packing":
            assert out.columns == documents.columns and 0 < out.count() <= n
            documents, n = out, out.count()
    assert out.select("doc_id").distinct().count() == n
    assert json.dumps([name for name, _ in corpus_pipeline.STAGES]) == '["quality", "near_dedup", "decontamination", "pii", "packing"]'
