import json
import random

import pytest
from labelloom.llm import chat

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id long, turn long, call_id string, content string"
TOOLS = {"add": {"a": ("integer", True), "b": ("number", False)}}


def linked(spark, calls, results):
    return chat.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), TOOLS).collect()


def naive_levels(edges, nodes):
    level = {}

    def walk(n, path):
        if n in path:
            return None
        if n not in level:
            up = [walk(p, path | {n}) for p in edges.get(n, ()) if p in nodes]
            level[n] = None if None in up else max(up, default=-1) + 1
        return level[n]

    for n in nodes:
        walk(n, frozenset())
    return {n: v for n, v in level.items() if v is not None}


@pytest.mark.parametrize("seed", range(2))
def test_levels_against_naive(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{i}" for i in range(40)]
    edges = {f"n{i}": [f"n{rng.randrange(i)}" for _ in range(rng.choice((0, 1, 1, 1, 3)))] if i else [] for i in range(40)}
    rows = [(1, i, n, "add", "{}", edges[n]) for i, n in enumerate(nodes)]
    rows += [(2, i, f"c{i}", "add", "{}", [f"c{i - 1}"] if i else []) for i in range(70)]  # one long chain
    rows += [(3, 0, "x", "add", "{}", ["y"]), (3, 1, "y", "add", "{}", ["x"]), (3, 2, "z", "add", "{}", ["y"]), (3, 3, "w", "add", "{}", ["gone"])]
    got = {(r.conv_id, r.call_id): r.level for r in chat.levels(spark.createDataFrame(rows, CALLS)).collect()}
    want = {(1, n): v for n, v in naive_levels(edges, nodes).items()} | {(2, f"c{i}"): i for i in range(70)} | {(3, "w"): 0}
    assert got == want


def test_statuses_and_validation(spark):
    calls = [
        (1, 0, "a", "add", '{"b": 1.5, "a": 1}', []),
        (1, 0, "a", "add", '{"b": 1.5, "a": 1}', []),  # the same row again
        (1, 2, "a", "add", '{"a": 2}', None),
        (1, 3, "b", "add", '{"a": true}', ["a", "lost"]),
        (1, 4, "c", "drop", "{}", []),
        (1, 5, "d", "add", None, []),
        (1, 6, None, "add", '{"a": 1, "z": 0}', []),
        (1, 7, "e", "add", "not json", ["e"]),
    ]
    results = [(1, 1, "a", "3"), (1, 8, "a", "late"), (1, 9, "nobody", "?"), (1, 10, None, "?")]
    rows = {(r.kind, r.call_id, r.turn): r for r in linked(spark, calls, results)}
    assert len(rows) == len(calls) - 1 + len(results)
    status = {k: r.status for k, r in rows.items()}
    assert status["call", "a", 0] == "linked" and status["call", "a", 2] == "repeated" and status["call", "b", 3] == "no_result"
    assert status["result", "a", 1] == "linked" and status["result", "a", 8] == "repeated"
    assert status["result", "nobody", 9] == status["result", None, 10] == "no_call" and status["call", "e", 7] == "cycle"
    assert rows["call", "b", 3].missing == "lost" and rows["call", "b", 3].level == 1
    errors = {k[1:]: r.error for k, r in rows.items() if k[0] == "call"}
    assert errors == {("a", 0): None, ("a", 2): None, ("b", 3): "a is not integer", ("c", 4): "unknown tool", ("d", 5): "not an object", (None, 6): "unexpected z", ("e", 7): "not an object"}
    assert rows["call", "a", 0].json == '{"role":"assistant","tool_calls":[{"function":{"arguments":{"a":1,"b":1.5},"name":"add"},"id":"a","type":"function"}]}'
    assert json.loads(rows["result", "a", 1].json) == {"role": "tool", "tool_call_id": "a", "name": "add", "content": "3"}


def test_empty(spark):
    assert linked(spark, [], []) == []


def test_odd_arguments(spark):
    deep = '{"a": ' + "[" * 100_000 + "]" * 100_000 + "}"
    texts = [deep, '{"a": NaN}', '{"a": 1, "b": 1e999}', '{"a": 1, "\\ud800": 2}', '{"a": 1, "b": -Infinity}', '{"a": 1}', "9" * 10_000]
    calls = [(1, i, f"c{i}", "add", t, []) for i, t in enumerate(texts)]
    calls.append((1, 50, "long", "add", '{"a": 5, "b": 1, "x": "' + "y" * 500_000 + '"}', []))
    rows = {r.call_id: r for r in linked(spark, calls, [(1, 60, "c5", None)])}
    assert [rows[f"c{i}"].error for i in range(7)] == ["not an object"] * 3 + ["unexpected \ufffd", "not an object", None, "not an object"]
    for r in rows.values():
        json.loads(r.json, parse_constant=lambda x: pytest.fail(x))
    assert "\\ud800" in rows["c3"].json and len(rows["long"].json) > 500_000 and rows["long"].error == "unexpected x"


def test_clashing_columns(spark):
    calls = spark.createDataFrame([(1, 0, "a", "add", '{"a": 1}', [], "x", 5)], CALLS + ", status string, level int")
    results = spark.createDataFrame([(1, 1, "a", "3", "y")], RESULTS + ", kind string")
    assert sorted((r.kind, r.status, r.level) for r in chat.link(calls, results, TOOLS).collect()) == [("call", "linked", 0), ("result", "linked", 0)]


def test_query_returns_every_row_of_conversations(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").distinct()
    out = chat.op5_tool_call_chat(spark, sf_dir)
    assert out.count() == table.count()
    said = [json.loads(r.json) for r in out.filter("kind = 'message'").collect()]
    want = [(r.role, r.text) for r in table.filter("role IS NULL OR role NOT IN ('user', 'assistant')").collect()]
    assert sorted((m["role"], m["content"]) for m in said) == sorted(want) and want


def test_other_roles_stay_in_place(spark, tmp_path):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, None, "note"), (1, 4, "narrator", None), (1, 5, "user", "c"), (1, 6, "assistant", "d"), (1, 7, "system", "end"), (2, 0, "system", "alone"), (2, 0, "system", "alone")]
    rows += [(3, i, "user", "x") for i in range(0, 3000, 2)] + [(3, 2501, "system", "far"), (3, 2047, "system", "edge")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    out = chat.op5_tool_call_chat(spark, str(tmp_path)).collect()
    assert len(out) == len(set(rows))
    first = sorted((r for r in out if r.conv_id == 1), key=lambda r: (r.level, r.turn, r.kind))
    assert [r.turn for r in first] == list(range(8))
    plain = {(r.conv_id, r.turn): r for r in out if r.kind == "message"}
    assert all(r.call_id is None and r.status == "message" and r.valid and r.error is None for r in plain.values())
    assert plain[1, 3].json == '{"content":"note","role":null}' and plain[1, 4].json == '{"content":null,"role":"narrator"}'
    assert (plain[2, 0].level, plain[3, 2501].level, plain[3, 2047].level) == (0, 1250, 1023)
