"""Chat formatting with linked tool calls.

Calls and results are hash-joined by conversation and identifier, calls are levelled topologically by the
identifiers they depend on, arguments are checked against the tools' schemas, and every message is serialised
as canonical JSON (keys sorted, no spaces, UTF-8 as is). The result has a row per message; (level, turn, kind)
is its order inside the conversation, so a conversation is never gathered into one row or task.

Statuses: ``linked``, ``no_result`` (call without result), ``no_call`` (result without call), ``repeated``
(a later call or result of an identifier that has one), ``cycle`` (a call that waits for itself), ``message``
(a turn that is neither call nor result; it stands at the highest level of the calls before its turn).

Cases: identical repeated rows count as one; a null identifier links with nothing; null or broken arguments
(NaN, infinities and nesting beyond the parser's depth among them) are invalid (``not an object``) and stay as the
text they are; lone surrogates are written as escapes; a tool without schema is invalid (``unknown tool``); a dependency that does
not exist is ignored for the order and reported in ``missing``; empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelloom.session import checkpointed, small_batches, table, written

#: JSON types a schema may ask for.
TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list}
SURROGATE = re.compile("[\ud800-\udfff]")
KEY = ["conv_id", "call_id"]
#: Turns that one window sorts; over longer conversations, windows go over the blocks of so many turns.
BLOCK = 1024


def canonical(value: object) -> str:
    """Canonical JSON, with lone surrogates (which UTF-8 has not) as escapes."""
    out = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", out)


def finite(text: str) -> float:
    x = float(text)
    if x - x:  # infinite
        raise ValueError(text)
    return x


def no_constant(text: str) -> None:
    raise ValueError(text)


def parsed(text: str | None) -> object:
    """The value of a JSON text; None if it is none (NaN, infinities and nesting beyond the parser's depth included)."""
    if text is None:
        return None
    try:
        value = json.loads(text, parse_float=finite, parse_constant=no_constant)
        canonical(value)
        return value
    except (ValueError, RecursionError):
        return None


def violations(arguments: str | None, schema: dict | None) -> tuple[object, str | None]:
    """(parsed arguments or None, first violation or None) of a schema {field: (type, required)}."""
    value = parsed(arguments)
    if not isinstance(value, dict):
        return None, "not an object"
    if schema is None:
        return value, "unknown tool"
    for field in sorted(schema):
        kind, required = schema[field]
        if field not in value:
            if required:
                return value, f"missing {field}"
            continue
        x = value[field]
        if not isinstance(x, TYPES[kind]) or (isinstance(x, bool) and kind in ("integer", "number")):
            return value, f"{field} is not {kind}"
    extra = sorted(set(value) - set(schema))
    return value, SURROGATE.sub("\ufffd", f"unexpected {extra[0]}") if extra else None


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): 0 without known dependencies, else one more than the highest of them.

    Chains (calls with one dependency) are halved every round by pointer doubling, so a conversation of
    thousands of calls in a row takes a dozen rounds; what is left, calls with several dependencies, is settled
    one such step a round. Calls on or behind a cycle get no row.
    """
    nodes = calls.select(*KEY).distinct()
    wants = calls.select(*KEY, F.explode("depends_on").alias("parent")).distinct()
    wants = checkpointed(wants.join(nodes.withColumnRenamed("call_id", "parent"), ["conv_id", "parent"], "left_semi"))
    parents = wants.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("parent"))
    chain = checkpointed(parents.filter("n = 1").select(*KEY, F.col("parent").alias("top"), F.lit(1).alias("up")))
    # tops that are themselves in a chain still move; when their number stays the same they are on a cycle
    before = -1
    while True:
        step = chain.select("conv_id", F.col("call_id").alias("top"), F.col("top").alias("next"), F.col("up").alias("more"))
        chain = checkpointed(chain.join(step, ["conv_id", "top"], "left").select(*KEY, F.coalesce("next", "top").alias("top"), (F.col("up") + F.coalesce("more", F.lit(0))).alias("up"), F.col("next").isNotNull().alias("moved")))
        now = chain.filter("moved").count()
        chain = chain.drop("moved")
        if now == 0 or now == before:
            break
        before = now
    roots = nodes.join(wants.select(*KEY).distinct(), KEY, "left_anti").withColumn("level", F.lit(0))
    settled = checkpointed(roots)
    several = parents.filter("n > 1").select(*KEY)
    edges = wants.join(several, KEY, "left_semi").join(chain.select("conv_id", F.col("call_id").alias("parent"), "top", "up"), ["conv_id", "parent"], "left")
    edges = checkpointed(edges.select(*KEY, F.coalesce("top", "parent").alias("top"), (F.coalesce("up", F.lit(0)) + 1).alias("up")))
    while not edges.isEmpty():
        known = settled.select("conv_id", F.col("call_id").alias("top"), "level")
        state = edges.join(known, ["conv_id", "top"], "left").groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.count("level").alias("k"), F.max(F.col("level") + F.col("up")).alias("level"))
        fresh = checkpointed(state.filter("n = k").select(*KEY, F.col("level").cast("int").alias("level")))
        if fresh.isEmpty():
            break
        settled = checkpointed(settled.union(fresh))
        edges = checkpointed(edges.join(fresh, KEY, "left_anti"))
    tops = settled.select("conv_id", F.col("call_id").alias("top"), "level")
    hung = chain.join(tops, ["conv_id", "top"]).select(*KEY, (F.col("level") + F.col("up")).cast("int").alias("level"))
    return settled.union(hung)


def levels_before(marks: DataFrame, places: DataFrame) -> DataFrame:
    """(conv_id, turn, level) of the turns in ``places``: the highest level in ``marks`` at an earlier turn of the
    conversation, 0 without any. A window holds at most BLOCK turns, or a row for each block of a conversation."""
    points = places.select("conv_id", "turn", F.lit(None).cast("int").alias("level"), F.lit(True).alias("place")).union(marks.select("conv_id", "turn", "level", F.lit(False)))
    points = points.groupBy("conv_id", "turn").agg(F.max("level").alias("level"), F.max("place").alias("place"), F.floor(F.col("turn") / BLOCK).alias("block"))
    earlier = lambda keys, order: W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    near = points.withColumn("near", F.max("level").over(earlier(["conv_id", "block"], "turn"))).filter("place")
    tops = points.groupBy("conv_id", "block").agg(F.max("level").alias("top"))
    tops = tops.select("conv_id", "block", F.max("top").over(earlier(["conv_id"], "block")).alias("far"))
    return near.join(tops, ["conv_id", "block"]).select("conv_id", "turn", F.coalesce(F.greatest("near", "far"), F.lit(0)).alias("level"))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], others: DataFrame | None = None) -> DataFrame:
    """Messages of tool calls, and the plain messages ``others`` of the same conversations.

    calls: conv_id, turn, call_id, name, arguments (JSON), depends_on (array of ids). results: conv_id, turn,
    call_id, content. schemas: tool -> {field: (type, required)}; a list of tools, not a table of the corpus.
    others: conv_id, turn, role, content; roles may be null or any, and are written as they are.
    Returns conv_id, turn, kind, call_id, status, level, valid, error, missing, json.

    Calls and results are rows of one table, so that one shuffle by identifier finds the first call and result
    of each, and one hash join brings them, with the level, to every row.
    """
    small_batches(calls.sparkSession)
    null = lambda kind: F.lit(None).cast(kind)
    calls = calls.select("conv_id", F.col("turn").cast("long").alias("turn"), F.lit("call").alias("kind"), "call_id", "name", "arguments", F.coalesce("depends_on", F.array().cast("array<string>")).alias("depends_on"), null("string").alias("content"))
    results = results.select("conv_id", F.col("turn").cast("long").alias("turn"), F.lit("result").alias("kind"), "call_id", null("string").alias("name"), null("string").alias("arguments"), null("array<string>").alias("depends_on"), "content")
    rows = written(calls.union(results).distinct(), "messages")
    # a row's place among those of its identifier: its turn, then the hash of what it says
    own = F.struct("turn", F.xxhash64("name", "arguments", "depends_on", "content").alias("said"))
    is_call = F.col("kind") == "call"
    level = levels(rows.filter(is_call & F.col("call_id").isNotNull()))
    firsts = rows.groupBy(*KEY).agg(F.min(F.when(is_call, own)).alias("c"), F.min_by("name", F.when(is_call, own)).alias("tool"), F.min(F.when(~is_call, own)).alias("r")).join(level, KEY, "left")
    known = rows.filter(is_call).select("conv_id", F.col("call_id").alias("parent"))
    lost = rows.filter(is_call).select("conv_id", "turn", "call_id", F.explode("depends_on").alias("parent")).join(known, ["conv_id", "parent"], "left_anti")
    lost = lost.groupBy("conv_id", "turn", "call_id").agg(F.array_join(F.array_sort(F.collect_set("parent")), ",").alias("missing"))
    every = rows.join(firsts, KEY, "left").join(lost, ["conv_id", "turn", "call_id"], "left")
    status: Column = (
        F.when(F.col("call_id").isNull(), F.when(is_call, "no_result").otherwise("no_call"))
        .when(~is_call & F.col("c").isNull(), "no_call")
        .when(~own.eqNullSafe(F.when(is_call, F.col("c")).otherwise(F.col("r"))), "repeated")
        .when(F.col("level").isNull(), "cycle")
        .when(is_call & F.col("r").isNull(), "no_result")
        .otherwise("linked")
    )
    every = every.select("conv_id", "turn", "kind", "call_id", status.alias("status"), "level", F.when(is_call, F.col("missing")).alias("missing"), F.coalesce("name", "tool").alias("name"), "arguments", "content", null("string").alias("role"))
    if others is not None:
        others = others.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "content").distinct()
        marks = firsts.filter("level IS NOT NULL").select("conv_id", "c.turn", "level")
        plain = others.join(levels_before(marks, others), ["conv_id", "turn"], "left")
        plain = plain.select("conv_id", "turn", F.lit("message").alias("kind"), null("string").alias("call_id"), F.lit("message").alias("status"), F.coalesce("level", F.lit(0)).alias("level"), null("string").alias("missing"), null("string").alias("name"), null("string").alias("arguments"), "content", "role")
        every = every.union(plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            valid, errors, texts = [], [], []
            for kind, call_id, name, arguments, content, role in zip(*(b.column(k).to_pylist() for k in ("kind", "call_id", "name", "arguments", "content", "role")), strict=True):
                error = None
                if kind == "call":
                    value, error = violations(arguments, schemas.get(name))
                    shown = {"name": name, "arguments": arguments if value is None else value}
                    message = {"role": "assistant", "tool_calls": [{"id": call_id, "type": "function", "function": shown}]}
                elif kind == "message":
                    message = {"role": role, "content": content}
                else:
                    message = {"role": "tool", "tool_call_id": call_id, "name": name, "content": content}
                valid.append(error is None)
                errors.append(error)
                texts.append(canonical(message))
            kept = [b.column(k) for k in ("conv_id", "turn", "kind", "call_id", "status", "level", "missing")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(valid, pa.bool_()), pa.array(errors, pa.string()), pa.array(texts, pa.string())], names=["conv_id", "turn", "kind", "call_id", "status", "level", "missing", "valid", "error", "json"])

    conv = rows.schema["conv_id"].dataType.simpleString()
    return every.mapInArrow(run, f"conv_id {conv}, turn long, kind string, call_id string, status string, level int, missing string, valid boolean, error string, json string")


#: The tool that stands for an assistant's turn in the registered query.
REPLY = {"reply": {"prompt": ("string", True), "turn": ("integer", True), "length": ("integer", False)}}


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as tool use: a user's turn calls ``reply``, the assistant's next turn is its result, and a
    call depends on the call two turns before, that of turn 4 or 5 on the one four turns before too."""
    name = lambda back: F.concat(F.lit("call_"), (F.col("turn") - back).cast("string"))
    asked = conversations.filter(F.col("role") == "user")
    # a null text leaves the prompt out, which the schema refuses
    arguments = F.to_json(F.struct(F.col("text").alias("prompt"), F.col("turn").alias("turn"), F.length("text").alias("length")))
    depends = F.array_compact(F.array(F.when(F.col("turn") >= 2, name(2)), F.when(F.col("turn").isin(4, 5), name(4))))
    calls = asked.select("conv_id", "turn", name(0).alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"), depends.alias("depends_on"))
    results = conversations.filter(F.col("role") == "assistant").select("conv_id", "turn", name(1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def plain_turns(conversations: DataFrame) -> DataFrame:
    """The turns of every other role, null and unknown ones included."""
    dealt = F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False))
    return conversations.filter(~dealt).select("conv_id", "turn", "role", F.col("text").alias("content"))


def op5_tool_call_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    calls, results = turns_as_calls(conversations)
    return link(calls, results, REPLY, plain_turns(conversations))


QUERIES = {"op5_tool_call_chat": op5_tool_call_chat}
ORACLE = {
    "op5_tool_call_chat": """
WITH RECURSIVE rows AS (SELECT DISTINCT conv_id, CAST(turn AS BIGINT) AS turn, role, text FROM conversations),
calls AS (SELECT conv_id, turn, text, concat('call_', turn) AS call_id FROM rows WHERE role = 'user'),
wants AS (SELECT c.conv_id, c.turn, c.turn - b AS parent FROM calls c, (VALUES (2), (4)) v(b) WHERE c.turn >= b AND (b = 2 OR c.turn IN (4, 5))),
known AS (SELECT w.* FROM wants w JOIN calls p ON p.conv_id = w.conv_id AND p.turn = w.parent),
lost AS (SELECT w.conv_id, w.turn, string_agg(concat('call_', parent), ',' ORDER BY concat('call_', parent)) AS missing FROM wants w
  WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = w.conv_id AND p.turn = w.parent) GROUP BY 1, 2),
paths AS (SELECT conv_id, turn, 0 AS level FROM calls UNION SELECT k.conv_id, k.turn, p.level + 1 FROM paths p JOIN known k ON k.conv_id = p.conv_id AND k.parent = p.turn),
levels AS (SELECT conv_id, turn, max(level) AS level FROM paths GROUP BY 1, 2),
answers AS (SELECT conv_id, turn, concat('call_', turn - 1) AS call_id, text FROM rows WHERE role = 'assistant'),
others AS (SELECT conv_id, turn, role, text FROM rows WHERE role IS NULL OR role NOT IN ('user', 'assistant'))
SELECT c.conv_id, c.turn, 'call' AS kind, c.call_id, CASE WHEN a.turn IS NULL THEN 'no_result' ELSE 'linked' END AS status, l.level, o.missing,
  c.text IS NOT NULL AS valid, CASE WHEN c.text IS NULL THEN 'missing prompt' END AS error,
  concat('{"role":"assistant","tool_calls":[{"function":{"arguments":{', CASE WHEN c.text IS NOT NULL THEN concat('"length":', length(c.text), ',"prompt":', to_json(c.text), ',') END, '"turn":', c.turn, '},"name":"reply"},"id":"', c.call_id, '","type":"function"}]}') AS json
FROM calls c JOIN levels l ON l.conv_id = c.conv_id AND l.turn = c.turn LEFT JOIN answers a ON a.conv_id = c.conv_id AND a.call_id = c.call_id LEFT JOIN lost o ON o.conv_id = c.conv_id AND o.turn = c.turn
UNION ALL SELECT a.conv_id, a.turn, 'result', a.call_id, CASE WHEN c.turn IS NULL THEN 'no_call' ELSE 'linked' END, l.level, NULL, TRUE, NULL,
  concat('{"content":', coalesce(to_json(a.text), 'null'), ',"name":', CASE WHEN c.turn IS NULL THEN 'null' ELSE '"reply"' END, ',"role":"tool","tool_call_id":"', a.call_id, '"}')
FROM answers a LEFT JOIN calls c ON c.conv_id = a.conv_id AND c.call_id = a.call_id LEFT JOIN levels l ON l.conv_id = c.conv_id AND l.turn = c.turn
UNION ALL SELECT o.conv_id, o.turn, 'message', NULL, 'message', coalesce((SELECT max(level) FROM levels l WHERE l.conv_id = o.conv_id AND l.turn < o.turn), 0), NULL, TRUE, NULL,
  concat('{"content":', coalesce(to_json(o.text), 'null'), ',"role":', coalesce(to_json(o.role), 'null'), '}') FROM others o""",
}
