"""Operator 5: chat formatting with tool calls (DataFrame functions only).

Calls and results are brought together by a hash join on the call's identifier, ordered so that every
call follows the calls it depends on, validated against the schemas of their tools, and serialised as
canonical JSON (sorted keys, no white space).

Identifiers are unique in a conversation only: everything is keyed by conversation and identifier.

Order: a call's ``level`` counts the dependencies that point forward in the conversation on the way
to it (the most of any way); sorting by ``level`` and position is a topological order.  Where all dependencies point
backward (the usual case) every level is 0 and nothing is iterated.  In conversations with forward dependencies
calls whose dependencies are known are resolved round by round, and a dependency on a call that itself waits
for one call only jumps to that one, so that a chain takes a number of rounds that grows with the logarithm of its length.
What can't be resolved is in or behind a cycle.

Defined results: calls of one conversation that share an identifier are one call (``n_calls`` tells how many; the smallest
place, name and arguments speak for them), so are results; a null conversation is one of its own; null identifiers are
dropped; a dependency on an unknown identifier is counted in ``missing_after`` and ignored for the order; arguments that
aren't a JSON object fail validation and are null in the record; results without a call are left out and an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeloom.llm.common import checkpointed, read, small_side

#: JSON types by the leading name of a variant's schema.
TYPES = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DECIMAL", "DOUBLE"), "boolean": ("BOOLEAN",), "object": ("OBJECT",), "array": ("ARRAY",)}

#: Calls of one conversation that are put in order together.
PART_CALLS = 4096

MESSAGE = "tool_calls array<struct<id:string,name:string,arguments:string,after:array<string>>>, tool_call_id string, content string"


def parse_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results from ``conv_id, turn, role, text``: assistant texts ``{"tool_calls": [...]}``, tool texts ``{"tool_call_id", "content"}``."""
    body = messages.where(F.col("role").isin("assistant", "tool") & F.col("text").startswith("{")).withColumn("_m", F.from_json("text", MESSAGE))
    calls = body.where("role = 'assistant'").select("conv_id", "turn", F.posexplode("_m.tool_calls").alias("idx", "c"))
    calls = calls.select("conv_id", "turn", "idx", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"), F.col("c.after").alias("after"))
    return calls, body.where("role = 'tool'").select("conv_id", F.col("_m.tool_call_id").alias("call_id"), F.col("_m.content").alias("content"))


def turn_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results from plain conversations: each user turn calls the responder, the assistant's next turn is its result.

    A call depends on the user turn before it, and in every fourth conversation on the one after it.
    """
    name = lambda turn: F.concat(F.lit("c"), turn.cast("string"))
    turn, text = F.col("turn"), F.coalesce(F.col("text"), F.lit(""))
    arguments = F.to_json(F.struct(F.length(text).alias("chars"), text.alias("text"), F.when(turn % 4 == 2, F.lit("follow-up")).alias("kind")))
    after = F.when(F.col("conv_id") % 4 == 1, F.array(name(turn + 2))).when(turn >= 2, F.array(name(turn - 2))).otherwise(F.array().cast("array<string>"))
    calls = messages.where(F.col("role") == "user").select("conv_id", "turn", F.lit(0).alias("idx"), name(turn).alias("call_id"), F.lit("respond").alias("name"), arguments.alias("arguments"), after.alias("after"))
    return calls, messages.where(F.col("role") == "assistant").select("conv_id", name(turn - 1).alias("call_id"), text.alias("content"))


def problems(name: Column, arguments: Column, schemas: dict) -> Column:
    """What is wrong with the arguments (a variant) under the tool's JSON schema; empty if nothing is."""
    found = F.when(arguments.isNull() | (F.schema_of_variant(arguments).startswith("OBJECT") == F.lit(False)), F.lit("arguments: not an object"))
    keys = F.json_object_keys(F.to_json(arguments))
    for tool, schema in sorted(schemas.items()):
        checks = []
        for field, rule in sorted(schema.get("properties", {}).items()):
            at = "$[" + json.dumps(field).replace('"', "'") + "]"
            value = F.try_variant_get(arguments, at, "variant")
            kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
            absent = value.isNull()
            if field in schema.get("required", ()):
                checks.append(F.when(absent | (kind == "VOID"), F.lit(f"{field}: missing")))
            right = kind == "VOID"
            for t in TYPES[rule["type"]]:
                right = right | kind.startswith(t)
            checks.append(F.when(~absent & ~right, F.lit(f"{field}: not a {rule['type']}")))
            if "enum" in rule:
                checks.append(F.when(~absent & ~F.try_variant_get(arguments, at, "string").isin(rule["enum"]), F.lit(f"{field}: not allowed")))
            if "minimum" in rule:
                checks.append(F.when(F.try_variant_get(arguments, at, "double") < rule["minimum"], F.lit(f"{field}: too small")))
            if "maximum" in rule:
                checks.append(F.when(F.try_variant_get(arguments, at, "double") > rule["maximum"], F.lit(f"{field}: too large")))
        if not schema.get("additionalProperties", True):
            extra = F.array_except(keys, F.array(*[F.lit(x) for x in sorted(schema.get("properties", {}))]).cast("array<string>"))
            checks.append(F.when(F.size(extra) > 0, F.concat(F.array_join(F.array_sort(extra), ","), F.lit(": unknown"))))
        found = found.when(name == tool, F.concat_ws("; ", *checks))
    return found.otherwise(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit("null"))))


def node_of(call_id: Column) -> Column:
    """One name for a conversation and an identifier in it."""
    return F.concat(F.coalesce(F.concat(F.lit("s"), F.col("conv_id").cast("string")), F.lit("n")), F.lit("\0"), call_id)


def levels(calls: DataFrame) -> DataFrame:
    """``node, level, missing_after``; level is -1 in and behind a cycle.  ``calls`` is unique by ``node``."""
    at = calls.select(F.col("node").alias("d"), F.struct("turn", "idx").alias("pd"))
    edges = calls.select(F.col("node").alias("x"), "conv_id", F.struct("turn", "idx").alias("px"), F.explode(F.array_distinct("after")).alias("_d")).where("_d is not null")
    edges = edges.select("x", "conv_id", "px", node_of(F.col("_d")).alias("d")).join(at, "d", "left")
    edges = checkpointed(edges.select("x", "d", "conv_id", F.col("pd").isNull().alias("unknown"), F.coalesce(F.col("pd") >= F.col("px"), F.lit(False)).alias("forward")))
    missing = edges.where("unknown").groupBy(F.col("x").alias("node")).agg(F.count(F.lit(1)).alias("missing_after"))
    out = calls.select("node").join(missing, "node", "left").withColumn("missing_after", F.coalesce("missing_after", F.lit(0)))
    if edges.where("forward").isEmpty():
        return out.withColumn("level", F.lit(0).cast("long"))
    some = small_side(checkpointed(edges.where("forward").groupBy(F.coalesce(F.col("conv_id").cast("string"), F.lit("n")).alias("c")).agg(F.max("forward").alias("f"))))
    pending = edges.where("not unknown").join(some, F.coalesce(F.col("conv_id").cast("string"), F.lit("n")) == F.col("c"), "left_semi")
    pending = checkpointed(pending.select("x", "d", F.col("forward").cast("long").alias("w")))
    done = resolved(pending)
    level = F.when(F.col("known").isNull(), F.lit(0)).when(F.col("known"), F.col("b")).otherwise(F.lit(-1)).cast("long")
    return out.join(done, F.col("node") == F.col("x"), "left").select("node", "missing_after", level.alias("level"))


def resolved(pending: DataFrame) -> DataFrame:
    """``x, b, known`` of every ``x`` in the edges ``x, d, w``: the heaviest way from it along dependencies; not known behind a cycle."""
    base = checkpointed(pending.groupBy("x").agg(F.lit(0).cast("long").alias("b")))
    left, idle = pending.count(), 0
    while left and idle <= math.log2(left) + 2:  # in a cycle jumps go round for ever; elsewhere so many reach an end
        waits = pending.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.first("d").alias("e"), F.first("w").alias("v"))
        known = base.select(F.col("x").alias("d"), F.col("b").alias("bd")).join(waits.withColumnRenamed("x", "d"), "d", "left")
        # calls without dependencies have no row and count 0
        step = pending.join(known, "d", "left").withColumn("bd", F.coalesce("bd", F.lit(0)))
        jump = F.coalesce(F.col("n"), F.lit(0)) == 1
        step = checkpointed(step.select("x", F.when(jump, F.col("e")).otherwise(F.col("d")).alias("d"), F.when(jump, F.col("w") + F.col("v")).otherwise(F.col("w")).alias("w"), F.coalesce(F.col("n"), F.lit(0)).alias("n"), (F.col("bd") + F.col("w")).alias("to")))
        gain = step.where("n < 2").groupBy("x").agg(F.max("to").alias("to"))
        base = checkpointed(base.join(gain, "x", "left").select("x", F.greatest("b", F.coalesce("to", F.lit(0))).alias("b")))
        pending = checkpointed(step.where("n > 0").groupBy("x", "d").agg(F.max("w").alias("w")))
        now = pending.count()
        idle = idle + 1 if now == left else 0
        left = now
    return base.join(pending.select("x", F.lit(True).alias("_open")).distinct(), "x", "left").select("x", "b", F.col("_open").isNull().alias("known"))


def link(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """One row for each call: its place, result, validation and canonical record."""
    calls = calls.where("call_id is not null").withColumn("node", node_of(F.col("call_id")))
    same = calls.groupBy("node").agg(F.min(F.struct("conv_id", "turn", "idx", "call_id", "name", "arguments", "after")).alias("c"), F.count(F.lit(1)).alias("n_calls")).select("node", "c.*", "n_calls")
    same = checkpointed(same)
    answers = results.where("call_id is not null").groupBy(node_of(F.col("call_id")).alias("node")).agg(F.min("content").alias("content"), F.count(F.lit(1)).alias("n_results"))
    both = same.drop("after").join(levels(same), "node").join(answers.hint("shuffle_hash"), "node", "left")
    both = both.select("*", F.explode(F.array(F.try_parse_json("arguments"))).alias("_a"))
    canonical = F.to_json(F.col("_a"))
    quoted = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    record = F.concat(F.lit('{"arguments":'), F.coalesce(canonical, F.lit("null")), F.lit(',"id":'), quoted(F.col("call_id")), F.lit(',"name":'), F.coalesce(quoted(F.col("name")), F.lit("null")), F.lit(',"result":'), F.when(F.col("content").isNull(), F.lit("null")).otherwise(quoted(F.col("content"))), F.lit("}"))
    return both.select(
        "conv_id", "turn", "idx", "call_id", "name", "level", "missing_after", "n_calls", F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.when(F.col("n_results").isNull(), "unanswered").when(F.col("n_results") > 1, "answered twice").otherwise("answered").alias("status"),
        problems(F.col("name"), F.col("_a"), schemas).alias("problems"), record.alias("record"),
    )


def rendered(linked: DataFrame) -> DataFrame:
    """Adds the gapless ``place`` of each call in its conversation's topological order.

    A conversation of more than PART_CALLS calls is cut by level and turn into even ranges, which are put in order
    one by one and shifted by the calls of the ranges before.
    """
    linked = checkpointed(linked)
    per = linked.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"), F.min("level").alias("_l"), F.max("level").alias("_m"), F.min("turn").alias("_t"), F.max("turn").alias("_u")).where(F.col("_n") > PART_CALLS)
    per = checkpointed(per.withColumnRenamed("conv_id", "_c"))
    if per.isEmpty():
        return linked.withColumn("place", F.row_number().over(W.partitionBy("conv_id").orderBy("level", "turn", "idx", "call_id")).cast("long"))
    wide = linked.join(small_side(per), F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    turns = (F.col("_u") - F.col("_t") + 1).cast("double")
    share = ((F.col("level") - F.col("_l")) * turns + F.col("turn") - F.col("_t")) / ((F.col("_m") - F.col("_l") + 1) * turns)
    wide = wide.withColumn("_r", F.coalesce(F.floor(share * F.ceil(F.col("_n") / PART_CALLS)), F.lit(0))).drop("_c", "_n", "_l", "_m", "_t", "_u")
    parts = wide.where("_r is not null").groupBy("conv_id", "_r").agg(F.count(F.lit(1)).alias("_k"))
    before = parts.withColumn("_b", F.coalesce(F.sum("_k").over(W.partitionBy("conv_id").orderBy("_r").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    before = checkpointed(before.where("_b > 0").select(F.col("conv_id").alias("_c"), F.col("_r").alias("_s"), "_b"))
    wide = wide.join(small_side(before), F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_r") == F.col("_s")), "left")
    rank = F.row_number().over(W.partitionBy("conv_id", "_r").orderBy("level", "turn", "idx", "call_id"))
    return wide.withColumn("place", (rank + F.coalesce("_b", F.lit(0))).cast("long")).drop("_c", "_r", "_s", "_b")


SCHEMAS = {
    "respond": {
        "properties": {"chars": {"type": "integer", "minimum": 1, "maximum": 400}, "text": {"type": "string"}, "kind": {"type": "string", "enum": ["follow-up"]}},
        "required": ["text", "chars"],
        "additionalProperties": False,
    }
}


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    parsed, answers = parse_messages(messages)
    plain, replies = turn_calls(messages)
    return rendered(link(parsed.unionByName(plain), answers.unionByName(replies), SCHEMAS))


#: For conversations whose turns are plain texts, as in the tables at hand.
OP5_SQL = r"""
WITH c AS (SELECT conv_id, turn, min(coalesce(text, '')) AS text, count(*) AS n_calls FROM conversations WHERE role = 'user' AND turn IS NOT NULL GROUP BY ALL),
r AS (SELECT conv_id, turn - 1 AS turn, min(coalesce(text, '')) AS content, count(*) AS n_results FROM conversations WHERE role = 'assistant' AND turn IS NOT NULL GROUP BY ALL),
g AS (SELECT *, coalesce(conv_id % 4 = 1, false) AS ahead, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run FROM c),
l AS (SELECT *, CASE WHEN ahead THEN count(*) OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn DESC) - 1 ELSE 0 END AS level FROM g),
a AS (SELECT l.*, CASE WHEN ahead THEN turn + 2 WHEN turn >= 2 THEN turn - 2 END AS after_turn FROM l)
SELECT a.conv_id, a.turn, 0 AS idx, 'c' || a.turn AS call_id, 'respond' AS name, a.level,
    CASE WHEN after_turn IS NOT NULL AND d.turn IS NULL THEN 1 ELSE 0 END AS missing_after,
    a.n_calls, coalesce(n_results, 0) AS n_results,
    CASE WHEN n_results IS NULL THEN 'unanswered' WHEN n_results > 1 THEN 'answered twice' ELSE 'answered' END AS status,
    CASE WHEN length(a.text) < 1 THEN 'chars: too small' WHEN length(a.text) > 400 THEN 'chars: too large' ELSE '' END AS problems,
    '{"arguments":{"chars":' || length(a.text) || CASE WHEN a.turn % 4 = 2 THEN ',"kind":"follow-up"' ELSE '' END || ',"text":' || to_json(a.text)::VARCHAR || '},"id":"c' || a.turn
    || '","name":"respond","result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}' AS record,
    row_number() OVER (PARTITION BY a.conv_id ORDER BY a.level, a.turn) AS place
FROM a LEFT JOIN r ON a.conv_id IS NOT DISTINCT FROM r.conv_id AND a.turn = r.turn LEFT JOIN c d ON a.conv_id IS NOT DISTINCT FROM d.conv_id AND a.after_turn = d.turn
"""
