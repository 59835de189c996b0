"""Chat formatting with tool calls. DataFrame operations only.

Calls and results are linked by a hash join on (conversation, identifier), put in
topological order, checked against the tools' schemas, and written as canonical
JSON: keys sorted, no blanks, numbers as parsed.

A conversation may be as long as it likes: every message is a row, never part of
an array of its conversation, and no window runs over one. The order is a number:
``step``. Sorting a conversation by (step, turn, call_id) gives a topological
order: other messages first, each call after the result it needs, each result
after its call.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import staged


class Argument(NamedTuple):
    tool: str
    name: str
    type: str  # as schema_of_variant names it: STRING, BIGINT, BOOLEAN, ...
    required: bool = True
    max_length: int | None = None  # of a string


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) of ``calls(conv_id, call_id, after)`` with unique identifiers.

    ``after`` names the call whose result a call needs; without one, or if there is
    no such call, the depth is 0, else one more than that call's. Pointers to calls
    further and further before are followed, twice as far each round, so a chain of
    n calls takes log2(n) rounds. A call on a cycle, or after one, has a null depth.
    """
    known = calls.select(F.col("conv_id").alias("conv"), F.col("call_id").alias("to"))
    there = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("after") == F.col("to"))
    start = calls.join(known, there, "left").select(
        "conv_id", "call_id", "to", F.when(F.col("to").isNull(), 0).otherwise(1).cast("long").alias("depth")
    )
    state = staged(start, "call-depths")
    most = calls.groupBy("conv_id").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    reach = 1
    while reach < 2 * most:
        if state.where(F.col("to").isNotNull()).isEmpty():
            break
        ahead = state.select(
            F.col("conv_id").alias("conv"), F.col("call_id").alias("at"), F.col("to").alias("next"), F.col("depth").alias("more")
        )
        same = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("to") == F.col("at"))
        state = staged(
            state.join(ahead, same, "left").select(
                "conv_id", "call_id", F.col("next").alias("to"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
            ),
            "call-depths",
        )
        reach *= 2
    return state.select("conv_id", "call_id", F.when(F.col("to").isNull(), F.col("depth")).alias("depth"))


def argument_errors(tool: Column, arguments: Column, schema: list[Argument]) -> Column:
    """What is wrong with the arguments (a variant, null if they were no JSON), comma-joined; empty if nothing."""
    tools = list(dict.fromkeys(a.tool for a in schema))
    names = F.map_keys(F.try_variant_get(arguments, "$", "map<string,variant>"))
    found = F.lit("unknown tool")
    for t in tools:
        known = [a for a in schema if a.tool == t]
        checks = []
        for a in known:
            value = F.try_variant_get(arguments, f"$.{a.name}", "variant")
            kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
            missing = kind == "VOID"
            checks.append(F.when(missing, F.lit(f"missing {a.name}") if a.required else F.lit(None).cast("string")))
            checks.append(F.when(~missing & (kind != a.type), F.lit(f"type of {a.name}")))
            if a.max_length is not None:
                text = F.try_variant_get(arguments, f"$.{a.name}", "string")
                checks.append(F.when((kind == "STRING") & (F.char_length(text) > a.max_length), F.lit(f"length of {a.name}")))
        extra = F.array_sort(F.array_except(names, F.array(*(F.lit(a.name) for a in known))))
        checks.append(F.when(F.size(extra) > 0, F.concat(F.lit("unknown "), F.array_join(extra, " "))))
        found = F.when(tool == t, F.concat_ws(",", *checks)).otherwise(found)
    return F.when(names.isNull(), F.lit("not an object")).otherwise(found)


def link(calls: DataFrame, results: DataFrame, others: DataFrame, schema: list[Argument]) -> DataFrame:
    """(conv_id, turn, call_id, kind, status, errors, step, message) for every row of the three tables.

    ``calls(conv_id, turn, call_id, after, tool, arguments)``, arguments being JSON;
    ``results(conv_id, turn, call_id, content)``; ``others(conv_id, turn, role, content)``.
    kind: call, result or text. status: a call is answered or unanswered; of calls with
    one identifier the earliest counts (then by tool and arguments), further ones
    are repeated and have no step, as have calls on a cycle and their results. A
    result is linked, repeated (a later one for its call) or orphan (no such call,
    no step). A null identifier links nothing. Null texts are null in the JSON.
    Rows that are repeated in full come back as often, with the same status.
    """
    columns = ["conv_id", "turn", "call_id", "kind", "status", "errors", "step", "message"]
    calls = calls.select("conv_id", "turn", "call_id", "after", "tool", "arguments")
    results = results.select("conv_id", "turn", "call_id", "content")
    nothing = F.lit(None).cast("string")
    rank = F.struct("turn", "tool", "arguments")
    first = (
        calls.where(F.col("call_id").isNotNull())
        .groupBy("conv_id", "call_id")
        .agg(F.min(F.struct("turn", "tool", "arguments", "after")).alias("first"))
    )
    head = F.struct("first.turn", "first.tool", "first.arguments").alias("head")
    first = staged(first.select("conv_id", "call_id", F.col("first.after").alias("after"), head), "calls")
    answers = (
        results.where(F.col("call_id").isNotNull())
        .groupBy("conv_id", "call_id")
        .agg(F.min(F.struct("turn", "content")).alias("answer"))
    )
    depth = depths(first)
    linked = staged(
        first.join(_side(depth, "d").hint("shuffle_hash"), _same("d"))
        .join(_side(answers, "r").hint("shuffle_hash"), _same("r"), "left")
        .select("conv_id", "call_id", "head", "answer", "depth"),
        "linked-calls",
    )
    known = _side(linked, "k").hint("shuffle_hash")
    parsed = F.try_parse_json("arguments")
    leads = F.col("head").eqNullSafe(rank)
    call_json = F.struct(
        parsed.alias("arguments"), F.col("call_id").alias("id"), F.lit("call").alias("kind"), F.col("tool")
    )
    call_rows = calls.join(known, _same("k"), "left").select(
        "conv_id",
        "turn",
        "call_id",
        F.lit("call").alias("kind"),
        F.when(F.col("call_id").isNotNull() & ~leads, "repeated")
        .when(F.col("answer").isNull(), "unanswered")
        .otherwise("answered")
        .alias("status"),
        argument_errors(F.col("tool"), parsed, schema).alias("errors"),
        F.when(leads, 2 * F.col("depth")).alias("step"),
        _json(call_json).alias("message"),
    )
    result_json = F.struct(F.col("content"), F.col("call_id").alias("id"), F.lit("result").alias("kind"))
    result_rows = results.join(known, _same("k"), "left").select(
        "conv_id",
        "turn",
        "call_id",
        F.lit("result").alias("kind"),
        F.when(F.col("k_id").isNull(), "orphan")
        .when(F.col("answer").eqNullSafe(F.struct("turn", "content")), "linked")
        .otherwise("repeated")
        .alias("status"),
        nothing.alias("errors"),
        (2 * F.col("depth") + 1).alias("step"),
        _json(result_json).alias("message"),
    )
    text_json = F.struct(F.col("content"), F.lit("text").alias("kind"), F.col("role"))
    text_rows = others.select(
        "conv_id",
        "turn",
        nothing.alias("call_id"),
        F.lit("text").alias("kind"),
        nothing.alias("status"),
        nothing.alias("errors"),
        F.lit(-1).cast("long").alias("step"),
        _json(text_json).alias("message"),
    )
    return call_rows.select(columns).unionByName(result_rows.select(columns)).unionByName(text_rows.select(columns))


def _side(df: DataFrame, name: str) -> DataFrame:
    """One side of a join by identifier, its keys renamed."""
    return df.withColumnsRenamed({"conv_id": f"{name}_conv", "call_id": f"{name}_id"})


def _same(name: str) -> Column:
    return F.col("conv_id").eqNullSafe(F.col(f"{name}_conv")) & (F.col("call_id") == F.col(f"{name}_id"))


def _json(row: Column) -> Column:
    """A struct whose fields stand in order of their names, as JSON with its nulls; objects inside a variant are sorted."""
    return F.to_json(row, {"ignoreNullFields": "false"})
