"""Linking tool calls to their results, native throughout.

Calls and results meet in a hash join by conversation and identifier. A call may build on an earlier one; the depth of
a call in that forest is its topological level, found by pointer doubling in as many rounds as the longest chain has
binary digits, so a conversation of any length never meets in one task. Arguments are checked against the tool's schema,
and each linked call becomes one canonical JSON record: keys sorted, no blanks, one spelling for equal numbers (``1``, ``1.0`` and
``10e-1`` are ``1``).

Defined cases: repeated rows of one identifier count as one (``copies`` counts them); if they differ, all are conflicting: the
smallest by value keeps the identifier's place, the others get rows of their own without level and result. Rows without an
identifier get a row per distinct value that says so. A call without a result, with unreadable, missing, surplus or wrongly typed
arguments, of an unknown tool, built on an unknown call, or in a cycle is named so in ``status``; a result without a call
gives a row of its own; null text is JSON null; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

KEY = ["conv_id", "call_id"]
CALL = ["after", "name", "arguments"]
# JSON types of a schema, and the types under which a parsed value is known.
TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DECIMAL", "DOUBLE"], "boolean": ["BOOLEAN"], "object": ["OBJECT"], "array": ["ARRAY"]}


# The tokens of JSON text (strings, numbers, all else), and a number of it in its parts.
TOKENS = r'"(?:[^"\\]|\\.)*+"|-?[0-9][0-9.eE+-]*+|[^"0-9-]++|-'
EXPONENT = r"^-?[0-9]+(?:\.[0-9]+)?[eE][+-]?[0-9]{1,2}$"


def _values(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of each identifier with their ``copies``; combined before the shuffle."""
    return rows.groupBy(*KEY, F.struct(*columns).alias("row")).agg(F.count(F.lit(1)).alias("copies"))


def _identified() -> Column:
    return F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()


def _single(values: DataFrame) -> DataFrame:
    """One row per identifier, the smallest value, with ``conflict`` if there are others."""
    one = values.filter(_identified()).groupBy(*KEY)
    first = one.agg(F.min("row").alias("row"), F.sum("copies").alias("all_copies"), F.min_by("copies", "row").alias("copies"), F.count(F.lit(1)).alias("kinds"))
    conflict = F.col("kinds") > 1
    return first.select(*KEY, "row.*", F.when(conflict, F.col("copies")).otherwise(F.col("all_copies")).alias("copies"), conflict.alias("conflict"))


def _rest(values: DataFrame, single: DataFrame, columns: list[str], what: str) -> DataFrame:
    """Values that keep no place: those without an identifier, and those beside the smallest of a conflict."""
    row = F.struct(*columns)
    kept = single.filter("conflict").select(*KEY, row.alias("first"))
    beside = values.join(kept, KEY).filter(~F.col("row").eqNullSafe(F.col("first")))
    rows = values.filter(~_identified()).select(*KEY, F.lit(f"{what} without an identifier").alias("status"), "copies", "row.*")
    return rows.unionByName(beside.select(*KEY, F.lit(f"conflicting {what}s").alias("status"), "copies", "row.*"))


def canonical(json: Column) -> Column:
    """JSON text with one spelling for equal numbers: no exponent up to 18 digits on either side, no zeros at the end."""

    def spelled(token: Column) -> Column:
        wide = F.when(token.rlike(EXPONENT), token.try_cast("decimal(38,18)"))
        # What the decimal cannot hold stays a double in its shortest form.
        exact = F.when((F.abs(wide) >= 1) | (wide == 0) | (token.try_cast("double") == wide.cast("double")), wide.cast("string"))
        plain = F.coalesce(exact, token)
        short = F.when(F.contains(plain, F.lit(".")) & ~plain.rlike("[eE]"), F.regexp_replace(plain, r"\.?0+$", "")).otherwise(F.regexp_replace(plain, r"\.0+(?=[eE])", ""))
        return F.when(short == "-0", "0").otherwise(short)

    tokens = F.regexp_extract_all(json, F.lit(TOKENS), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.when(t.rlike("^-?[0-9]"), spelled(t)).otherwise(t)), "")


def _record(arguments: Column, call_id: Column, name: Column, result: Column) -> Column:
    fields = F.struct(F.try_parse_json(arguments).alias("arguments"), call_id.alias("call_id"), name.alias("name"), result.alias("result"))
    return canonical(F.to_json(fields, {"ignoreNullFields": "false"}))


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level: calls below a call in its chain; null where the chain is a cycle.

    Each round, a call's pointer jumps to where its target points, and the distances add up.
    """
    jump = materialize(calls.select(*KEY, F.col("after").alias("target"), F.when(F.col("after").isNull(), 0).otherwise(1).cast("bigint").alias("level")), "call-levels")
    total = jump.count()
    for _ in range(math.ceil(math.log2(total + 1)) + 1):
        if jump.filter(F.col("target").isNotNull()).isEmpty():
            break
        ends = jump.select("conv_id", F.col("call_id").alias("target"), F.col("target").alias("further"), F.col("level").alias("more"))
        moving = jump.filter(F.col("target").isNotNull()).join(ends, ["conv_id", "target"])
        moved = moving.select(*KEY, F.col("further").alias("target"), (F.col("level") + F.col("more")).alias("level"))
        jump = materialize(jump.filter(F.col("target").isNull()).unionByName(moved), "call-levels")
    return jump.select(*KEY, F.when(F.col("target").isNull(), F.col("level")).alias("level"))


def argument_faults(parsed: Column, rules: Column) -> Column:
    """The first fault of arguments (a map of variants) under rules (array of parameter, type, required), or null."""
    kind = F.create_map(*(F.lit(x) for pair in TYPES.items() for x in (pair[0], ",".join(pair[1]))))

    def fault(rule: Column) -> Column:
        value = F.try_element_at(parsed, rule["parameter"])
        found = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
        wrong = ~F.array_contains(F.split(F.element_at(kind, rule["type"]), ","), found)
        return F.when(value.isNull() & rule["required"], F.lit("missing argument")).when(value.isNotNull() & wrong, F.lit("wrong argument type"))

    faults = F.filter(F.transform(rules, fault), lambda x: x.isNotNull())
    surplus = F.size(F.array_except(F.map_keys(parsed), F.transform(rules, lambda x: x["parameter"]))) > 0
    return F.when(parsed.isNull(), F.lit("unreadable arguments")).when(F.size(faults) > 0, F.array_min(faults)).when(surplus, F.lit("surplus argument"))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and per result without a call: conv_id, call_id, level, status, copies, record.

    ``calls``: conv_id, call_id, after, name, arguments (JSON text); ``results``: conv_id, call_id, content;
    ``schemas``: name, parameter, type, required.
    """
    said = materialize(_values(calls, CALL), "calls")
    told = materialize(_values(results, ["content"]), "results")
    single = materialize(_single(said), "single-calls")
    targets = single.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("known"))
    built = single.join(targets, ["conv_id", "after"], "left")
    dangling = F.col("after").isNotNull() & F.col("known").isNull()
    built = built.withColumn("dangling", dangling).withColumn("after", F.when(F.col("known"), F.col("after")))
    ordered = built.join(levels(built), KEY)
    tools = schemas.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("parameter", "type", "required"))).alias("rules"))
    single_results = _single(told)
    answers = single_results.select(*KEY, "content", F.col("copies").alias("answers"), F.col("conflict").alias("results_differ"))
    linked = ordered.join(answers.hint("shuffle_hash"), KEY, "full")
    checked = linked.join(tools, "name", "left").withColumn("parsed", F.from_json("arguments", "map<string,variant>"))
    fault = argument_faults(F.col("parsed"), F.col("rules"))
    status = (
        F.when(F.col("name").isNull() & F.col("copies").isNull(), "result without a call")
        .when(F.col("conflict"), "conflicting calls")
        .when(F.col("results_differ"), "conflicting results")
        .when(F.col("level").isNull(), "cycle")
        .when(F.col("dangling"), "unknown call referred to")
        .when(F.col("rules").isNull(), "unknown tool")
        .when(fault.isNotNull(), fault)
        .when(F.col("answers").isNull(), "no result")
        .otherwise("ok")
    )
    null = F.lit(None).cast("string")
    out = checked.select(
        "conv_id", "call_id", "level", status.alias("status"), F.coalesce("copies", "answers").alias("copies"),
        _record(F.col("arguments"), F.col("call_id"), F.col("name"), F.col("content")).alias("record"),
    )
    level = F.lit(None).cast("bigint").alias("level")
    more_calls = _rest(said, single, CALL, "call").select("conv_id", "call_id", level, "status", "copies", _record(F.col("arguments"), F.col("call_id"), F.col("name"), null).alias("record"))
    more_results = _rest(told, single_results, ["content"], "result").select("conv_id", "call_id", level, "status", "copies", _record(null, F.col("call_id"), null, F.col("content")).alias("record"))
    return out.unionByName(more_calls).unionByName(more_results)


def from_conversations(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations: a user's turn calls the tool ``reply`` and builds on their turn before;
    the assistant's turn that follows is the result."""
    turn = F.col("turn")
    name = lambda t: F.concat_ws("-", F.col("conv_id").cast("string"), t.cast("string"))
    arguments = F.to_json(F.struct(F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint").alias("n_chars"), F.col("text").alias("prompt")), {"ignoreNullFields": "false"})
    calls = messages.filter((F.col("role") == "user") & turn.isNotNull()).select(
        "conv_id", name(turn).alias("call_id"), F.when(turn >= 2, name(turn - 2)).alias("after"), F.lit("reply").alias("name"), arguments.alias("arguments")
    )
    results = messages.filter((F.col("role") == "assistant") & turn.isNotNull()).select("conv_id", name(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


#: The schema of the tool above.
REPLY = [("reply", "n_chars", "integer", True), ("reply", "prompt", "string", True)]
