"""Linking tool calls and their results, with DataFrame functions only.

Calls and results are hash-joined by identifier. A call may name the call that
it comes after; these links order the calls: how deep a call is comes from
pointer doubling, which halves what is left of every chain each round, so a
chain of n calls takes log2(n) rounds of joins and no conversation is gathered
into one task. Arguments are parsed as variants and held against the tools'
schemas; a variant keeps the keys of its objects in order, so its text is the
canonical JSON.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.session import Stage

#: Tool to field to (type, whether it is required). Types: string, integer, number, boolean, object, array.
Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]
_TYPES = {"string": r"^STRING$", "integer": r"^BIGINT$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": r"^BOOLEAN$", "object": r"^OBJECT<", "array": r"^ARRAY<"}


def quoted(text: Column) -> Column:
    """A string as JSON; null as null."""
    return F.coalesce(F.to_json(text.cast("variant")), F.lit("null"))


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Array of what is wrong with a call, in order; empty if nothing is."""
    value = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False))
    out = F.when(value.isNull(), F.array(F.lit("not_json"))).when(~is_object, F.array(F.lit("not_an_object")))
    for tool, fields in sorted(schemas.items()):
        found = []
        for field, (kind, required) in sorted(fields.items()):
            have = F.schema_of_variant(F.try_variant_get(value, "$." + field, "variant"))
            if required:
                found.append(F.when(have.isNull(), F.lit(f"missing:{field}")))
            found.append(F.when(have.isNotNull() & ~have.rlike(_TYPES[kind]), F.lit(f"type:{field}")))
        known = F.array(*(F.lit(f) for f in sorted(fields))) if fields else F.array().cast("array<string>")
        unknown = F.transform(F.array_sort(F.array_except(F.coalesce(F.json_object_keys(F.to_json(value)), F.array().cast("array<string>")), known)), lambda f: F.concat(F.lit("unknown:"), f))
        out = out.when(name == tool, F.concat(F.array_compact(F.array(*found)) if found else F.array().cast("array<string>"), unknown))
    return out.otherwise(F.array(F.lit("unknown_tool")))


def depths(stage: Stage, calls: DataFrame) -> DataFrame:
    """call_id and depth (0 for a call that comes after none); depth is null on a cycle and after one."""
    known = calls.select(F.col("call_id").alias("known_id"))
    first = calls.where("after is null").select("call_id", F.lit(None).cast("string").alias("up"), F.lit(0).alias("depth"))
    at = calls.where("after is not null").join(known, F.col("after") == F.col("known_id"), "left").select("call_id", F.col("known_id").alias("up"), F.when(F.col("known_id").isNull(), 0).otherwise(1).alias("depth")).unionByName(first)
    at = stage.put(at, "depth-0")
    rounds, limit = 0, max(1, calls.count()).bit_length() + 1
    while rounds < limit and not at.where("up is not null").isEmpty():
        rounds += 1
        above = at.select(F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"))
        going = at.where("up is not null").join(above, "up").select("call_id", F.col("up2").alias("up"), (F.col("depth") + F.col("depth2")).alias("depth"))
        at = stage.put(going.union(at.where("up is null").select("call_id", "up", "depth")), f"depth-{rounds}")
        stage.drop(f"depth-{rounds - 1}")
    return at.select("call_id", F.when(F.col("up").isNull(), F.col("depth")).cast("int").alias("depth"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: Schemas, by_conversation: bool = True) -> DataFrame:
    """One row for each call and result of its: conv_id, call_id, ord, depth, status, errors and json.

    ``calls`` has conv_id, call_id, ord, name, arguments (JSON text) and after
    (the id of the call it follows, or null); ``results`` conv_id, call_id, ord
    and content. Status is linked, no_result or orphan_result (a result of no
    known call; depth, errors and json are null there). A call after an unknown
    id has depth 0; calls on a cycle, and after one, have none. Ids hold within
    their conversation. Of calls that share one the one of smallest ord (then
    arguments, name, after) counts; those equal in full are repeats of it,
    different ones are kept with the status duplicate_id, without depth or
    result. Each result is kept.
    Calls and results of a null id are kept and link to nothing. ``errors`` lists
    what is wrong with the arguments by schema (not_json, not_an_object,
    unknown_tool, missing:f, type:f, unknown:f). ``json`` has its keys in order;
    arguments that don't parse are a string in it. Other columns are ignored.

    ``by_conversation=False``: ids hold across conversations, and of the calls
    that share one only the first counts, the others are dropped as repeats.
    """
    scope = F.coalesce(F.concat(F.length(F.col("conv_id").cast("string")).cast("string"), F.lit(":"), F.col("conv_id").cast("string")), F.lit("-"))
    key = (lambda c: F.concat(scope, F.lit("/"), F.col(c))) if by_conversation else F.col
    stage = Stage(calls.sparkSession, "calls")
    every = calls.select("conv_id", key("call_id").alias("call_id"), F.col("ord").cast("long").alias("ord"), "name", "arguments", key("after").alias("after"), F.col("call_id").alias("id"), F.col("after").alias("after_id"))
    whole = F.struct("ord", "arguments", "name", "after", "conv_id", "id", "after_id")
    named = every.where("call_id is not null").groupBy("call_id").agg(F.min(whole).alias("c")).select("call_id", "c.*")
    named = stage.put(named, "named")
    deep = stage.put(depths(stage, named), "depths")
    placed = named.join(deep, "call_id")
    answers = results.select(F.col("conv_id").alias("result_conv"), key("call_id").alias("result_of"), F.col("call_id").alias("result_id"), F.col("ord").cast("long").alias("result_ord"), "content")
    answers = stage.put(answers, "answers")
    nothing = {c: F.lit(None).cast(answers.schema[c].dataType) for c in answers.columns}  # null ids meet in no join, where they would all be one key
    lone = every.where("call_id is null").withColumn("depth", F.lit(0)).withColumns(nothing)
    linked = placed.join(answers, F.col("call_id") == F.col("result_of"), "left").unionByName(lone)
    value = F.coalesce(F.to_json(F.try_parse_json("arguments")), quoted(F.col("arguments")))
    has_result = F.col("result_of").isNotNull()
    json = F.concat(
        F.lit('{"after":'), quoted(F.col("after_id")), F.lit(',"arguments":'), value, F.lit(',"id":'), quoted(F.col("id")), F.lit(',"name":'), quoted(F.col("name")),
        F.lit(',"result":'), F.when(has_result, quoted(F.col("content"))).otherwise("null"), F.lit("}"),
    )
    errors = argument_errors(F.coalesce("name", F.lit("")), F.col("arguments"), schemas)
    found = linked.select("conv_id", F.col("id").alias("call_id"), "ord", "depth", "result_ord", F.when(has_result, "linked").otherwise("no_result").alias("status"), errors.alias("errors"), json.alias("json"))
    orphans = answers.where("result_of is not null").join(named.select(F.col("call_id").alias("known_id")), F.col("result_of") == F.col("known_id"), "left_anti").unionByName(answers.where("result_of is null"))
    orphans = orphans.select(F.col("result_conv").alias("conv_id"), F.col("result_id").alias("call_id"), F.lit(None).cast("long").alias("ord"), F.lit(None).cast("int").alias("depth"), "result_ord", F.lit("orphan_result").alias("status"), F.lit(None).cast("array<string>").alias("errors"), F.lit(None).cast("string").alias("json"))
    out = found.unionByName(orphans)
    if by_conversation:
        first = named.select("call_id", whole.alias("first"))
        others = every.where("call_id is not null").distinct().join(first, "call_id").where(~whole.eqNullSafe(F.col("first")))
        others = others.withColumn("result_of", F.lit(None).cast("string")).withColumn("content", F.lit(None).cast("string"))
        none = lambda kind: F.lit(None).cast(kind)
        out = out.unionByName(others.select("conv_id", F.col("id").alias("call_id"), "ord", none("int").alias("depth"), none("long").alias("result_ord"), F.lit("duplicate_id").alias("status"), errors.alias("errors"), json.alias("json")))
    return out


#: What the turns of a conversation count as.
TURN_SCHEMAS: Schemas = {"user": {"chars": ("integer", True), "text": ("string", True), "turn": ("integer", True)}, "system": {"chars": ("integer", True), "text": ("string", True), "turn": ("integer", True)}}


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that stand for a conversation's turns.

    An assistant's turn is the result of the turn before it; any other turn is
    a call, named by its role, after the turn before it if that is a call too,
    else after the one before that. A turn of a null conversation or number has
    a null id.
    """
    ident = lambda back: F.concat(F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - back).cast("string"))
    answer = F.coalesce(F.col("role") == "assistant", F.lit(False))
    arguments = F.to_json(F.struct("turn", "text", F.length("text").alias("chars")))
    calls = conversations.where(~answer).select("conv_id", ident(0).alias("call_id"), F.col("turn").alias("ord"), F.col("role").alias("name"), arguments.alias("arguments"), ident(1).alias("before"), ident(2).alias("second"))
    ids = calls.select(F.col("call_id").alias("prior")).distinct()
    calls = calls.join(ids, F.col("before") == F.col("prior"), "left")
    calls = calls.select("conv_id", "call_id", "ord", "name", "arguments", F.when(F.col("ord") > 0, F.coalesce("prior", F.when(F.col("ord") > 1, F.col("second")))).alias("after"))
    results = conversations.where(answer).select("conv_id", ident(1).alias("call_id"), F.col("turn").alias("ord"), F.col("text").alias("content"))
    return calls, results
