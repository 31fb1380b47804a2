"""Tool calls of conversations: linked to their results, ordered, validated and written as canonical JSON.

Calls and results meet in a hash join by conversation and call id. Calls that need the results of others come after
them: a call's level is 0 if it needs none, else one more than the largest level it needs, found in rounds that each
settle the calls whose needs are settled. Arguments are checked against the tool's schema. Each call becomes one row
with one line of JSON (keys sorted, no white space), ordered in its conversation by (level, turn, call_id); no
conversation is gathered in one place. Only DataFrame functions are used.

Defined results: identical repeated calls count once; of different calls with one id the smallest (turn, name,
arguments) owns it, the others get "duplicate_id" and no result; of several results the smallest (turn, content)
counts; a call without id gets "missing_id"; arguments that are null or no JSON object get
"arguments:not_an_object"; a need that no call of the conversation has gets "unknown_dependency"; calls in a cycle, or
behind one, have no level and get "cycle"; results without a call are rows with "no_call"; a null conversation id is
a conversation.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.session import stage


@dataclass(frozen=True)
class Parameter:
    """type: string, integer, number, boolean, array or object."""

    type: str
    required: bool = False
    least: int | None = None
    most: int | None = None


_TYPES = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": "(BIGINT|DOUBLE|FLOAT|DECIMAL.*)",
    "boolean": "BOOLEAN",
    "array": "ARRAY<.*",
    "object": "OBJECT<.*",
}

Schemas = Mapping[str, Mapping[str, Parameter]]

# The field of the arguments that lists the calls whose results are needed.
NEEDS = "after"


def json_string(value: Column) -> Column:
    """A JSON string literal, or null as the literal null."""
    listed = F.to_json(F.array(value))
    return F.coalesce(F.when(value.isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2)), F.lit("null"))


def canonical(json: Column) -> Column:
    """JSON with sorted keys and without white space; null if it is not valid."""
    return F.to_json(F.try_parse_json(json))


def _at(name: str) -> str:
    return f'$["{name}"]'


def argument_errors(name: Column, arguments: Column, keys: Column, schemas: Schemas) -> Column:
    """Errors of a call's arguments (a variant) against the schema of its tool."""
    cases: Column | None = None
    for tool, parameters in schemas.items():
        found = []
        for p, rule in parameters.items():
            value = F.try_variant_get(arguments, _at(p), "variant")
            there = F.array_contains(keys, p)
            if rule.required:
                found.append(F.when(~there, f"{p}:missing"))
            right = F.schema_of_variant(value).rlike(f"^{_TYPES[rule.type]}$")
            found.append(F.when(there & ~F.coalesce(right, F.lit(False)), f"{p}:not_{rule.type}"))
            number = F.try_variant_get(arguments, _at(p), "double")
            for bound, outside in ((rule.least, number < rule.least), (rule.most, number > rule.most)) if (
                rule.least is not None or rule.most is not None
            ) else ():
                if bound is not None:
                    found.append(F.when(there & right & outside, f"{p}:out_of_range"))
        known = F.array(*[F.lit(p) for p in parameters]) if parameters else F.array().cast("array<string>")
        unknown = F.transform(F.array_except(keys, known), lambda k: F.concat(k, F.lit(":unknown")))
        errors = F.concat(F.array_compact(F.array(*found)) if found else F.array().cast("array<string>"), unknown)
        cases = F.when(name == tool, errors) if cases is None else cases.when(name == tool, errors)
    wrong = F.array(F.lit("unknown_tool"))
    return wrong if cases is None else cases.otherwise(wrong)


def levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """(conv, call_id, level) of the calls that are not in or behind a cycle.

    calls: distinct (conv, call_id); needs: distinct (conv, call_id, needed), all of them among the calls.
    The number of rounds is the length of the longest chain.
    """
    settled = _meet(calls, needs.select("conv", "call_id"), "left_anti").withColumn("level", F.lit(0))
    settled, open_needs = stage(settled, "levels"), needs
    while True:
        joined = _meet(open_needs, settled.withColumnRenamed("level", "needed_level"), "left", "needed")
        found = joined.groupBy("conv", "call_id").agg(
            (F.max("needed_level") + 1).alias("level"), F.count_if(F.col("needed_level").isNull()).alias("open")
        )
        found = stage(found.where("open = 0").select("conv", "call_id", "level"), "levels")
        if found.isEmpty():
            return settled
        open_needs = _meet(open_needs, found.select("conv", "call_id"), "left_anti")
        settled = settled.unionByName(found)


def _meet(left: DataFrame, right: DataFrame, how: str, left_id: str = "call_id") -> DataFrame:
    """Join by conversation and call id; the other columns of `right` are added, its keys are not."""
    keyed = right.withColumnsRenamed({"conv": "_conv", "call_id": "_id"})
    return left.join(keyed, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col(left_id) == F.col("_id")), how).drop(
        "_conv", "_id"
    )


def linked(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call and per result without a call: conv_id, call_id, turn, level, valid, errors, json.

    calls: conv_id, call_id, turn, name, arguments (JSON text); results: conv_id, call_id, turn, content.
    errors: sorted, comma-joined.
    """
    calls = calls.select(
        F.col("conv_id").alias("conv"),
        F.col("call_id").cast("string").alias("call_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.col("name").cast("string").alias("name"),
        F.col("arguments").cast("string").alias("arguments"),
    ).distinct()
    content = F.struct(F.col("turn").cast("bigint").alias("turn"), F.col("content").cast("string").alias("content"))
    results = results.select(
        F.col("conv_id").alias("conv"), F.col("call_id").cast("string").alias("call_id"), content.alias("result")
    )
    results = results.groupBy("conv", "call_id").agg(F.min("result").alias("result"))

    own = F.struct("turn", "name", "arguments")
    owners = calls.where(F.col("call_id").isNotNull()).groupBy("conv", "call_id").agg(F.min(own).alias("owner"))
    owned = owners.select("conv", "call_id", "owner.*")
    rest = _meet(calls, owners, "left").where(F.col("owner").isNull() | ~own.eqNullSafe(F.col("owner"))).drop("owner")

    parsed = stage(
        owned.withColumn("canonical", canonical(F.col("arguments"))).withColumn(
            "needs",
            F.array_distinct(
                F.coalesce(
                    F.try_variant_get(F.try_parse_json("arguments"), _at(NEEDS), "array<string>"),
                    F.array().cast("array<string>"),
                )
            ),
        ),
        "calls",
    )
    needs = parsed.select("conv", "call_id", F.explode("needs").alias("needed"))
    keys = parsed.select("conv", "call_id", F.lit(True).alias("known"))
    needs = _meet(needs, keys, "left", "needed")
    needs = stage(needs.withColumn("known", F.coalesce("known", F.lit(False))), "needs")
    unknown = needs.where("NOT known").select("conv", "call_id").distinct().withColumn("lost", F.lit(True))
    level = levels(parsed.select("conv", "call_id"), needs.where("known").select("conv", "call_id", "needed"))

    ready = parsed.drop("needs")
    for other in (level, unknown, results):
        ready = _meet(ready, other, "left")
    ready = ready.withColumn("kind", F.lit("call"))
    others = rest.withColumn("canonical", canonical(F.col("arguments"))).withColumn(
        "kind", F.when(F.col("call_id").isNull(), "missing_id").otherwise("duplicate_id")
    )
    # a result without an id has no call either
    orphans = _meet(results, parsed.select("conv", "call_id"), "left_anti").select(
        "conv", "call_id", F.col("result.turn").alias("turn"), "result", F.lit("no_call").alias("kind")
    )
    rows = ready.unionByName(others, allowMissingColumns=True).unionByName(orphans, allowMissingColumns=True)

    object_keys = F.json_object_keys(F.col("canonical"))
    arguments = F.when(
        object_keys.isNull(), F.array(F.lit("arguments:not_an_object"))
    ).otherwise(argument_errors(F.col("name"), F.try_parse_json("canonical"), object_keys, schemas))
    errors = F.concat(
        F.when(F.col("kind") == "no_call", F.array().cast("array<string>")).otherwise(arguments),
        F.array_compact(
            F.array(
                F.when(F.col("kind") != "call", F.col("kind")),
                F.when((F.col("kind") == "call") & F.col("level").isNull(), "cycle"),
                F.when((F.col("kind") == "call") & F.col("result").isNull(), "no_result"),
                F.when(F.col("lost"), "unknown_dependency"),
            )
        ),
    )
    rows = rows.withColumn("errors", F.array_sort(F.array_distinct(errors)))
    text = F.col("canonical")
    json = F.concat(
        F.lit('{"arguments":'),
        F.coalesce(F.when(object_keys.isNotNull(), text), F.lit("null")),
        F.lit(',"errors":'),
        F.to_json("errors"),
        F.lit(',"id":'),
        json_string(F.col("call_id")),
        F.lit(',"name":'),
        json_string(F.col("name")),
        F.lit(',"result":'),
        json_string(F.col("result.content")),
        F.lit("}"),
    )
    return rows.select(
        F.col("conv").alias("conv_id"),
        "call_id",
        "turn",
        "level",
        (F.size("errors") == 0).alias("valid"),
        F.concat_ws(",", "errors").alias("errors"),
        json.alias("json"),
    )


# The tools of the registered query.
TOOLS: Schemas = {
    "search": {"query": Parameter("string", True), "limit": Parameter("integer", True, 1, 40), NEEDS: Parameter("array")},
    "lookup": {"key": Parameter("string", True), "strict": Parameter("boolean"), NEEDS: Parameter("array")},
    "note": {"text": Parameter("string", True), NEEDS: Parameter("array")},
}


def derived_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations, which hold none: a user's message calls a tool chosen by its length,
    with the message in the arguments, and needs the call two turns before unless it opens a run of eight turns; an
    assistant's message is the result of the call one turn before."""
    text, size, turn = F.coalesce(F.col("text"), F.lit("")), F.length(F.coalesce(F.col("text"), F.lit(""))), F.col("turn")

    def call(of: Column) -> Column:
        return F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), of.cast("string"))

    name = F.when(size % 3 == 0, "search").when(size % 3 == 1, "lookup").otherwise("note")
    search = F.concat(F.lit('"query" : '), json_string(text), F.lit(', "limit" : '), (size % 50).cast("string"))
    lookup = F.concat(
        F.lit('"strict" : true'),
        F.when(size % 5 != 0, F.concat(F.lit(', "key" : '), json_string(F.substring_index(text, " ", 1)))).otherwise(""),
    )
    note = F.concat(F.lit('"text" : '), json_string(text), F.when(size % 7 == 0, ', "draft" : true').otherwise(""))
    fields = F.when(name == "search", search).when(name == "lookup", lookup).otherwise(note)
    after = F.when(turn % 8 >= 2, F.concat(F.lit(f', "{NEEDS}" : ['), json_string(call(turn - 2)), F.lit("]"))).otherwise("")
    users = messages.where(F.col("role") == "user")
    calls = users.select(
        "conv_id", call(turn).alias("call_id"), "turn", name.alias("name"),
        F.concat(F.lit("{ "), fields, after, F.lit(" }")).alias("arguments"),
    )
    answers = messages.where(F.col("role") == "assistant")
    return calls, answers.select("conv_id", call(turn - 1).alias("call_id"), "turn", F.col("text").alias("content"))


def report(messages: DataFrame) -> DataFrame:
    calls, results = derived_calls(messages)
    return linked(calls, results, TOOLS)
