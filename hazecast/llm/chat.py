"""Chat formatting: tool calls linked to their results, put in order, checked and serialised.

Calls and results are hash-joined by conversation and identifier. Calls that refer to other calls
come after these: their depth is found level by level, all conversations at once. Arguments are
checked against the tools' schemas, and every message, call and result becomes one line of
canonical JSON (keys in order, no blanks). A line's place is (turn, step), so that no conversation,
however long, has to be gathered to be ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazecast.session import new_folder, stored

RANK = "_rank"

#: Kinds of JSON values by the type that a variant reports.
KINDS = {
    "string": ["STRING"],
    "integer": ["BIGINT"],
    "number": ["BIGINT", "DOUBLE", "DECIMAL"],
    "boolean": ["BOOLEAN"],
    "array": ["ARRAY"],
    "object": ["OBJECT"],
}


def canonical(json: Column) -> Column:
    """JSON text with sorted keys and no blanks; null if it isn't JSON or names a key twice."""
    return F.to_json(F.try_parse_json(json))


def problem(name: Column, arguments: Column, schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """What is wrong with a call, or null. ``schemas``: tool -> argument -> (kind, required)."""
    value = F.try_parse_json(arguments)
    found = F.lit("unknown tool")
    for tool, fields in sorted(schemas.items()):
        wrong = []
        for field, (kind, required) in sorted(fields.items()):
            own = F.schema_of_variant(F.try_variant_get(value, f"$['{field}']", "variant"))
            right = F.regexp_extract(own, r"^\w+", 0).isin(KINDS[kind])
            absent = own.isNull() | (own == "VOID")
            wrong.append(F.when(absent, F.lit(f"missing {field}") if required else F.lit(None)).when(~right, F.lit(f"{field} is no {kind}")))
        known = F.array(*[F.lit(f) for f in sorted(fields)]).cast("array<string>")
        keys = F.json_object_keys(arguments)
        extra = F.exists(keys, lambda k: ~F.array_contains(known, k))
        shape = F.when(value.isNull() | keys.isNull(), "not a JSON object").when(extra, "unknown argument")
        found = F.when(name == tool, F.coalesce(shape, *wrong)).otherwise(found)
    return F.when(name.isNull(), "no tool").otherwise(found)


def depths(calls: DataFrame, links: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth, at): depth is 0 for calls that wait for none, else one more than the
    deepest call they wait for; ``at`` is the latest turn among a call's own and those of all it waits
    for. ``links`` has (conv_id, call_id, after); what refers to calls that don't exist or to
    itself is left out. Calls in a circle, or behind one, have null depth.
    """
    key = ["conv_id", "call_id"]
    known = calls.select(F.col("conv_id"), F.col("call_id").alias("after"))
    links = links.where("call_id <> after").join(known, ["conv_id", "after"]).distinct()
    links = stored(links, "waits")
    turns = calls.select(*key, F.col("turn").alias("at"))
    waiting = stored(links.groupBy(*key).agg(F.count("*").alias("waits")).join(turns, key), "waiting")
    spark, found = calls.sparkSession, new_folder(calls.sparkSession, "depths")
    turns.join(waiting, key, "left_anti").select(*key, F.lit(0).alias("depth"), "at").write.parquet(found)
    last, level = spark.read.parquet(found), 0
    while not waiting.isEmpty() and not last.isEmpty():
        # only calls that still wait are looked at again
        level += 1
        met = links.join(last.select("conv_id", F.col("call_id").alias("after"), "at"), ["conv_id", "after"])
        met = met.groupBy(*key).agg(F.count("*").alias("met"), F.max("at").alias("latest"))
        left = F.col("waits") - F.coalesce("met", F.lit(0))
        latest = F.greatest("at", "latest").alias("at")  # of those that aren't null
        step = stored(waiting.join(met, key, "left").select(*key, left.alias("waits"), latest), "waiting")
        last, waiting = step.where("waits = 0"), step.where("waits > 0")
        last.select(*key, F.lit(level).alias("depth"), "at").write.mode("append").parquet(found)
    waiting.select(*key, F.lit(None).cast("int").alias("depth"), "at").write.mode("append").parquet(found)
    return spark.read.parquet(found)


def _json(**fields: Column) -> Column:
    struct = F.struct(*[v.alias(k) for k, v in sorted(fields.items())])
    return F.to_json(struct, {"ignoreNullFields": "false"})


def _ranked(df: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Different rows, numbered within their key."""
    order = Window.partitionBy(*key).orderBy(*values)
    return df.select(*key, *values).distinct().withColumn(RANK, F.row_number().over(order))


def formatted(
    messages: DataFrame,
    calls: DataFrame,
    results: DataFrame,
    schemas: dict[str, dict[str, tuple[str, bool]]],
    after: str = "after",
) -> DataFrame:
    """Lines (conv_id, turn, step, kind, call_id, status, line) of all conversations.

    ``messages``: conv_id, turn, role, text. ``calls``: conv_id, turn, call_id, name, arguments
    (JSON text; the array under ``after`` names calls to wait for). ``results``: conv_id, call_id,
    content. Step 0 is the message of a turn; a call has 1 + 2 * depth, its result the next. A call that
    waits for one of a later turn stands in that turn, with its result, so (turn, step) is an order in
    which everything comes after what it waits for; a null turn counts as earlier than any other.

    Status: ``ok``; ``no result`` or ``no call`` where the other half is missing (a result without
    call has neither turn nor step); ``circle`` for calls that wait for themselves in the end (no
    step); else what is wrong with the arguments, which are then given as the text they are.
    Calls or results without conversation or identifier are not linked to anything and count as
    missing their other half. Fully equal calls or results of one identifier are one. Of those
    that differ the smallest (turn first) is linked; every other has its own line: a
    ``duplicate call`` in its own turn, at the step of the linked one, and a ``duplicate result`` beside
    the linked one. Results carry no turn, so those of an identifier used again all stand with its
    first call. Messages all stay, repeated ones too; empty tables give no lines.
    """
    key = ["conv_id", "call_id"]
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    told = stored(_ranked(calls.where(named), key, ["turn", "name", "arguments"]), "calls")
    one = told.where(F.col(RANK) == 1)
    waits = F.from_json(F.get_json_object("arguments", f"$.{after}"), "array<string>")
    placed = told.join(depths(one, one.select(*key, F.explode(waits).alias("after"))), key)
    answers = _ranked(results.where(named), key, ["content"]).withColumn("answered", F.lit(True))
    answers = answers.withColumnsRenamed({"conv_id": "_c", "call_id": "_i", RANK: "_r"})
    # the first call meets all results of its identifier; the later calls meet none
    same = (F.col("conv_id") == F.col("_c")) & (F.col("call_id") == F.col("_i")) & (F.col(RANK) == 1)
    linked = placed.join(answers, same, "full")
    wrong = problem(F.col("name"), F.col("arguments"), schemas)
    is_call = F.col("call_id").isNotNull()
    status = (
        F.when(~is_call, "no call")
        .when(F.col(RANK) > 1, "duplicate call")
        .when(F.col("depth").isNull(), "circle")
        .when(wrong.isNotNull(), wrong)
        .when(F.col("answered").isNull(), "no result")
        .otherwise("ok")
    )
    answer_status = F.when(is_call & (F.col("_r") > 1), "duplicate result").otherwise(status)
    call_line = _json(role=F.lit("assistant"), id=F.col("call_id"), name=F.col("name"), arguments=F.coalesce(canonical(F.col("arguments")), F.col("arguments")))
    result_line = _json(role=F.lit("tool"), id=F.coalesce("call_id", "_i"), content=F.col("content"))
    lines = F.array_compact(
        F.array(
            F.when(is_call & (F.coalesce("_r", F.lit(1)) == 1), F.struct(status.alias("status"), (1 + 2 * F.col("depth")).alias("step"), F.lit("call").alias("kind"), call_line.alias("line"))),
            F.when(
                F.col("answered"),
                F.struct(answer_status.alias("status"), (2 + 2 * F.col("depth")).alias("step"), F.lit("result").alias("kind"), result_line.alias("line")),
            ),
        )
    )
    turn = F.when((F.col(RANK) == 1) & F.col("depth").isNotNull(), F.col("at")).otherwise(F.col("turn"))
    tools = linked.select(
        F.coalesce("conv_id", "_c").alias("conv_id"), turn.alias("turn"), F.coalesce("call_id", "_i").alias("call_id"), F.explode(lines).alias("l")
    ).select("conv_id", "turn", "l.step", "l.kind", "call_id", "l.status", "l.line")
    loose_calls = calls.where(~named).select(
        "conv_id", "turn", F.lit(1).alias("step"), F.lit("call").alias("kind"), "call_id", F.lit("no result").alias("status"),
        _json(role=F.lit("assistant"), id=F.col("call_id"), name=F.col("name"), arguments=F.coalesce(canonical(F.col("arguments")), F.col("arguments"))).alias("line"),
    )
    loose_results = results.where(~named).select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("int").alias("step"), F.lit("result").alias("kind"), "call_id",
        F.lit("no call").alias("status"), _json(role=F.lit("tool"), id=F.col("call_id"), content=F.col("content")).alias("line"),
    )
    said = messages.select(
        "conv_id", "turn", F.lit(0).alias("step"), F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"),
        F.lit("ok").alias("status"), _json(role=F.col("role"), content=F.col("text")).alias("line"),
    )
    return said.unionByName(tools).unionByName(loose_calls).unionByName(loose_results)
