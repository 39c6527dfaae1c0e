"""Chat formatting: tool calls linked with their results, in DataFrame operations only.

A message is a row (conv_id, turn, role, text).  An assistant text that is a
JSON object with ``tool_calls`` makes calls: an array of objects with ``id``,
``name``, ``arguments`` (an object, or its JSON as a string) and, optionally,
``depends_on``, an array of ids of calls whose results it uses.  A text of role
``tool`` that is a JSON object with ``tool_call_id`` is a result.  All other
texts are plain content.

The result has one item per message, call and result, so that a conversation of
any length is spread over tasks:

* ``place`` and ``level`` order the items of a conversation topologically: by
  place, level, turn and item a call stands before its results, and results
  before the calls that depend on them.  Place is the latest turn of an item
  and all it depends on, level the length of its longest chain.
* ``status``: ``ok`` for messages and for linked results; calls are ``ok``,
  ``unanswered``, ``unknown_tool``, ``invalid_arguments`` or ``cyclic``; results
  without a call are ``orphan``.  The first call of an id counts; others of the
  same id are ``duplicate``.
* ``json`` is the item in canonical JSON: keys in order, no white space.

Null roles, texts and turns stay null in what is serialised (a null field is
left out); null conv_ids have items, but none is linked.  Repeated messages
make repeated items; their calls are duplicates of the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import shared_folder, written

#: Tools and their parameters: JSON type, and a question mark if it may be left out.
SCHEMAS = {
    "search": {"query": "string", "limit": "integer?"},
    "fetch": {"url": "string"},
    "calculate": {"expression": "string", "precision": "integer?"},
    "lookup": {"id": "integer", "fields": "array?"},
}
_CALLS = "array<struct<id string, name string, arguments string, depends_on array<string>>>"


def _kind(value: Column) -> Column:
    """The JSON type of a variant; null if it isn't there."""
    name = F.schema_of_variant(value)
    return (
        F.when(name == "BIGINT", "integer")
        .when(name == "STRING", "string")
        .when(name == "BOOLEAN", "boolean")
        .when(name.startswith("DECIMAL") | name.isin("DOUBLE", "FLOAT"), "number")
        .when(name.startswith("ARRAY"), "array")
        .when(name.startswith("OBJECT"), "object")
        .when(name.isNotNull(), "null")
    )


def valid_arguments(arguments: Column, name: Column, schemas: dict[str, dict[str, str]]) -> Column:
    """Whether a variant has all a tool's parameters, of the right types, and no others; null for an unknown tool."""
    is_object = _kind(arguments) == "object"
    keys = F.coalesce(F.json_object_keys(F.to_json(arguments)), F.array())
    out = F.lit(None).cast("boolean")
    for tool, parameters in schemas.items():
        checks = [is_object, F.size(F.array_except(keys, F.array(*map(F.lit, parameters)))) == 0]
        for p, wanted in parameters.items():
            found = _kind(F.try_variant_get(arguments, f"$.{p}", "variant"))
            kinds = ["integer", "number"] if wanted.rstrip("?") == "number" else [wanted.rstrip("?")]
            right = found.isin(*kinds)
            checks.append(found.isNull() | right if wanted.endswith("?") else F.coalesce(right, F.lit(False)))
        good = checks[0]
        for c in checks[1:]:
            good = good & c
        out = F.when(name == tool, F.coalesce(good, F.lit(False))).otherwise(out)
    return out


def _object(**fields: Column) -> Column:
    """Canonical JSON of an object given in the order of its keys; null fields are left out."""
    return F.to_json(F.struct(*(v.alias(k) for k, v in sorted(fields.items()))))


def format_chats(messages: DataFrame, schemas: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Items of all conversations: conv_id, turn, item, kind, role, call_id, name, place, level, status, json."""
    schemas = SCHEMAS if schemas is None else schemas
    shared_folder(messages.sparkSession)
    text = messages.select("conv_id", "turn", "role", "text").withColumn("parsed", F.when(F.col("text").rlike(r"^\s*\{"), F.try_parse_json("text")))
    is_object = F.coalesce(_kind(F.col("parsed")) == "object", F.lit(False))
    calls = F.when(is_object & (F.col("role") == "assistant"), F.from_json(F.get_json_object("text", "$.tool_calls"), _CALLS))
    result_of = F.when(is_object & (F.col("role") == "tool"), F.try_variant_get("parsed", "$.tool_call_id", "string"))
    read = text.withColumns({"calls": calls, "result_of": result_of})

    plain = read.filter(F.col("result_of").isNull()).select(
        "conv_id", "turn", F.lit(0).alias("item"), F.lit("message").alias("kind"), "role", F.lit(None).cast("string").alias("call_id"), F.lit(None).cast("string").alias("name"),
        F.col("turn").alias("place"), F.lit(0).alias("level"), F.lit("ok").alias("status"),
        F.when(F.col("calls").isNull(), _object(content=F.col("text"), role=F.col("role")))
        .otherwise(_object(content=F.try_variant_get("parsed", "$.content", "string"), role=F.col("role"), tool_calls=F.transform("calls", lambda c: c["id"]))).alias("json"),
    )
    # few messages have calls or results: they are kept, as they are joined several times
    made = read.filter("calls is not null").select("conv_id", "turn", "role", F.posexplode("calls").alias("no", "c"))
    arguments = F.try_parse_json(F.coalesce("c.arguments", F.lit("")))
    made = made.select(
        "conv_id", "turn", "role", (F.col("no") + 1).alias("item"), F.col("c.id").alias("call_id"), F.col("c.name").alias("name"),
        F.coalesce("c.depends_on", F.array()).alias("depends_on"), F.to_json(arguments).alias("arguments"), valid_arguments(arguments, F.col("c.name"), schemas).alias("valid"),
    )
    made = written(made, "calls")
    place = F.struct("turn", "item")
    first = made.filter("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id").agg(F.min(place).alias("first"))
    made = made.join(first, ["conv_id", "call_id"], "left").withColumn("duplicate", F.coalesce(place != F.col("first"), F.col("call_id").isNotNull() & F.col("conv_id").isNotNull()))
    results = written(
        read.filter("result_of is not null").select("conv_id", "turn", "role", F.col("result_of").alias("call_id"), F.to_json(F.try_variant_get("parsed", "$.content", "variant")).alias("content")), "results"
    )
    answered = results.select("conv_id", "call_id").distinct().withColumn("answered", F.lit(True))
    calls = written(made.join(answered, ["conv_id", "call_id"], "left"), "linked-calls")
    ordered = _levels(calls, results)
    calls = calls.join(ordered, ["conv_id", "call_id"], "left")
    status = (
        F.when(F.col("duplicate"), "duplicate")
        .when(F.col("cyclic"), "cyclic")
        .when(F.col("valid").isNull(), "unknown_tool")
        .when(~F.col("valid"), "invalid_arguments")
        .when(F.col("answered").isNull(), "unanswered")
        .otherwise("ok")
    )
    call_items = calls.select(
        "conv_id", "turn", "item", F.lit("call").alias("kind"), "role", "call_id", "name", F.greatest("turn", F.coalesce("place", "turn")).alias("place"), F.coalesce("level", F.lit(1)).alias("level"), status.alias("status"),
        # arguments are canonical JSON already, and null when they aren't JSON
        F.concat(F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(","), F.substring(_object(id=F.col("call_id"), name=F.col("name")), 2, 1_000_000_000)).alias("json"),
    )
    linked = results.join(ordered, ["conv_id", "call_id"], "left")
    result_items = linked.select(
        "conv_id", "turn", F.lit(0).alias("item"), F.lit("result").alias("kind"), "role", "call_id", F.lit(None).cast("string").alias("name"), F.greatest("turn", F.coalesce("place", "turn")).alias("place"),
        (F.coalesce("level", F.lit(0)) + 1).alias("level"), F.when(F.col("level").isNull(), "orphan").otherwise("ok").alias("status"),
        F.concat(F.lit('{"content":'), F.coalesce("content", F.lit("null")), F.lit(","), F.substring(_object(role=F.col("role"), tool_call_id=F.col("call_id")), 2, 1_000_000_000)).alias("json"),
    )
    return plain.unionByName(call_items).unionByName(result_items)


def _levels(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Place and level of the first call of each id; calls on a cycle, or behind one, are ``cyclic``.

    Calls whose calls are all placed are placed next, round by round; a round
    adds one link to the longest chain, and there are none without dependencies.
    """
    nodes = calls.filter("not duplicate and conv_id is not null and call_id is not null").select("conv_id", "call_id", "turn", "depends_on")
    nodes = nodes.groupBy("conv_id", "call_id").agg(F.min("turn").alias("turn"), F.first("depends_on").alias("depends_on"))
    edges = nodes.select("conv_id", "call_id", F.explode(F.array_distinct("depends_on")).alias("on"))
    known = nodes.select("conv_id", F.col("call_id").alias("on"))
    edges = written(edges.join(known, ["conv_id", "on"]), "dependencies")
    answers = results.groupBy("conv_id", F.col("call_id").alias("on")).agg(F.max("turn").alias("answer"))
    waiting = edges.select("conv_id", "call_id").distinct()
    placed = nodes.join(waiting, ["conv_id", "call_id"], "left_anti").select("conv_id", "call_id", F.col("turn").alias("place"), F.lit(1).alias("level"))
    if edges.isEmpty():
        return placed.withColumn("cyclic", F.lit(False))
    placed = placed.checkpoint()
    needed = edges.groupBy("conv_id", "call_id").agg(F.count("*").alias("needed"))
    while True:
        have = edges.join(placed.withColumnRenamed("call_id", "on"), ["conv_id", "on"]).join(answers, ["conv_id", "on"], "left")
        have = have.groupBy("conv_id", "call_id").agg(F.count("*").alias("have"), F.max(F.greatest("place", "answer")).alias("latest"), F.max("level").alias("below"))
        ready = have.join(needed, ["conv_id", "call_id"]).filter("have = needed").join(placed, ["conv_id", "call_id"], "left_anti").join(nodes, ["conv_id", "call_id"])
        ready = ready.select("conv_id", "call_id", F.greatest("turn", "latest").alias("place"), (F.col("below") + 2).cast("int").alias("level")).checkpoint()
        if ready.isEmpty():
            break
        placed = placed.unionByName(ready).checkpoint()
    rest = nodes.join(placed, ["conv_id", "call_id"], "left_anti").select("conv_id", "call_id", F.col("turn").alias("place"), F.lit(1).alias("level"), F.lit(True).alias("cyclic"))
    return placed.withColumn("cyclic", F.lit(False)).unionByName(rest)


#: For conversations without JSON objects as texts, which the given tables don't have.
SQL = """
SELECT conv_id, turn, 0 AS item, 'message' AS kind, role, NULL::VARCHAR AS call_id, NULL::VARCHAR AS name, turn AS place, 0 AS level, 'ok' AS status,
       CASE WHEN text IS NULL THEN json_object('role', role) WHEN role IS NULL THEN json_object('content', text) ELSE json_object('content', text, 'role', role) END::VARCHAR AS json
FROM conversations WHERE text IS NULL OR NOT regexp_matches(text, '^\\s*\\{')
"""
