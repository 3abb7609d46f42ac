"""Chat formatting: tool calls linked to their results, ordered, validated, serialised.

Calls and results are hash-joined by conversation and call identifier, put in an order in
which every result follows its call and every call the results it depends on, checked
against the tools' schemas and written as canonical JSON: sorted keys, no blanks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkingest.session import materialize

# Places between two turns of a conversation, for calls of one turn and for repairs.
TURN = 1 << 20
# Rows of the tool registry up to which it is broadcast.
BROADCAST_TOOLS = 100_000

_CALLS = (
    "struct<tool_calls:array<struct<id:string,name:string,arguments:variant,depends_on:array<string>,"
    "function:struct<name:string,arguments:variant>>>>"
)
_WHOLE_CALLS = "struct<tool_calls:array<variant>>"
_RESULT = "struct<tool_call_id:string,content:string>"

# JSON types of a schema and how Spark names the types of such values.
_TYPE_PATTERNS = {
    "string": "STRING",
    "integer": "(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\\(\\d+,0\\))",
    "number": "(TINYINT|SMALLINT|INT|BIGINT|DECIMAL.*|FLOAT|DOUBLE)",
    "boolean": "BOOLEAN",
    "array": "ARRAY<.*",
    "object": "OBJECT<.*",
    "null": "VOID",
}


def quoted(text: Column) -> Column:
    """A text as a JSON string; null as ``null``."""
    return F.coalesce(F.to_json(text.cast("variant")), F.lit("null"))


def canonical(value: Column) -> Column:
    """A JSON value with sorted keys and no blanks; null if the text is not JSON."""
    return F.to_json(value)


def _further(json: Column, known: list[str]) -> Column:
    """The fields of a JSON object that are not ``known``, as an object; null if none is left."""
    rest = F.map_filter(F.from_json(json, "map<string,variant>"), lambda k, v: ~k.isin(known))
    return F.when(F.size(rest) > 0, F.to_json(rest))


def _with_further(json: Column, further: Column) -> Column:
    """A canonical object with the fields of another one."""
    both = F.concat(
        F.substring(json, F.lit(1), F.length(json) - 1),
        F.lit(","),
        F.substring(further, F.lit(2), F.length(further)),
    )
    return F.when(further.isNull(), json).otherwise(canonical(F.parse_json(both)))


def _parsed(messages: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Messages with the calls or the result that their text holds.

    Only an assistant's text can hold calls and only a tool's text a result; any other text,
    and one that is not such JSON, is plain.
    """
    rows = messages.select(
        F.col(conversation).alias("conversation"),
        F.col(turn).cast("bigint").alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    )
    looks = F.col("text").rlike(r"^[\x20\t\r\n]*\{")
    assistant = (F.col("role") == "assistant") & looks
    tool = (F.col("role") == "tool") & looks
    parsed = rows.withColumn(
        "calls", F.when(assistant, F.from_json("text", _CALLS)["tool_calls"])
    ).withColumn("result", F.when(tool, F.from_json("text", _RESULT)))
    further = F.when(
        F.size("calls") > 0, _further(F.col("text"), ["tool_calls", "role"])
    ).when(
        F.col("result.tool_call_id").isNotNull(),
        _further(F.col("text"), ["tool_call_id", "content", "role"]),
    )
    whole = F.when(F.size("calls") > 0, F.from_json("text", _WHOLE_CALLS)["tool_calls"])
    return parsed.withColumn("further", further).withColumn("whole_calls", whole)


def _arguments() -> Column:
    """A call's arguments; those of the nested form may be JSON as a text."""
    nested = F.col("call.function.arguments")
    text = F.try_variant_get(nested, "$", "string")
    read = F.when(F.schema_of_variant(nested) == "STRING", F.try_parse_json(text))
    return F.coalesce("call.arguments", read, nested)


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``copy``, which counts equal rows from 1."""
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    return counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))).drop("n")


def _argument_errors(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """Adds ``errors``: unknown tools, missing and unexpected parameters, wrong types."""
    registry = tools.groupBy(F.col("name").alias("tool")).agg(
        F.map_from_entries(F.sort_array(F.collect_set(F.struct("param", "type")))).alias("types"),
        F.sort_array(F.collect_set(F.when(F.col("required"), F.col("param")))).alias("required"),
    )
    registry = materialize(registry, "chat-tools")
    if registry.count() <= BROADCAST_TOOLS:
        registry = F.broadcast(registry)
    given = F.map_entries(F.from_json(F.to_json("arguments"), "map<string,variant>"))
    typed = F.transform(
        given,
        lambda e: F.struct(e["key"].alias("key"), F.schema_of_variant(e["value"]).alias("type")),
    )

    def mismatch(entry: Column) -> Column:
        wanted = F.col("types")[entry["key"]]
        found = entry["type"]
        ok = F.lit(False)
        for name, pattern in _TYPE_PATTERNS.items():
            ok = ok | ((wanted == name) & found.rlike(f"^{pattern}$"))
        return wanted.isNotNull() & ~ok

    names = F.transform("typed", lambda e: e["key"])
    prefixed = lambda prefix, values: F.transform(values, lambda v: F.concat(F.lit(prefix), v))
    errors = F.concat(
        prefixed("missing:", F.array_except("required", names)),
        prefixed("unexpected:", F.array_except(names, F.map_keys("types"))),
        prefixed("type:", F.transform(F.filter("typed", mismatch), lambda e: e["key"])),
    )
    joined = calls.withColumn("typed", F.coalesce(typed, F.array().cast("array<struct<key:string,type:string>>")))
    return (
        joined.join(registry, F.col("name") == F.col("tool"), "left")
        .withColumn(
            "errors",
            F.when(F.col("tool").isNull(), F.array(F.lit("unknown_tool")))
            .when(
                F.coalesce(~F.schema_of_variant("arguments").startswith("OBJECT"), F.lit(True)),
                F.array(F.lit("arguments_not_an_object")),
            )
            .otherwise(errors),
        )
        .drop("tool", "types", "required", "typed")
    )


def _ordered(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, position, cycle``: positions that grow along every edge ``source -> target``.

    Nodes start at their place in the log. Where an edge runs backwards, its target moves
    behind its source, round by round; only targets of such edges move, so a log in order
    takes one look. A node that has moved more often than its conversation has nodes lies on
    or behind a cycle, is marked and stays, and so do those behind it.
    """
    current = materialize(nodes.select("node", "limit", "position", F.lit(0).cast("bigint").alias("moves")), "chat-order")
    stopped = F.col("moves") > F.col("limit")
    while True:
        source = current.select(
            F.col("node").alias("source"), F.col("position").alias("from"), stopped.alias("stuck")
        )
        late = (
            edges.join(source, "source")
            .groupBy(F.col("target").alias("node"))
            .agg(F.max("from").alias("from"), F.max("stuck").alias("stuck"))
        )
        moving = materialize(
            current.join(late, "node")
            .where(~stopped & (F.col("stuck") | (F.col("from") >= F.col("position"))))
            .select("node", "from", "stuck"),
            "chat-moves",
        )
        if moving.isEmpty():
            return current.select("node", "position", stopped.alias("cycle"))
        moved = F.greatest("position", F.col("from") + 1)
        moves = F.when(F.col("stuck"), F.col("limit") + 1).otherwise(
            F.col("moves") + F.col("from").isNotNull().cast("int")
        )
        current = materialize(
            current.join(moving, "node", "left").select(
                "node", "limit", moved.alias("position"), moves.cast("bigint").alias("moves")
            ),
            "chat-order",
        )


def link_tool_calls(
    messages: DataFrame,
    tools: DataFrame,
    conversation_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """One row per message, call and result: ``conversation, position, kind, call_id, status,
    errors, json``. Sorted by position, a conversation is in topological order.

    An assistant's text ``{"tool_calls": [{"id", "name", "arguments", "depends_on"}]}`` holds
    calls and a tool's text ``{"tool_call_id", "content"}`` a result; other texts are plain
    messages (status ``plain``), null and empty ones too, as is an empty list of calls. The
    nested form ``"function": {"name", "arguments"}`` is read too, with arguments as a text or
    an object. Blanks may precede the object. Further fields of calls and results stay in
    their JSON; what stands beside ``tool_calls``, as ``content``, becomes a message before
    the calls. A field ``role`` is that of the row. ``tools`` has a row for each parameter:
    ``name, param, type, required``.

    Calls are ``answered`` or ``unanswered``; of calls or results with one identifier in a
    conversation the first in the log counts and the others are ``duplicate`` (at one place,
    the least by content; of equal rows one); results
    without a call, or without an identifier, are ``orphan``. ``cycle`` marks what lies on or
    behind a cycle of dependencies; dependencies on unknown identifiers are ignored. Only
    first calls have ``errors``; the list is empty for valid arguments. Repeated rows are
    repeated messages. A null conversation is a conversation like any other; a null turn
    comes first. An empty table gives no rows. Other columns are not read. Rows are joined
    by conversation and identifier and never gathered by conversation, so one of any length
    may hold a third of all rows.
    """
    parsed = _parsed(messages, conversation_column, turn_column, role_column, text_column)
    start = F.coalesce(F.col("turn"), F.lit(-1)) * TURN
    has_calls = F.coalesce(F.size("calls") > 0, F.lit(False))
    plain = parsed.where(~has_calls & F.col("result.tool_call_id").isNull())
    beside = parsed.where(has_calls & F.col("further").isNotNull())
    calls = parsed.where(has_calls).select(
        "conversation",
        "turn",
        "whole_calls",
        F.posexplode("calls").alias("number", "call"),
    )
    calls = calls.select(
        "conversation",
        (start + 1 + F.col("number")).alias("place"),
        F.col("call.id").alias("call_id"),
        F.coalesce("call.name", "call.function.name").alias("name"),
        _arguments().alias("arguments"),
        F.coalesce("call.depends_on", F.array().cast("array<string>")).alias("depends_on"),
        _further(
            F.to_json(F.get("whole_calls", F.col("number"))),
            ["id", "name", "arguments", "depends_on", "function", "role"],
        ).alias("further"),
    )
    calls = materialize(
        _numbered(
            _argument_errors(calls, tools).select(
                "conversation", "place", "call_id", "name", "depends_on", "errors", "further",
                F.coalesce(canonical(F.col("arguments")), F.lit("null")).alias("arguments"),
            )
        ),
        "chat-calls",
    )
    results = materialize(
        _numbered(
            parsed.where(F.col("result.tool_call_id").isNotNull()).select(
                "conversation",
                start.alias("place"),
                F.col("result.tool_call_id").alias("call_id"),
                F.col("result.content").alias("content"),
                "further",
            )
        ),
        "chat-results",
    )

    # Conversations and identifiers as one text, so that nulls join as well.
    def node(kind: str) -> Column:
        return F.concat(
            F.lit(kind),
            F.to_json(F.struct(F.col("conversation").cast("string").alias("c"), F.col("call_id").alias("i"))),
        )

    this_call = F.struct("place", "name", "arguments", "depends_on", "further", "copy")
    this_result = F.struct("place", "content", "further", "copy")
    first_call = calls.groupBy(node("").alias("link")).agg(
        F.min(this_call).alias("first_call"),
        F.count("*").alias("n_calls"),
    )
    first_result = results.groupBy(node("").alias("link")).agg(
        F.min(this_result).alias("first_result")
    )
    linked = materialize(
        first_call.join(first_result, "link", "full_outer"), "chat-links"
    )
    per_conversation = (
        calls.select("conversation")
        .union(results.select("conversation"))
        .groupBy(F.col("conversation").cast("string").alias("conversation"))
        .agg(F.count("*").alias("limit"))
    )
    nodes = (
        linked.where("first_call IS NOT NULL")
        .select(
            F.concat(F.lit("call"), "link").alias("node"),
            F.get_json_object("link", "$.c").alias("conversation"),
            F.col("first_call.place").alias("position"),
        )
        .union(
            linked.where("first_call IS NOT NULL AND first_result IS NOT NULL").select(
                F.concat(F.lit("result"), "link"),
                F.get_json_object("link", "$.c"),
                F.col("first_result.place"),
            )
        )
        .join(
            per_conversation.withColumnRenamed("conversation", "of"),
            F.col("conversation").eqNullSafe(F.col("of")),
        )
    )
    answers = linked.where("first_call IS NOT NULL AND first_result IS NOT NULL").select(
        F.concat(F.lit("call"), "link").alias("source"),
        F.concat(F.lit("result"), "link").alias("target"),
    )
    needs = calls.select(
        node("call").alias("target"), "conversation", F.explode("depends_on").alias("call_id")
    ).select(node("result").alias("source"), "target")
    order = _ordered(nodes, materialize(answers.union(needs), "chat-edges"))

    state = linked.select(
        "link", "first_call", "first_result",
        F.col("first_call.place").alias("call_place"),
        F.col("first_result.place").alias("result_place"),
    )
    ranked_calls = (
        calls.withColumn("link", node(""))
        .join(state, "link")
        .withColumn("repeat", ~this_call.eqNullSafe(F.col("first_call")))
        .withColumn("node", F.concat(F.lit("call"), "link"))
        .join(order, "node", "left")
    )
    call_rows = ranked_calls.select(
        "conversation",
        F.when(F.col("repeat"), F.col("place")).otherwise(F.col("position")).alias("position"),
        F.lit("call").alias("kind"),
        "call_id",
        F.when(F.col("repeat"), "duplicate")
        .when(F.col("cycle"), "cycle")
        .when(F.col("result_place").isNull(), "unanswered")
        .otherwise("answered")
        .alias("status"),
        F.when(F.col("repeat"), F.array().cast("array<string>")).otherwise(F.col("errors")).alias("errors"),
        _with_further(
            F.concat(
                F.lit('{"arguments":'), F.col("arguments"),
                F.lit(',"depends_on":'), F.to_json(F.sort_array("depends_on")),
                F.lit(',"id":'), quoted(F.col("call_id")),
                F.lit(',"name":'), quoted(F.col("name")),
                F.lit(',"role":"assistant"}'),
            ),
            F.col("further"),
        ).alias("json"),
    )
    ranked_results = (
        results.withColumn("link", node(""))
        .join(state, "link")
        .withColumn("repeat", ~this_result.eqNullSafe(F.col("first_result")))
        .withColumn("node", F.concat(F.lit("result"), "link"))
        .join(order, "node", "left")
    )
    result_rows = ranked_results.select(
        "conversation",
        F.when(F.col("repeat") | F.col("position").isNull(), F.col("place"))
        .otherwise(F.col("position"))
        .alias("position"),
        F.lit("result").alias("kind"),
        "call_id",
        F.when(F.col("call_place").isNull(), "orphan")
        .when(F.col("repeat"), "duplicate")
        .when(F.col("cycle"), "cycle")
        .otherwise("answered")
        .alias("status"),
        F.array().cast("array<string>").alias("errors"),
        _with_further(
            F.concat(
                F.lit('{"content":'), quoted(F.col("content")),
                F.lit(',"role":"tool","tool_call_id":'), quoted(F.col("call_id")),
                F.lit("}"),
            ),
            F.col("further"),
        ).alias("json"),
    )
    message_rows = plain.select(
        "conversation",
        start.alias("position"),
        F.lit("message").alias("kind"),
        F.lit(None).cast("string").alias("call_id"),
        F.when(
            (F.col("role") == "tool") & F.col("result").isNotNull(), "orphan"
        ).otherwise("plain").alias("status"),
        F.array().cast("array<string>").alias("errors"),
        F.concat(
            F.lit('{"content":'), quoted(F.col("text")),
            F.lit(',"role":'), quoted(F.col("role")),
            F.lit("}"),
        ).alias("json"),
    )
    beside_rows = beside.select(
        "conversation",
        start.alias("position"),
        F.lit("message").alias("kind"),
        F.lit(None).cast("string").alias("call_id"),
        F.lit("plain").alias("status"),
        F.array().cast("array<string>").alias("errors"),
        _with_further(F.lit('{"role":"assistant"}'), F.col("further")).alias("json"),
    )
    return (
        message_rows.unionByName(beside_rows)
        .unionByName(call_rows)
        .unionByName(result_rows)
        .withColumnRenamed("conversation", conversation_column)
    )
