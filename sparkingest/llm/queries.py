"""Registered queries of the numbered operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkingest.llm import (
    chat,
    conversations,
    decontaminate,
    exact_dedup,
    languages,
    mixing,
    near_dedup,
    passages,
    quality,
    runs,
    secrets,
    sharding,
    tokens,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_token_counts")
def op1_token_counts(spark, sf_dir):
    path = str(public_tokenizers.path(tokens.VOCABULARY))
    return tokens.token_counts(table(spark, sf_dir, "documents"), path)


@query("op2_mixing")
def op2_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_near_dedup")
def op3_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_decontamination")
def op4_decontamination(spark, sf_dir):
    return decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


_NORMALISED = "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')"


@query(
    "op5_exact_dedup",
    f"""
    SELECT doc_id,
           first_value(doc_id) OVER best AS keep_id,
           count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER best = 1 AS kept,
           sha256(norm) AS text_sha256
    FROM (SELECT doc_id, length(coalesce(text, '')) AS n, {_NORMALISED} AS norm FROM documents)
    WINDOW best AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST)""",
)
def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query("op6_quality")
def op6_quality(spark, sf_dir):
    return quality.score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query("op7_sharding")
def op7_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query("op8_secret_scan")
def op8_secret_scan(spark, sf_dir):
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


@query("op9_passages")
def op9_passages(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def tool_log(conversations: DataFrame) -> DataFrame:
    """The conversations as a log of tool calls: each user's text is the argument of a call,
    the assistant's next text its result, and a call depends on the one before it."""
    name = F.concat(F.lit("call-"), F.col("conv_id"), F.lit("-"))
    call = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    F.concat(name, F.col("turn")).alias("id"),
                    F.lit("reply").alias("name"),
                    F.struct(F.col("turn"), F.col("text").alias("prompt")).alias("arguments"),
                    F.array(F.concat(name, F.col("turn") - 2)).alias("depends_on"),
                )
            ).alias("tool_calls")
        )
    )
    result = F.to_json(
        F.struct(
            F.concat(name, F.col("turn") - 1).alias("tool_call_id"), F.col("text").alias("content")
        )
    )
    return conversations.select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", "assistant")
        .when(F.col("role") == "assistant", "tool")
        .otherwise(F.col("role"))
        .alias("role"),
        F.when(F.col("role") == "user", call)
        .when(F.col("role") == "assistant", result)
        .otherwise(F.col("text"))
        .alias("text"),
    )


_TOOLS = "VALUES ('reply', 'prompt', 'string', true), ('reply', 'turn', 'integer', true) AS t(name, param, type, required)"
_PLACE = "turn * 1048576"


@query(
    "op10_tool_calls",
    f"""
    WITH log AS (
      SELECT conv_id, turn, role, text,
             'call-' || conv_id || '-' || (turn - CAST(role = 'assistant' AS INT)) AS id
      FROM conversations),
    calls AS (SELECT * FROM log WHERE role = 'user'),
    results AS (SELECT * FROM log WHERE role = 'assistant')
    SELECT conv_id, {_PLACE} AS position, 'message' AS kind, NULL AS call_id, 'plain' AS status,
           '' AS errors,
           '{{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":' || CAST(to_json(role) AS VARCHAR) || '}}' AS json
    FROM log WHERE role NOT IN ('user', 'assistant')
    UNION ALL
    SELECT c.conv_id, c.turn * 1048576 + 1, 'call', c.id,
           CASE WHEN r.id IS NULL THEN 'unanswered' ELSE 'answered' END, '',
           '{{"arguments":{{"prompt":' || CAST(to_json(c.text) AS VARCHAR) || ',"turn":' || c.turn
             || '}},"depends_on":["call-' || c.conv_id || '-' || (c.turn - 2) || '"],"id":"' || c.id
             || '","name":"reply","role":"assistant"}}'
    FROM calls c LEFT JOIN results r USING (id)
    UNION ALL
    SELECT r.conv_id, r.turn * 1048576, 'result', r.id,
           CASE WHEN c.id IS NULL THEN 'orphan' ELSE 'answered' END, '',
           '{{"content":' || CAST(to_json(r.text) AS VARCHAR) || ',"role":"tool","tool_call_id":"' || r.id || '"}}'
    FROM results r LEFT JOIN calls c USING (id)""",
)
def op10_tool_calls(spark, sf_dir):
    tools = spark.sql(f"SELECT * FROM {_TOOLS}")
    linked = chat.link_tool_calls(tool_log(table(spark, sf_dir, "conversations")), tools)
    return linked.withColumn("errors", F.array_join("errors", ","))


def _crc32(text: str) -> str:
    """The unsigned checksum of an ASCII text, bit by bit."""
    return f"""xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)),
      lambda crc, byte: list_reduce(
        list_concat([xor(crc, byte)], list_transform(range(8), lambda i: 0::BIGINT)),
        lambda x, ignored: xor(x >> 1, 3988292384 * (x & 1)))))"""


_WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


@query(
    "op11_periodic_runs",
    f"""
    WITH source AS MATERIALIZED (
      SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words, {_crc32("doc_id::VARCHAR")} AS h
      FROM documents),
    planned AS (
      SELECT *, len(words) AS n, h // 10 AS g,
             CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a
      FROM source),
    planted AS MATERIALIZED (
      SELECT r, doc_id,
             CASE WHEN a IS NULL THEN words
                  ELSE list_transform(range(n), lambda i: CASE WHEN i < a THEN words[i + 1]
                         ELSE words[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) END AS words
      FROM planned),
    places AS MATERIALIZED (
      SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i FROM planted),
    equal AS (
      SELECT x.r, y.i - x.i AS q, x.i,
             x.i - row_number() OVER (PARTITION BY x.r, y.i - x.i ORDER BY x.i) AS stretch
      FROM places x JOIN places y ON x.r = y.r AND x.word = y.word AND x.i < y.i),
    stretches AS (
      SELECT r, min(i) AS start, count(*) + q AS length, q
      FROM equal GROUP BY r, q, stretch HAVING count(*) >= q AND count(*) + q >= 12),
    runs AS MATERIALIZED (
      SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length),
    dropped AS (
      SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
    kept AS (
      SELECT r, string_agg(word, ' ' ORDER BY i) AS line
      FROM places ANTI JOIN dropped USING (r, i) GROUP BY r),
    summary AS (
      SELECT r, count(*) AS n_runs,
             arg_max({{'s': start, 'l': length, 'p': period}}, (length, -start, -period)) AS best,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
      FROM runs GROUP BY r)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period,
           1000 * best.l // best.p AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
           sha256(coalesce(line, '')) AS collapsed_sha256
    FROM planted LEFT JOIN summary USING (r) LEFT JOIN kept USING (r)""",
)
def op11_periodic_runs(spark, sf_dir):
    return runs.run_digests(runs.periodic_runs(runs.planted(table(spark, sf_dir, "documents"))))


@query("op12_language_id")
def op12_language_id(spark, sf_dir):
    return languages.predict_languages(table(spark, sf_dir, "documents")).drop("mixture")


# The states of the repair: 1 nothing yet, 2 after a system turn, 3 a user's, 4 an assistant's.
# ``v`` holds the least cost and audit from each state on; edits are put before them.
_TURN = "[3, 3, 4, 3]"


def _edit(state: str, price: str, letter: str) -> str:
    return f"{{'c': v[{state}].c + {price}, 'a': '{letter}' || v[{state}].a}}"


_INSERT = f"list_transform([1, 2, 3, 4], lambda i: list_min([v[i], {_edit(_TURN + '[i]', '5', 'I')}]))"
_KEPT = "CASE WHEN initial = 's' AND i = 1 THEN 2 WHEN initial = 'u' AND i <> 3 THEN 3 WHEN initial = 'a' AND i = 3 THEN 4 END"
_STEP = f"""list_transform([1, 2, 3, 4], lambda i: list_min([
  {_edit('i', '2', 'D')},
  CASE WHEN NOT lost THEN {_edit(_TURN + '[i]', '(extra + 1)', 'R')} END,
  CASE WHEN NOT lost AND {_KEPT} IS NOT NULL THEN {_edit(_KEPT, 'extra', 'K')} END]))"""
_TOLD = "regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')"
_FATE = _crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")


@query(
    "op13_conversation_repair",
    f"""
    WITH RECURSIVE fates AS MATERIALIZED (
      SELECT coalesce('=' || conv_id, '') AS conv, turn, {_FATE} % 20 AS fate,
             coalesce(role, ' ') AS role, coalesce(text, ' ') AS text
      FROM conversations),
    damaged AS (
      SELECT conv, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
             CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
      FROM fates),
    ordered AS (
      SELECT conv, turn, role, text, left(role, 1) AS initial, {_TOLD} AS told,
             row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS n,
             row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) AS nth
      FROM damaged),
    rows AS MATERIALIZED (
      SELECT *, CASE WHEN told = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                     WHEN right(told, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
             lag(initial) OVER (PARTITION BY conv ORDER BY n) || initial AS pair
      FROM ordered),
    counts AS (
      SELECT conv, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM rows GROUP BY conv),
    back AS (
      SELECT conv, n, [{{'c': 0, 'a': ''}}, {{'c': 10, 'a': 'II'}}, {{'c': 5, 'a': 'I'}}, {{'c': 0, 'a': ''}}] AS v
      FROM counts
      UNION ALL
      SELECT conv, n - 1, {_INSERT} FROM (SELECT conv, n, {_INSERT} AS v FROM (
        SELECT conv, n, {_INSERT} AS v FROM (
          SELECT conv, n, {_STEP} AS v
          FROM (SELECT b.conv, b.n, v, initial, fault IN ('blank', 'duplicate') AS lost,
                       CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra
                FROM back b JOIN rows r ON b.conv = r.conv AND b.n = r.n))))),
    best AS (SELECT conv, v[1].c AS cost, v[1].a AS audit FROM back WHERE n = 0),
    path AS (
      SELECT conv, audit, 0 AS step, 0::BIGINT AS n, 1 AS state, '' AS letter, '' AS initial FROM best
      UNION ALL
      SELECT conv, audit, step, n, CASE WHEN letter = 'D' THEN state
                                      WHEN letter <> 'K' THEN {_TURN}[state]
                                      ELSE CASE initial WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END END,
             letter, initial
      FROM (SELECT p.conv, audit, p.step + 1 AS step, state, audit[p.step + 1] AS letter,
                   p.n + CASE WHEN audit[p.step + 1] = 'I' THEN 0 ELSE 1 END AS n, r.initial
            FROM path p LEFT JOIN rows r ON p.conv = r.conv AND r.n = p.n + 1
            WHERE p.step < length(audit))),
    repaired AS (
      SELECT p.conv, string_agg(
               CASE WHEN letter = 'K' THEN r.role WHEN state = 3 THEN 'user' ELSE 'assistant' END || ':' ||
               CASE WHEN letter = 'I' THEN '' ELSE r.text END, chr(10) ORDER BY step) AS lines
      FROM path p LEFT JOIN rows r ON p.conv = r.conv AND p.n = r.n
      WHERE step > 0 AND letter <> 'D' GROUP BY p.conv)
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
           coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
           sha256(coalesce(lines, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS conv FROM conversations) o
    LEFT JOIN counts USING (conv) LEFT JOIN best USING (conv) LEFT JOIN repaired USING (conv)""",
)
def op13_conversation_repair(spark, sf_dir):
    return conversations.repair_digests(
        conversations.damaged(table(spark, sf_dir, "conversations"))
    )
