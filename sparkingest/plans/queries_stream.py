"""Structured Streaming over files landed from the events table.

Every stream runs with ``availableNow``: it drains what is there and stops. Running it
again after more files landed continues from its checkpoint, as a long-lived query would.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sparkingest.config import Audit, Connection, Metadata, Quarantine, SourceSpec, Storage
from sparkingest.operators import audit as audit_table
from sparkingest.operators import bronze
from sparkingest.operators.quality import CODES, Range
from sparkingest.plans.catalog import cents, ddl, prepared, query, sql_cents, table
from sparkingest.streaming.ingest import (
    dedupe_stream,
    ingest_stream,
    json_messages,
    late_records,
    sessions,
    throughput,
    write_files,
)

MESSAGE = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, cents BIGINT"
_DRAIN = {"availableNow": True}
_TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_TS_SQL = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"


def _messages(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        cents("value").alias("cents"),
    )


def _land(messages, path):
    """Append messages to the inbox as JSON lines, with microseconds."""
    messages.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")).write.mode(
        "append"
    ).json(path)


@query(
    "stream_ingest",
    f"""SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'events-0' ELSE 'events-1' END AS run_id,
               CASE WHEN {sql_cents('value')} > 10000 THEN 'RANGE_VIOLATION' ELSE '' END AS codes,
               event_id, user_id, {_TS_SQL} AS ts, {sql_cents('value')} AS cents
        FROM events""",
)
def stream_ingest(spark, sf_dir):
    """Two micro-batches become two audited runs; flagged messages go to quarantine."""

    def run(root):
        spec = SourceSpec(
            metadata=Metadata("events", "events"),
            connection=Connection("stream"),
            storage=Storage(f"{root}/bronze"),
            audit=Audit(f"{root}/audit"),
            quarantine=Quarantine(f"{root}/quarantine"),
        )
        messages = _messages(spark, sf_dir)
        first_half = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
        for part in (messages.where(first_half), messages.where(~first_half)):
            _land(part, f"{root}/inbox")
            ingest_stream(
                json_messages(spark, f"{root}/inbox", ddl(MESSAGE)),
                spec,
                "events",
                f"{root}/checkpoint",
                rules=[Range("cents", 0, 10_000)],
                trigger=_DRAIN,
                clock=lambda: dt.datetime(2024, 3, 1),
            ).awaitTermination()
        return spec

    spec = prepared(spark, sf_dir, "stream-ingest", run)
    audit = audit_table.read_audit(spark, spec.audit.path)
    clean = bronze.read_bronze(spark, spec.storage.path, audit, ddl(MESSAGE))
    held = bronze.read_quarantine(spark, spec.quarantine.path, ddl(MESSAGE), audit)
    columns = [
        F.col("_run_id").alias("run_id"),
        "codes",
        "event_id",
        "user_id",
        F.date_format("ts", _TS).alias("ts"),
        "cents",
    ]
    return (
        clean.withColumn("codes", F.lit(""))
        .select(*columns)
        .unionByName(held.withColumn("codes", F.concat_ws(",", CODES)).select(*columns))
    )


@query(
    "stream_dedupe",
    f"""SELECT event_id, user_id, event_type, {_TS_SQL} AS ts FROM events
        UNION ALL SELECT -1, 0, 'heartbeat', '2024-01-15 12:00:00.000000'""",
)
def stream_dedupe(spark, sf_dir):
    """Every third message arrives twice, and copies of one heartbeat make up a third of the
    feed; the copies are spread over two micro-batches."""

    def run(root):
        messages = _messages(spark, sf_dir)
        repeated = messages.where("event_id % 3 = 0")
        flood = messages.where("event_id % 3 <> 0").select(
            F.lit(-1).cast("bigint").alias("event_id"),
            F.lit("2024-01-15 12:00:00").cast("timestamp").alias("ts"),
            F.lit(0).cast("bigint").alias("user_id"),
            F.lit("heartbeat").alias("event_type"),
            F.lit(0).cast("bigint").alias("cents"),
        )
        for part in (messages.unionByName(flood), repeated.unionByName(flood)):
            _land(part, f"{root}/inbox")
            stream = json_messages(spark, f"{root}/inbox", ddl(MESSAGE))
            write_files(
                dedupe_stream(stream, ["event_id", "ts"], "ts", "40 days"),
                f"{root}/accepted",
                f"{root}/checkpoint",
                _DRAIN,
            ).awaitTermination()

    root = prepared(spark, sf_dir, "stream-dedupe", run)
    accepted = spark.read.schema(ddl(MESSAGE)).parquet(f"{root}/accepted")
    return accepted.select(
        "event_id", "user_id", "event_type", F.date_format("ts", _TS).alias("ts")
    )


@query(
    "stream_late",
    f"""SELECT CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN 'accepted'
                    WHEN ts >= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 25 DAY
                                FROM events) THEN 'accepted'
                    ELSE 'LATE_RECORD' END AS outcome,
               event_id, user_id FROM events""",
)
def stream_late(spark, sf_dir):
    """Days from the 11th on arrive first, the earlier ones second. With 25 days of
    patience those behind the watermark are late; they are found again and classified."""

    def run(root):
        messages = _messages(spark, sf_dir)
        on_time = F.col("ts") >= F.lit("2024-01-11").cast("timestamp")
        for part in (messages.where(on_time), messages.where(~on_time)):
            _land(part, f"{root}/inbox")
            stream = json_messages(spark, f"{root}/inbox", ddl(MESSAGE))
            write_files(
                dedupe_stream(stream, ["event_id", "ts"], "ts", "25 days"),
                f"{root}/accepted",
                f"{root}/checkpoint",
                _DRAIN,
            ).awaitTermination()

    root = prepared(spark, sf_dir, "stream-late", run)
    accepted = spark.read.schema(ddl(MESSAGE)).parquet(f"{root}/accepted")
    raw = spark.read.schema(ddl(MESSAGE)).json(f"{root}/inbox")
    late = late_records(raw, accepted, ["event_id", "ts"])
    return accepted.select(F.lit("accepted").alias("outcome"), "event_id", "user_id").unionByName(
        late.select(F.concat_ws(",", CODES).alias("outcome"), "event_id", "user_id")
    )


@query(
    "stream_throughput",
    """SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS events,
              CAST(count(*) AS DOUBLE) / 3600 AS events_per_second
       FROM (SELECT date_trunc('hour', ts) AS w FROM events) GROUP BY w
       HAVING w + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)""",
)
def stream_throughput(spark, sf_dir):
    """Hourly windows, emitted when the watermark closes them; the last hours stay open."""

    def run(root):
        _land(_messages(spark, sf_dir), f"{root}/inbox")
        write_files(
            throughput(
                json_messages(spark, f"{root}/inbox", ddl(MESSAGE)), "ts", "2 hours", "1 hour"
            ),
            f"{root}/windows",
            f"{root}/checkpoint",
            _DRAIN,
        ).awaitTermination()

    root = prepared(spark, sf_dir, "stream-throughput", run)
    windows = spark.read.parquet(f"{root}/windows")
    return windows.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "events",
        "events_per_second",
    )


def _drain_with_end(spark, sf_dir, root, aggregate):
    """All messages in two batches, then a punctuation a year later, each drained by the same
    query over ``aggregate``."""
    messages = _messages(spark, sf_dir)
    first_half = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    end = messages.limit(0).unionByName(
        spark.range(1).select(F.lit("2025-02-01").cast("timestamp").alias("ts")), allowMissingColumns=True
    )
    for part in (messages.where(first_half), messages.where(~first_half), end):
        _land(part, f"{root}/inbox")
        stream = json_messages(spark, f"{root}/inbox", ddl(MESSAGE))
        write_files(aggregate(stream), f"{root}/out", f"{root}/checkpoint", _DRAIN).awaitTermination()


@query(
    "stream_windows_closed",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS events,
              CAST(count(*) AS DOUBLE) / 3600 AS events_per_second
       FROM events GROUP BY 1""",
)
def stream_windows_closed(spark, sf_dir):
    """Every hourly window, the last ones too: the end of the feed is punctuated."""
    message = F.col("event_id").isNotNull()

    def run(root):
        _drain_with_end(
            spark,
            sf_dir,
            root,
            lambda stream: throughput(stream, "ts", "2 hours", "1 hour", message=message),
        )

    windows = spark.read.parquet(f"{prepared(spark, sf_dir, 'stream-closed', run)}/out")
    return windows.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "events",
        "events_per_second",
    )


@query(
    "stream_sessions",
    """WITH marked AS (
         SELECT user_id, ts,
                coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 6 HOUR, true) AS opens
         FROM events),
       numbered AS (
         SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM marked)
       SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start,
              strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_event, count(*) AS events
       FROM numbered GROUP BY user_id, n""",
)
def stream_sessions(spark, sf_dir):
    """Sessions of each user with silences of six hours at most, over batches, all closed."""

    def run(root):
        _drain_with_end(
            spark,
            sf_dir,
            root,
            lambda stream: sessions(
                stream, "ts", "2 hours", "user_id", "6 hours", message=F.col("event_id").isNotNull()
            ),
        )

    found = spark.read.parquet(f"{prepared(spark, sf_dir, 'stream-sessions', run)}/out")
    return found.select(
        "user_id",
        F.date_format("session_start", _TS).alias("session_start"),
        F.date_format("last_event", _TS).alias("last_event"),
        "events",
    )


@query(
    "stream_late_quarantine",
    f"""SELECT CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN ''
                    WHEN ts >= (SELECT max(ts) - INTERVAL 25 DAY FROM events
                                WHERE ts >= TIMESTAMP '2024-01-11') THEN ''
                    ELSE 'LATE_RECORD' END AS codes,
               event_id, user_id, {_TS_SQL} AS ts FROM events""",
)
def stream_late_quarantine(spark, sf_dir):
    """As ``stream_late``, but late rows are told from the others in the batch that brings
    them, and lie in the quarantine of its run; the second batch is delivered twice."""

    def run(root):
        spec = SourceSpec(
            metadata=Metadata("events", "events"),
            connection=Connection("stream"),
            storage=Storage(f"{root}/bronze"),
            audit=Audit(f"{root}/audit"),
            quarantine=Quarantine(f"{root}/quarantine"),
        )
        messages = _messages(spark, sf_dir)
        on_time = F.col("ts") >= F.lit("2024-01-11").cast("timestamp")
        for part in (messages.where(on_time), messages.where(~on_time)):
            _land(part, f"{root}/inbox")
            for _ in range(2):
                ingest_stream(
                    json_messages(spark, f"{root}/inbox", ddl(MESSAGE)),
                    spec,
                    "events",
                    f"{root}/checkpoint",
                    trigger=_DRAIN,
                    clock=lambda: dt.datetime(2024, 3, 1),
                    event_time="ts",
                    delay=dt.timedelta(days=25),
                ).awaitTermination()
        return spec

    spec = prepared(spark, sf_dir, "stream-late-held", run)
    audit = audit_table.read_audit(spark, spec.audit.path)
    clean = bronze.read_bronze(spark, spec.storage.path, audit, ddl(MESSAGE))
    held = bronze.read_quarantine(spark, spec.quarantine.path, ddl(MESSAGE), audit)
    columns = ["codes", "event_id", "user_id", F.date_format("ts", _TS).alias("ts")]
    return (
        clean.withColumn("codes", F.lit(""))
        .select(*columns)
        .unionByName(held.withColumn("codes", F.concat_ws(",", CODES)).select(*columns))
    )
