"""Structured Streaming: raw ingest per micro-batch, bounded dedupe, window metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkingest.config import SourceSpec
from sparkingest.operators.audit import committed_watermark, is_committed
from sparkingest.operators.quality import CODES, LATE_RECORD, Rule
from sparkingest.operators.watermark import TEXT_FORM, parse_timestamp
from sparkingest.plans.ingest import event_time_storage, ingest
from sparkingest.session import materialize, timestamp_literal


def session_now(spark: SparkSession) -> dt.datetime:
    """The current time as wall clock of the session's zone, which naive times are read in."""
    text = spark.range(1).select(F.date_format(F.current_timestamp(), TEXT_FORM)).first()[0]
    return parse_timestamp(text)


def json_messages(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """A stream over JSON-lines files landed below ``path``; any ``readStream`` frame serves
    the other functions as well."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def ingest_stream(
    stream: DataFrame,
    spec: SourceSpec,
    name: str,
    checkpoint: str,
    *,
    rules: Sequence[Rule] = (),
    trigger: Mapping[str, object] | None = None,
    clock: Callable[[], dt.datetime] | None = None,
    event_time: str | None = None,
    delay: dt.timedelta = dt.timedelta(0),
) -> StreamingQuery:
    """Run ``ingest`` on every micro-batch.

    With ``event_time``, rows more than ``delay`` behind the greatest event time of the
    batches before are late: they go to quarantine in the batch that brought them. That time
    is part of each batch's record, so a repeated batch is judged as the first time, and no
    history is read.

    ``foreachBatch`` delivers at least once. The run id comes from the query name and
    batch id, so a repeated batch is skipped if it was committed and rewrites its own
    directory if it was not. The default trigger fires every 30 seconds, the default clock
    is the session's.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = f"{name}-{batch_id}"
        if is_committed(spark, spec.audit.path, spec.metadata.source_name, run_id):
            return
        connection = replace(spec.connection, reader=lambda _: batch)
        ingest(
            spark,
            replace(spec, connection=connection),
            run_id=run_id,
            run_ts=clock() if clock is not None else session_now(spark),
            rules=[*rules, *_lateness(spark, spec, event_time, delay)],
            event_time=event_time,
        )

    return (
        stream.writeStream.queryName(name)
        .foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


@dataclass(frozen=True)
class Late:
    """Event times before ``bound``; rows without one are not late."""

    column: str
    bound: dt.datetime
    code: str = LATE_RECORD

    def violation(self) -> Column:
        return F.coalesce(F.col(f"`{self.column}`") < timestamp_literal(self.bound), F.lit(False))


def _lateness(spark, spec, event_time: str | None, delay: dt.timedelta) -> list[Late]:
    """The rule for the next batch; none before the first one."""
    if event_time is None:
        return []
    seen = committed_watermark(
        spark, spec.audit.path, spec.metadata.source_name, event_time_storage(event_time)
    )
    return [] if seen is None else [Late(event_time, parse_timestamp(seen[1]) - delay)]


def dedupe_stream(
    stream: DataFrame, keys: Sequence[str], event_time: str, delay: str
) -> DataFrame:
    """First arrival per key, remembered until the watermark passes it by ``delay``.

    Rows are not touched otherwise. The state store receives all copies of a key in one
    task of a batch; copies past the first only look the key up there.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def late_records(raw: DataFrame, accepted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raw rows Spark dropped behind the watermark, classified for quarantine.

    Every raw key either has an accepted row or came too late, whatever the batches
    were, so nothing is dropped unseen. Null keys match each other. For a long history
    pass the days in question of both tables.

    Only distinct keys are compared, so copies of one message shrink to one key per
    task; the late keys, few, are stored and select their rows without moving the rest.
    """
    used = raw.select(*[F.col(k).alias(f"_raw_{k}") for k in keys]).distinct()
    known = accepted.select(*[F.col(k).alias(f"_known_{k}") for k in keys]).distinct()
    lost = used.join(known, _same(keys, "_raw_", "_known_"), "left_anti")
    late_keys = materialize(lost, "late-keys")
    late = raw.join(late_keys, _same(keys, "", "_raw_"), "left_semi")
    return late.withColumn(CODES, F.array(F.lit(LATE_RECORD)))


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(and_, [F.col(left + k).eqNullSafe(F.col(right + k)) for k in keys])


def throughput(
    stream: DataFrame,
    event_time: str,
    delay: str,
    width: str = "1 minute",
    *,
    message: Column | None = None,
) -> DataFrame:
    """Events and events per second of each tumbling window, emitted once it closes.

    A window closes when a later event time comes in. Where a source falls silent or ends,
    a punctuation closes it: a row with a later time that ``message`` tells from messages. It
    moves the watermark and is not counted.
    """
    window = F.window(event_time, width)
    counted = F.count(F.lit(1)) if message is None else F.count_if(message)
    counts = stream.withWatermark(event_time, delay).groupBy(window).agg(counted.alias("events"))
    if message is not None:
        counts = counts.where("events > 0")
    seconds = (F.unix_timestamp("window.end") - F.unix_timestamp("window.start")).cast("double")
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "events",
        (F.col("events") / seconds).alias("events_per_second"),
    )


def sessions(
    stream: DataFrame,
    event_time: str,
    delay: str,
    device: str,
    gap: str,
    *,
    message: Column | None = None,
) -> DataFrame:
    """``device, session_start, last_event, events``: messages of a device with no silence of
    more than ``gap`` between them, emitted once the watermark has passed the gap.

    Sessions of one task's rows are merged before the shuffle, so a device that sends most of
    the messages sends one row a session and task (``spark.sql.streaming.sessionWindow.
    merge.sessions.in.local.partition``). Punctuations as in ``throughput``; they are no
    messages of a device.
    """
    rows = stream.withWatermark(event_time, delay)
    counted = F.count(F.lit(1)) if message is None else F.count_if(message)
    grouped = rows.groupBy(F.session_window(event_time, gap).alias("session"), device).agg(
        counted.alias("events"), F.max(event_time).alias("last_event")
    )
    return grouped.where("events > 0").select(
        device, F.col("session.start").alias("session_start"), "last_event", "events"
    )


def write_files(
    result: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Append to Parquet through Spark's exactly-once file sink."""
    return (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )
