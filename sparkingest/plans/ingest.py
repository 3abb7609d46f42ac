"""One ingestion run from source to committed raw rows."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkingest.config import SourceSpec, check_path_safe
from sparkingest.errors import (
    ConfigurationError,
    ConnectorError,
    IngestionError,
    QualityViolation,
    StorageWriteError,
    UnexpectedError,
)
from sparkingest.operators import audit as audit_table
from sparkingest.operators import bronze
from sparkingest.operators.quality import (
    CODES,
    CorruptRecord,
    Rule,
    classify,
    has_batch_rule,
    settle_batch_rules,
)
from sparkingest.operators.watermark import (
    TEXT_FORM,
    TIMESTAMP,
    Watermark,
    append_watermark,
    incremental_scan,
    parse_timestamp,
    read_watermark,
    watermark_kind,
)
from sparkingest.session import scratch_table
from sparkingest.sources.files import CORRUPT, extract_file
from sparkingest.sources.jdbc import read_jdbc

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunResult:
    run_id: str
    status: str
    records_read: int
    records_written: int
    quarantine_count: int
    dropped_count: int
    duration_ms: int
    path: str
    partition_date: str
    checksum: str
    schema: T.StructType
    alert: bool = False
    sla_missed: bool = False


def extract(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """The source as a DataFrame; incremental sources only beyond their watermark."""
    connection, ingestion = spec.connection, spec.ingestion
    source_id = spec.metadata.source_id
    if connection.reader is not None:
        df = connection.reader(spark)
    elif connection.connection_type == "file":
        df = extract_file(spark, spec)
    elif connection.connection_type == "jdbc":
        df = read_jdbc(spark, connection.jdbc_options, source_id)
    else:
        raise ConfigurationError("connection", f"{connection.connection_type} needs a reader")
    if ingestion.mode == "full":
        return df
    mark = current_mark(spark, spec)
    return incremental_scan(
        df,
        ingestion.incremental_column,
        mark,
        lag_seconds=ingestion.lag_seconds,
        lag_units=ingestion.lag_units,
    )


def current_mark(spark: SparkSession, spec: SourceSpec) -> Watermark | None:
    """How far the source has been read: the mark in the record of its last committed run, and
    where there is none the one in the watermark storage, as a first run may find it there."""
    storage, source_id = spec.ingestion.watermark_storage, spec.metadata.source_id
    mark = audit_table.committed_watermark(spark, spec.audit.path, spec.metadata.source_name, storage)
    if mark is None:
        return read_watermark(spark, storage, source_id)
    kind, value = mark
    return Watermark(kind, ts=parse_timestamp(value)) if kind == TIMESTAMP else Watermark(kind, integer=int(value))


def ingest(
    spark: SparkSession,
    spec: SourceSpec,
    *,
    run_id: str,
    run_ts: dt.datetime,
    rules: Sequence[Rule] = (),
    validator: Callable[[DataFrame], DataFrame] | None = None,
    mismatch_threshold: int = 0,
    verify_stored: bool = False,
    event_time: str | None = None,
) -> RunResult:
    """Extract, classify, write, reconcile, quarantine, commit.

    The source is evaluated once, in the write job. One record commits the run with its
    watermark, lineage, alert and missed deadline; a crash before it leaves files no reader
    sees and the mark where it was, and nothing that matters happens after it.

    A ``validator`` may drop rows, which ``dropped_count`` reports apart from those in
    quarantine, and add some; rows are compared whole, so a changed row counts as one
    dropped and one added. Dropped rows are stored beside the quarantine. A completeness threshold is
    decided on the batch; both work on a stored copy of the extract.

    ``event_time`` names a column whose greatest value over all runs the records keep, apart
    from how far the source was read.
    """
    started = time.monotonic()
    meta = spec.metadata
    known = {"records_read": 0, "records_written": 0, "quarantine_count": 0, "dropped_count": 0}
    path = checksum = ""
    schema_json = None

    def event(status: str, message: str | None = None) -> audit_table.AuditEvent:
        elapsed = dt.timedelta(seconds=time.monotonic() - started)
        return audit_table.AuditEvent(
            run_id=run_id,
            source_name=meta.source_name,
            source_type=spec.connection.connection_type,
            pipeline_start_ts=run_ts,
            pipeline_end_ts=run_ts + elapsed,
            bronze_path=path,
            checksum=checksum,
            status=status,
            error_message=message,
            schema_json=schema_json,
            **known,
        )

    scratch = ExitStack()
    try:
        check_path_safe("run_id", run_id)
        if audit_table.is_committed(spark, spec.audit.path, meta.source_name, run_id):
            raise StorageWriteError(
                spec.storage.path, f"run {run_id} is committed and cannot be written again"
            )
        try:
            source = extract(spark, spec)
        except IngestionError:
            raise
        except Exception as error:
            raise ConnectorError(meta.source_id, str(error)) from error

        if CORRUPT in source.columns:
            rules = [CorruptRecord(), *rules]
        if validator is not None or has_batch_rule(rules):
            source = scratch.enter_context(_stored_extract(source, meta.source_id, run_id))
        added = 0
        if validator is not None:
            extracted, source = source, validator(source)
            known["records_read"] = extracted.count()
            known["dropped_count"], added = _validated(spark, spec, run_id, extracted, source)
        flagged = classify(source, settle_batch_rules(source, rules))
        data = T.StructType([f for f in flagged.schema.fields if f.name != CODES])
        schema_json = data.json()

        high_water = None
        incremental = spec.ingestion.mode == "incremental"
        column = spec.ingestion.incremental_column if incremental else event_time
        if column is not None:
            kind = watermark_kind(data[column].dataType, meta.source_id)
            value = F.col(column).cast("timestamp" if kind == TIMESTAMP else "bigint")
            # Over all rows: quarantined ones are stored too and must not be read again.
            high_water = F.max(value)
            if kind == TIMESTAMP:
                high_water = F.date_format(high_water, TEXT_FORM)

        try:
            staged = bronze.stage_run(
                flagged,
                spec.storage.path,
                meta.source_name,
                run_id,
                run_ts,
                partition_by=spec.storage.partition_by,
                high_water=high_water,
            )
        except StorageWriteError as error:
            if _is_read_failure(error.cause):
                raise ConnectorError(meta.source_id, error.cause) from error
            raise
        if validator is None:
            known["records_read"] = staged.records_read
        if spec.schema_enforcement.mode == "strict" and staged.records_quarantined:
            known["quarantine_count"] = staged.records_quarantined
            raise QualityViolation(meta.source_id, staged.records_quarantined)

        _, quarantined = bronze.reconcile_run(
            spark,
            staged,
            data,
            partition_by=spec.storage.partition_by,
            threshold=mismatch_threshold,
            verify_stored=verify_stored,
        )
        if quarantined and spec.quarantine.path:
            bronze.write_quarantine(
                spark,
                staged,
                data,
                spec.quarantine.path,
                meta.source_name,
                run_id,
                partition_by=spec.storage.partition_by,
            )
        # What the write observed; what is on disk may differ by the threshold.
        known["records_written"] = staged.records_clean
        known["quarantine_count"] = staged.records_quarantined
        path, checksum = staged.path, staged.checksum
        incomplete = quarantined or known["dropped_count"]
        status = audit_table.PARTIAL if incomplete else audit_table.SUCCESS
        committed = event(status)
        details = _details(spark, spec, committed, data, added)
        if incremental and staged.high_water is not None:
            details = _moved_mark(spark, spec, kind, staged.high_water, details)
        elif column is not None:
            details = _seen_until(spark, spec, column, kind, staged.high_water, details)
        audit_table.append_audit(spark, spec.audit.path, committed, details)
    except Exception as error:
        typed = error if isinstance(error, IngestionError) else UnexpectedError(str(error))
        path = checksum = ""
        known["records_written"] = 0
        _audit_failure(spark, spec, event(audit_table.FAILURE, str(typed)))
        if typed is error:
            raise
        raise typed from error
    finally:
        scratch.close()

    if incremental and details.watermark_value is not None:
        _copy_watermark(spark, spec, details, committed)
    if spec.audit.lineage_path:
        _record_lineage(spark, spec, committed, data)
    if spec.storage.compaction_enabled:
        _compact_closed_days(spark, spec, committed, data)

    return RunResult(
        run_id=run_id,
        status=status,
        records_read=committed.records_read,
        records_written=committed.records_written,
        quarantine_count=committed.quarantine_count,
        dropped_count=committed.dropped_count,
        duration_ms=int((time.monotonic() - started) * 1000),
        path=path,
        partition_date=run_ts.strftime("%Y-%m-%d"),
        checksum=checksum,
        schema=data,
        alert=details.alert,
        sla_missed=details.sla_missed,
    )


def _details(spark, spec, committed, data, added) -> audit_table.RunDetails:
    """What the record of a run says beside its audit row."""
    threshold, allowed = spec.quarantine.alert_threshold, spec.monitoring.sla_threshold_seconds
    read, held = committed.records_read, committed.quarantine_count
    seconds = (committed.pipeline_end_ts - committed.pipeline_start_ts).total_seconds()
    return audit_table.RunDetails(
        alert=bool(threshold is not None and read and held / read > threshold),
        sla_missed=allowed is not None and seconds > allowed,
        added_count=added,
        source_id=spec.metadata.source_id,
        schema_ddl=data.simpleString(),
    )


def _moved_mark(spark, spec, kind, high_water, details) -> audit_table.RunDetails:
    """The record with the mark at the highest stored value; a run that re-read a lag never
    moves it back."""
    text = str(high_water)
    if spec.ingestion.lag_seconds or spec.ingestion.lag_units:
        value = parse_timestamp(text) if kind == TIMESTAMP else int(text)
        before = current_mark(spark, spec)
        if before is not None and before.kind == kind and value <= before.value:
            return details
    return replace(
        details,
        watermark_type=kind,
        watermark_value=text,
        watermark_storage=spec.ingestion.watermark_storage,
    )


def event_time_storage(column: str) -> str:
    """The name under which records keep the greatest event time, in place of a storage."""
    return f"event-time:{column}"


def _seen_until(spark, spec, column, kind, high_water, details) -> audit_table.RunDetails:
    """The record with the greatest event time of all runs so far."""
    storage = event_time_storage(column)
    before = audit_table.committed_watermark(spark, spec.audit.path, spec.metadata.source_name, storage)
    values = [v for v in (high_water, before[1] if before else None) if v is not None]
    if not values:
        return details
    top = max(values) if kind == TIMESTAMP else str(max(map(int, values)))
    return replace(details, watermark_type=kind, watermark_value=top, watermark_storage=storage)


def _copy_watermark(spark, spec, details, committed) -> None:
    """Copy the committed mark into the watermark storage, for those who read it there; the
    record is what the next run goes by."""
    kind, text = details.watermark_type, details.watermark_value
    is_time = kind == TIMESTAMP
    mark = Watermark(kind, ts=parse_timestamp(text)) if is_time else Watermark(kind, integer=int(text))
    try:
        append_watermark(
            spark,
            spec.ingestion.watermark_storage,
            spec.metadata.source_id,
            mark,
            committed.pipeline_start_ts,
            committed.run_id,
        )
    except Exception as error:
        log.warning("watermark of run %s not copied: %s", committed.run_id, error)


def dropped_path(spec: SourceSpec, run_id: str) -> str | None:
    """Where the rows are that a run's validator dropped."""
    if spec.quarantine.path is None:
        return None
    root = spec.quarantine.path.rstrip("/")
    return f"{root}_dropped/source_name={spec.metadata.source_name}/_run_id={run_id}"


def _validated(spark, spec, run_id, extracted, source) -> tuple[int, int]:
    """Rows that the validator dropped and added, by what is in them. Columns that it adds or
    removes do not count. A validator that returns the extract as it is costs no comparison."""
    shared = [c for c in extracted.columns if c in source.columns]
    if source.sameSemantics(extracted) or not shared:
        return 0, 0
    names = [F.col(f"`{c}`") for c in shared]
    # Rows of each side by their digest, counted before they move.
    key = F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256)
    sides = extracted.select(key.alias("k"), F.lit(1).alias("n")).unionByName(
        source.select(key.alias("k"), F.lit(-1).alias("n"))
    )
    surplus = sides.groupBy("k").agg(F.sum("n").alias("n")).where("n <> 0")
    with scratch_table(surplus, f"validated-{run_id}") as differing:
        totals = differing.agg(
            F.sum(F.greatest("n", F.lit(0))).alias("dropped"), F.sum(F.greatest(-F.col("n"), F.lit(0))).alias("added")
        ).first()
        target = dropped_path(spec, run_id)
        if target is not None and totals.dropped:
            lost = differing.where("n > 0")
            rows = extracted.select("*", key.alias("_digest")).join(lost, F.col("_digest") == F.col("k"))
            # Of equal rows as many as were dropped.
            rows.dropDuplicates(["_digest"]).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop(
                "k", "n", "_digest", "_copy"
            ).write.mode("overwrite").parquet(target)
    return totals.dropped or 0, totals.added or 0


@contextmanager
def _stored_extract(source: DataFrame, source_id: str, run_id: str) -> Iterator[DataFrame]:
    with ExitStack() as stack:
        try:
            stored = stack.enter_context(scratch_table(source, f"extract-{run_id}"))
        except Exception as error:
            raise ConnectorError(source_id, str(error)) from error
        yield stored


# Error conditions Spark reports when a source record or file cannot be read.
_READ_FAILURES = (
    "MALFORMED_RECORD_IN_PARSING",
    "MALFORMED_CSV_RECORD",
    "FAILED_READ_FILE",
    "BadRecordException",
)


def _is_read_failure(cause: str) -> bool:
    return any(condition in cause for condition in _READ_FAILURES)


def _audit_failure(spark, spec, failure) -> None:
    """A failed run stays failed whether or not its audit row can be written."""
    try:
        audit_table.append_audit(spark, spec.audit.path, failure)
    except Exception as error:
        log.warning("audit row of failed run %s not written: %s", failure.run_id, error)


def _record_lineage(spark, spec, committed, data) -> None:
    """The run is committed by now, so a lineage failure is only a warning."""
    try:
        audit_table.append_lineage(
            spark,
            spec.audit.lineage_path,
            audit_table.LineageEvent(
                run_id=committed.run_id,
                source_id=spec.metadata.source_id,
                source_name=committed.source_name,
                source_type=committed.source_type,
                extracted_at=committed.pipeline_start_ts,
                records_read=committed.records_read,
                records_written=committed.records_written,
                target_path=committed.bronze_path,
                schema_ddl=data.simpleString(),
            ),
        )
    except Exception as error:
        log.warning("lineage of run %s not written: %s", committed.run_id, error)


def _compact_closed_days(spark, spec, committed, data) -> None:
    """Merge the files of the days before this run; readers are right without it."""
    try:
        bronze.compact(
            spark,
            spec.storage.path,
            spec.storage.compacted_path,
            audit_table.read_audit(spark, spec.audit.path),
            data,
            committed.run_id,
            source_name=committed.source_name,
            before=committed.pipeline_start_ts.strftime("%Y-%m-%d"),
            partition_by=spec.storage.partition_by,
        )
    except Exception as error:
        log.warning("compaction after run %s failed: %s", committed.run_id, error)
