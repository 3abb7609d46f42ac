"""Audit and lineage tables: one record per run, put once, never changed.

The record of a SUCCESS or PARTIAL run is also its commit: readers see the files of a run only
once it exists. It holds all that the run changes, the audit row, its lineage, the
watermark it moves to, whether it raises an alert or misses its deadline, so that none of these
can be there without the others. Every source has a numbered log of such records; a reader opens its
last snapshot and the records behind it, however many runs there were.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from sparkingest.errors import StorageWriteError
from sparkingest.operators.commits import CommitLog
from sparkingest.session import folders_below, one_row, path_exists

# Run outcomes.
SUCCESS = "SUCCESS"
FAILURE = "FAILURE"
PARTIAL = "PARTIAL"
COMMITTED = (SUCCESS, PARTIAL)

AUDIT_SCHEMA = (
    "run_id STRING, source_name STRING, source_type STRING, pipeline_start_ts TIMESTAMP, "
    "pipeline_end_ts TIMESTAMP, records_read BIGINT, records_written BIGINT, "
    "quarantine_count BIGINT, bronze_path STRING, checksum STRING, status STRING, "
    "error_message STRING, dropped_count BIGINT, schema_json STRING"
)

LINEAGE_SCHEMA = (
    "run_id STRING, source_id STRING, source_name STRING, source_type STRING, "
    "extracted_at TIMESTAMP, records_read BIGINT, records_written BIGINT, "
    "target_path STRING, schema_ddl STRING"
)


# What a record holds beside its audit row.
DETAIL_SCHEMA = (
    "alert BOOLEAN, sla_missed BOOLEAN, added_count BIGINT, source_id STRING, schema_ddl STRING, "
    "watermark_type STRING, watermark_value STRING, watermark_storage STRING"
)
RUN_SCHEMA = f"{AUDIT_SCHEMA}, {DETAIL_SCHEMA}"


@dataclass(frozen=True)
class RunDetails:
    """``watermark_value`` is the mark as text, in the session's zone."""

    alert: bool = False
    sla_missed: bool = False
    added_count: int = 0
    source_id: str | None = None
    schema_ddl: str | None = None
    watermark_type: str | None = None
    watermark_value: str | None = None
    watermark_storage: str | None = None


@dataclass(frozen=True)
class AuditEvent:
    run_id: str
    source_name: str
    source_type: str
    pipeline_start_ts: dt.datetime
    pipeline_end_ts: dt.datetime
    records_read: int = 0
    records_written: int = 0
    quarantine_count: int = 0
    bronze_path: str = ""
    checksum: str = ""
    status: str = SUCCESS
    error_message: str | None = None
    dropped_count: int = 0
    schema_json: str | None = None


@dataclass(frozen=True)
class LineageEvent:
    run_id: str
    source_id: str
    source_name: str
    source_type: str
    extracted_at: dt.datetime
    records_read: int
    records_written: int
    target_path: str
    schema_ddl: str


def run_records(spark: SparkSession, path: str, source_name: str) -> CommitLog:
    return CommitLog(spark, f"{path}/source_name={source_name}/_log")


def append_audit(
    spark: SparkSession, path: str, event: AuditEvent, details: RunDetails = RunDetails()
) -> int:
    """Put the record of a run and return its number.

    Of two writers that finish together the second meets a taken number, looks at the record
    there and takes the next one, unless that record is of the same run: a run id commits once.
    """
    log = run_records(spark, path, event.source_name)
    fields = {**asdict(event), **asdict(details)}
    record = {k: str(v) if isinstance(v, dt.datetime) else v for k, v in fields.items()}

    def next_record(number: int) -> dict:
        if event.status in COMMITTED and _is_committed(log, event.run_id, number):
            raise StorageWriteError(log.path, f"run {event.run_id} was committed meanwhile")
        return record

    number = log.commit(next_record)
    if log.due(number):
        # Readers are right without the snapshot, and the next one makes up for it.
        folder = f"{path}/source_name={event.source_name}/_runs/{number}-{uuid.uuid4().hex}"
        records = _records(spark, [(event.source_name, log, number)])
        records.drop("source_name").coalesce(1).write.parquet(folder)
        log.save_snapshot(number, {"runs": folder, "watermarks": _watermarks(log, number)})
    return number


def _records(spark: SparkSession, logs: Sequence[tuple[str, CommitLog, int]]) -> DataFrame:
    """``number`` and all fields of the records of some logs, from snapshots and what follows."""
    schema = StructType.fromDDL(RUN_SCHEMA)
    snapshots, tail = [], []
    for _, log, number in logs:
        at, base = log.base(number)
        if base is not None:
            snapshots.append(base["runs"])
        tail += log.tail(at, number)
    times = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampType)]
    text = StructType(
        [T.StructField("number", T.LongType())]
        + [T.StructField(f.name, T.StringType() if f.name in times else f.dataType) for f in schema.fields]
    )
    # One literal that the JVM parses: a small plan with a known size, by which joins prune.
    parsed = F.from_json(F.lit(json.dumps(tail)), T.ArrayType(text))
    rows = spark.range(0, 1, 1, 1).select(F.inline(parsed))
    rows = rows.withColumns({name: F.col(name).cast("timestamp") for name in times})
    if not snapshots:
        return rows
    # The source's name is that of the folder; a snapshot leaves it out.
    inner = StructType([T.StructField("number", T.LongType()), *(f for f in schema.fields if f.name != "source_name")])
    stored = spark.read.schema(inner).parquet(*snapshots)
    name = F.regexp_extract("_metadata.file_path", "/source_name=([^/]+)/", 1)
    return stored.select("*", name.alias("source_name")).select(rows.columns).unionByName(rows)


def read_runs(spark: SparkSession, path: str, source_name: str | None = None) -> DataFrame:
    """Every record with its ``number`` in its source's log: the audit row and what the run
    did beside it."""
    if source_name is None:
        found = folders_below(spark, path)
        names = [f.split("=", 1)[1] for f in found if f.startswith("source_name=")]
    else:
        names = [source_name]
    logs = [(n, run_records(spark, path, n)) for n in names]
    return _records(spark, [(n, log, log.head()) for n, log in logs])


def _watermarks(log: CommitLog, number: int) -> dict:
    """The newest mark of each watermark storage; a source has one unless its settings change."""
    at, base = log.base(number)
    marks = dict(base["watermarks"]) if base else {}
    for record in log.tail(at, number):
        if record["status"] in COMMITTED and record["watermark_storage"] is not None:
            marks[record["watermark_storage"]] = [record["watermark_type"], record["watermark_value"]]
    return marks


def committed_watermark(
    spark: SparkSession, path: str, source_name: str, storage: str
) -> tuple[str, str] | None:
    """Type and text of the mark of a source's last committed run that moved it. Opens one
    snapshot and the records behind it; no job runs."""
    log = run_records(spark, path, source_name)
    mark = _watermarks(log, log.head()).get(storage)
    return None if mark is None else (mark[0], mark[1])


def append_lineage(spark: SparkSession, path: str, event: LineageEvent) -> None:
    row = one_row(spark, LINEAGE_SCHEMA, astuple(event))
    row.write.mode("append").parquet(path)


def read_audit(spark: SparkSession, path: str, source_name: str | None = None) -> DataFrame:
    return read_runs(spark, path, source_name).select(*StructType.fromDDL(AUDIT_SCHEMA).names)


def read_lineage(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], LINEAGE_SCHEMA)
    return spark.read.schema(LINEAGE_SCHEMA).parquet(path)


def committed_runs(audit: DataFrame) -> DataFrame:
    return audit.where(F.col("status").isin(*COMMITTED))


def is_committed(spark: SparkSession, path: str, source_name: str, run_id: str) -> bool:
    log = run_records(spark, path, source_name)
    return _is_committed(log, run_id, log.head())


def _is_committed(log: CommitLog, run_id: str, number: int) -> bool:
    at, base = log.base(number)
    if any(r["run_id"] == run_id and r["status"] in COMMITTED for r in log.tail(at, number)):
        return True
    if base is None:
        return False
    runs = log.spark.read.schema("run_id STRING, status STRING").parquet(base["runs"])
    return not committed_runs(runs.where(F.col("run_id") == run_id)).isEmpty()


def run_status(failed: Column, quarantined: Column) -> Column:
    """FAILURE for an aborted run, PARTIAL when rows were quarantined, else SUCCESS."""
    return (
        F.when(F.coalesce(failed, F.lit(False)), F.lit(FAILURE))
        .when(quarantined > 0, F.lit(PARTIAL))
        .otherwise(F.lit(SUCCESS))
    )
