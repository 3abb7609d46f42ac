"""Release of quarantined rows that pass now."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkingest.config import Connection, Ingestion, SourceSpec, check_path_safe
from sparkingest.errors import ConfigurationError
from sparkingest.operators import audit as audit_table
from sparkingest.operators import bronze
from sparkingest.operators.quality import CorruptRecord, Rule, revalidate
from sparkingest.plans.ingest import RunResult, ingest
from sparkingest.session import path_exists, scratch_table
from sparkingest.sources.files import CORRUPT


def _released_root(spec: SourceSpec) -> str:
    """The lists of one source: sources may share a quarantine and run ids."""
    root = spec.quarantine.path.rstrip("/")
    return f"{root}_released/source_name={spec.metadata.source_name}"


def released_rows(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """``(row_id, run_id)`` of rows that committed runs have released."""
    root = _released_root(spec)
    if not path_exists(spark, root):
        return spark.createDataFrame([], "row_id STRING, run_id STRING")
    listed = spark.read.schema("row_id STRING, run_id STRING").parquet(root)
    audit = audit_table.read_audit(spark, spec.audit.path, spec.metadata.source_name)
    return listed.join(audit_table.committed_runs(audit).select("run_id"), "run_id", "left_semi")


def recover(
    spark: SparkSession,
    spec: SourceSpec,
    data: T.StructType,
    *,
    run_id: str,
    run_ts: dt.datetime,
    rules: Sequence[Rule],
) -> RunResult:
    """Validate a source's quarantine again and ingest what passes as a run of its own.

    The quarantine keeps all its rows. Which of them are released is listed under the new
    run id before that run commits and counts only once it has, so a crash releases
    nothing and a repeat releases nothing twice.
    """
    check_path_safe("run_id", run_id)
    if spec.quarantine.path is None:
        raise ConfigurationError("quarantine.path", "is required to recover rows")
    source_name = spec.metadata.source_name
    audit = audit_table.read_audit(spark, spec.audit.path, source_name)
    held = bronze.read_quarantine(spark, spec.quarantine.path, data, audit)
    held = held.where(F.col("source_name") == source_name)
    if CORRUPT in data.names:
        rules = [CorruptRecord(), *rules]
    passing, _ = revalidate(held, rules, released_rows(spark, spec))
    with scratch_table(passing.select("row_id", *data.names), f"recover-{run_id}") as ready:
        target = f"{_released_root(spec)}/run_id={run_id}"
        ready.select("row_id").write.mode("overwrite").parquet(target)
        source = Connection(
            spec.connection.connection_type, reader=lambda _: ready.select(*data.names)
        )
        plain = replace(spec, connection=source, ingestion=Ingestion())
        return ingest(spark, plain, run_id=run_id, run_ts=run_ts)
