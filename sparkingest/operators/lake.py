"""Reads and upkeep of the raw layer: snapshots, as-of reads, replay, retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkingest.config import SourceSpec
from sparkingest.operators.audit import committed_runs, read_audit, read_runs
from sparkingest.operators.bronze import RUN_ID
from sparkingest.operators.quality import Rule, classify, split
from sparkingest.operators.silver import latest_per_key
from sparkingest.session import delete_path, folders_below, materialize, timestamp_literal


def newest_dates(audit: DataFrame) -> DataFrame:
    """``(source_name, ingestion_date)`` of each source's newest committed run."""
    date = F.regexp_extract("bronze_path", "ingestion_date=([^/]+)", 1)
    return committed_runs(audit).groupBy("source_name").agg(F.max(date).alias("ingestion_date"))


def latest_snapshot(
    df: DataFrame,
    newest: DataFrame | None = None,
    source: str = "source_name",
    date: str = "ingestion_date",
) -> DataFrame:
    """Rows of each source's newest full refresh.

    ``newest`` names the date per source; ``newest_dates`` takes it from the audit table
    without touching the data. Left out, it is the maximum of the partition values. Either
    way it is stored first: one row per source whose size the planner knows, so that the
    join broadcasts it and prunes the older partitions.
    """
    if newest is None:
        newest = df.groupBy(source).agg(F.max(date).alias(date))
    known = materialize(newest.select(source, date), "newest-dates")
    # Always true for real dates; Spark prunes only when the small side is filtered.
    known = known.where(F.length(F.col(date).cast("string")) > 0)
    return df.join(known, [source, date], "left_semi")


def as_of(
    bronze: DataFrame,
    audit: DataFrame,
    moment: dt.datetime,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """The raw layer as it stood at ``moment``: rows of runs committed until then.

    With ``keys``, the newest version of each key among them.
    """
    until = committed_runs(audit).where(F.col("pipeline_end_ts") <= timestamp_literal(moment))
    until = until.groupBy("source_name", F.col("run_id").alias(RUN_ID)).agg(
        F.min("pipeline_end_ts").alias("_at")
    )
    rows = bronze.join(until, ["source_name", RUN_ID])
    if keys is not None:
        rows = latest_per_key(rows, keys, ["_at", RUN_ID, "source_name"])
    return rows.drop("_at")


def replay(
    bronze: DataFrame, source_name: str, run_ids: Sequence[str], rules: Sequence[Rule]
) -> tuple[DataFrame, DataFrame]:
    """Validate the rows of chosen runs of a source again; ``(clean, quarantined)``. Run ids
    name runs within a source only."""
    chosen = (F.col("source_name") == source_name) & F.col(RUN_ID).isin(list(run_ids))
    return split(classify(bronze.where(chosen), rules))


def expired(date: str | Column, retention_days: int, as_of_date: dt.date) -> Column:
    """True where ``date`` is more than ``retention_days`` before ``as_of_date``."""
    cutoff = as_of_date - dt.timedelta(days=retention_days)
    column = F.col(date) if isinstance(date, str) else date
    return column.cast("date") < F.lit(cutoff)


def expired_partitions(
    df: DataFrame, partition: str, retention_days: int, as_of_date: dt.date
) -> DataFrame:
    """Partitions past retention and their row counts; only partition values are read."""
    old = df.where(expired(partition, retention_days, as_of_date))
    return old.groupBy(partition).agg(F.count(F.lit(1)).alias("row_count"))


def drop_expired_quarantine(
    spark: SparkSession, quarantine_root: str, audit: DataFrame, retention_days: int, as_of_date
) -> list[str]:
    """Delete quarantine directories of runs past retention and return their paths.

    Raw and audit rows never expire here: the raw layer has a date level between source
    and run, so a raw root holds no directory this could match.
    """
    old = audit.where(expired("pipeline_end_ts", retention_days, as_of_date))
    removed = []
    for row in old.select("source_name", "run_id").distinct().toLocalIterator():
        path = f"{quarantine_root}/source_name={row['source_name']}/{RUN_ID}={row['run_id']}"
        if delete_path(spark, path):
            removed.append(path)
    return removed


def expire_quarantine(spark: SparkSession, spec: SourceSpec, as_of_date: dt.date) -> list[str]:
    """Delete what the source's quarantine holds of runs past its ``retention_days``, and the
    rows that validators dropped in them. Looks at the folders that are still there, not at all runs ever."""
    if spec.quarantine.path is None:
        return []
    name, root = spec.metadata.source_name, spec.quarantine.path.rstrip("/")
    removed = []
    for base in (root, f"{root}_dropped"):
        folders = folders_below(spark, f"{base}/source_name={name}")
        held = [f.split("=", 1)[1] for f in folders if f.startswith(f"{RUN_ID}=")]
        if not held:
            continue
        present = spark.createDataFrame([(run,) for run in held], "run_id STRING")
        runs = read_audit(spark, spec.audit.path, name)
        old = runs.where(expired("pipeline_end_ts", spec.quarantine.retention_days, as_of_date))
        for row in old.join(present, "run_id", "left_semi").select("run_id").distinct().collect():
            path = f"{base}/source_name={name}/{RUN_ID}={row['run_id']}"
            if delete_path(spark, path):
                removed.append(path)
    return sorted(removed)


def expired_runs(spark: SparkSession, spec: SourceSpec, as_of_date: dt.date) -> DataFrame:
    """Records of the source past the audit's ``retention_days``. A report: the log is the
    commit of its runs, and its records are never deleted."""
    runs = read_runs(spark, spec.audit.path, spec.metadata.source_name)
    return runs.where(expired("pipeline_end_ts", spec.audit.retention_days, as_of_date))
