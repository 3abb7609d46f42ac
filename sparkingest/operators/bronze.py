"""The raw layer: one directory per run, visible once the audit table commits the run.

Layout: ``<root>/source_name=S/ingestion_date=D/_run_id=R/_outcome=O/<extra>=…``. A run
writes its own directory only, so retries are idempotent and earlier runs are never
touched. This guards the library's own writers, not the storage underneath.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkingest.config import check_path_safe
from sparkingest.errors import StorageWriteError
from sparkingest.functions.fingerprint import (
    batch_checksum,
    checksum_by,
    digest_of,
    drop_leaf_words,
    lane_sums,
    with_leaf_words,
)
from sparkingest.operators.audit import committed_runs, is_committed
from sparkingest.operators.quality import CODES, is_clean
from sparkingest.session import delete_path, option, path_exists, timestamp_literal

CLEAN = "clean"
QUARANTINED = "quarantined"
OUTCOME = "_outcome"
RUN_ID = "_run_id"
METADATA = ["_ingestion_ts", "_source_name", RUN_ID, "_checksum"]


@dataclass(frozen=True)
class StagedRun:
    """What one write job observed about its run."""

    path: str
    records_read: int
    records_clean: int
    records_quarantined: int
    checksum: str
    high_water: object = None


def run_directory(root: str, source_name: str, ingestion_date: str, run_id: str) -> str:
    check_path_safe("source_name", source_name)
    check_path_safe("run_id", run_id)
    return f"{root}/source_name={source_name}/ingestion_date={ingestion_date}/{RUN_ID}={run_id}"


def enrich(df: DataFrame, source_name: str, run_ts: dt.datetime) -> DataFrame:
    """Stored metadata columns. Run id and date are directory names and the checksum is
    joined from the audit row on reading, since it is known only after the write."""
    return df.withColumns(
        {"_ingestion_ts": timestamp_literal(run_ts), "_source_name": F.lit(source_name)}
    )


def stage_run(
    flagged: DataFrame,
    root: str,
    source_name: str,
    run_id: str,
    run_ts: dt.datetime,
    *,
    partition_by: Sequence[str] = (),
    audit_path: str | None = None,
    high_water: Column | None = None,
) -> StagedRun:
    """Write a classified batch in one pass over its source.

    Counts, checksum and the next watermark are observed in the write job itself. The
    observation sits directly below the write, in the result stage, where Spark counts
    every task once however often it is retried.

    Configured partition columns are rebalanced first: files stay few, and AQE splits a
    value that holds a large share of the rows.
    """
    spark = flagged.sparkSession
    if audit_path is not None and is_committed(spark, audit_path, source_name, run_id):
        raise StorageWriteError(root, f"run {run_id} is committed and cannot be written again")
    path = run_directory(root, source_name, run_ts.strftime("%Y-%m-%d"), run_id)
    data_columns = [c for c in flagged.columns if c != CODES]
    if partition_by:
        flagged = flagged.hint("rebalance", *[F.col(c) for c in partition_by])
    words = with_leaf_words(flagged, data_columns)
    seen = Observation(f"stage-{run_id}")
    metrics = [F.count(F.lit(1)).alias("read"), *lane_sums(is_clean())]
    if high_water is not None:
        metrics.append(high_water.alias("high_water"))
    outcome = F.when(is_clean(), F.lit(CLEAN)).otherwise(F.lit(QUARANTINED))
    observed = drop_leaf_words(words.observe(seen, *metrics)).withColumn(OUTCOME, outcome)
    try:
        # Two outcomes are two open files a task; without this Spark sorts every row by them.
        with option(spark, "spark.sql.maxConcurrentOutputFileWriters", "2" if not partition_by else "0"):
            (
                enrich(observed, source_name, run_ts)
                .write.mode("overwrite")
                .partitionBy(OUTCOME, *partition_by)
                .parquet(path)
            )
    except Exception as error:
        raise StorageWriteError(path, str(error)) from error
    got = seen.get
    return StagedRun(
        path=path,
        records_read=got["read"],
        records_clean=got["_rows"],
        records_quarantined=got["read"] - got["_rows"],
        checksum=digest_of(got),
        high_water=got.get("high_water"),
    )


def stored_schema(data: T.StructType, partition_by: Sequence[str] = ()) -> T.StructType:
    """Schema of a run directory, so that reading never infers partition values."""
    fields = [f for f in data.fields if f.name not in partition_by]
    inner = [data[name] for name in partition_by]
    text = T.StringType()
    return T.StructType(
        fields
        + [
            T.StructField(CODES, T.ArrayType(T.StringType())),
            T.StructField("_ingestion_ts", T.TimestampType()),
            T.StructField("_source_name", text),
            T.StructField(OUTCOME, text),
        ]
        + inner
    )


def read_run(
    spark: SparkSession, path: str, data: T.StructType, partition_by: Sequence[str] = ()
) -> DataFrame:
    return spark.read.schema(stored_schema(data, partition_by)).parquet(path)


def reconcile_run(
    spark: SparkSession,
    staged: StagedRun,
    data: T.StructType,
    *,
    partition_by: Sequence[str] = (),
    threshold: int = 0,
    verify_stored: bool = False,
) -> tuple[int, int]:
    """Compare what the write observed with what is on disk, before the commit.

    The counts come from the Parquet footers of the run directory: no column is read.
    ``verify_stored`` also reads the clean rows back and hashes them again. A negative
    threshold always fails, which tests rely on.
    """
    stored = read_run(spark, staged.path, data, partition_by)
    counts = {r[OUTCOME]: r["count"] for r in stored.groupBy(OUTCOME).count().collect()}
    clean, quarantined = counts.get(CLEAN, 0), counts.get(QUARANTINED, 0)
    pairs = ((staged.records_clean, clean), (staged.records_quarantined, quarantined))
    if any(abs(observed - found) > threshold for observed, found in pairs):
        raise StorageWriteError(
            staged.path,
            f"count mismatch: observed {staged.records_clean} clean and "
            f"{staged.records_quarantined} quarantined rows, found {clean} and {quarantined} "
            f"on disk, {threshold} may differ",
        )
    if verify_stored:
        rows = stored.where(F.col(OUTCOME) == CLEAN)
        found = batch_checksum(rows, [f.name for f in data.fields]).first()["checksum"]
        if found != staged.checksum:
            raise StorageWriteError(
                staged.path, f"checksum mismatch: source={staged.checksum} stored={found}"
            )
    return clean, quarantined


def write_quarantine(
    spark: SparkSession,
    staged: StagedRun,
    data: T.StructType,
    quarantine_root: str,
    source_name: str,
    run_id: str,
    *,
    partition_by: Sequence[str] = (),
) -> str:
    """Move the flagged rows with their reasons to the quarantine table.

    Reads the quarantined directory of the run only and then deletes it, so there is one
    copy and expiry removes it. A crash in between leaves an uncommitted run, which a retry
    writes anew. ``row_id`` is assigned once and stored, so duplicates keep distinct ids and
    no row has to be numbered in a window.
    """
    path = f"{quarantine_root}/source_name={source_name}/{RUN_ID}={run_id}"
    rows = read_run(spark, staged.path, data, partition_by).where(F.col(OUTCOME) == QUARANTINED)
    number = F.monotonically_increasing_id().cast("string")
    rows = rows.withColumn("row_id", F.concat(F.lit(f"{run_id}:"), number)).drop(OUTCOME)
    rows.write.mode("overwrite").parquet(path)
    delete_path(spark, f"{staged.path}/{OUTCOME}={QUARANTINED}")
    return path


def read_quarantine(
    spark: SparkSession, quarantine_root: str, data: T.StructType, audit: DataFrame | None = None
) -> DataFrame:
    """Quarantined rows; with ``audit``, of committed runs only. An aborted run leaves its
    rows behind until it is retried under the same id."""
    text = T.StringType()
    schema = T.StructType(
        list(data.fields)
        + [
            T.StructField(CODES, T.ArrayType(text)),
            T.StructField("_ingestion_ts", T.TimestampType()),
            T.StructField("_source_name", text),
            T.StructField("row_id", text),
            T.StructField("source_name", text),
            T.StructField(RUN_ID, text),
        ]
    )
    if not path_exists(spark, quarantine_root):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(quarantine_root)
    if audit is None:
        return rows
    runs = committed_runs(audit).select("source_name", F.col("run_id").alias(RUN_ID))
    return rows.join(runs, ["source_name", RUN_ID], "left_semi")


def bronze_schema(data: T.StructType, partition_by: Sequence[str] = ()) -> T.StructType:
    text = T.StringType()
    inner = list(partition_by)
    stored = stored_schema(data, inner)
    leading = [f for f in stored.fields if f.name not in [OUTCOME, *inner]]
    directories = [T.StructField(n, text) for n in ("source_name", "ingestion_date", RUN_ID)]
    return T.StructType(
        leading + directories + [T.StructField(OUTCOME, text)] + [data[n] for n in inner]
    )


def read_bronze(
    spark: SparkSession,
    root: str,
    audit: DataFrame,
    data: T.StructType,
    *,
    partition_by: Sequence[str] = (),
    sources: Sequence[str] | None = None,
    compacted_root: str | None = None,
) -> DataFrame:
    """Rows of committed runs with the four metadata and two partition columns.

    The join on the run id prunes run directories dynamically, and the outcome filter
    prunes the quarantined ones, so files of crashed runs are not opened. ``sources``
    names the sources to read; all must share one data schema and partition layout.
    Compacted days replace the runs they were made of.
    """
    names = [f.name for f in data.fields]
    seal = _seals(audit, sources)
    raw = _clean_rows(spark, root, data, partition_by, sources)
    if compacted_root is None or not path_exists(spark, compacted_root):
        rows = _sealed_rows(raw, seal)
    else:
        done = read_compactions(spark, compacted_root)
        merged = _compacted_rows(spark, compacted_root, data, done).select(*raw.columns)
        rows = _sealed_rows(raw, _still_open(seal, done)).unionByName(_sealed_rows(merged, seal))
    return rows.select(*names, *METADATA, "ingestion_date", "source_name")


def _seals(audit: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """One row per committed run with rows: run, source, date and checksum."""
    wanted = committed_runs(audit).where("checksum <> ''")
    if sources is not None:
        wanted = wanted.where(F.col("source_name").isin(list(sources)))
    return wanted.select(
        F.col("run_id").alias("_seal_run"),
        F.col("source_name").alias("_seal_source"),
        F.regexp_extract("bronze_path", "ingestion_date=([^/]+)", 1).alias("_seal_date"),
        F.col("checksum").alias("_checksum"),
        F.col("records_written").alias("_seal_rows"),
        F.col("schema_json").alias("_seal_schema"),
    ).dropDuplicates(["_seal_run", "_seal_source"])


def _still_open(seal: DataFrame, done: DataFrame) -> DataFrame:
    """Seals of runs no compaction has replaced. Taking the replaced runs out of this small
    table, not out of the rows, lets the join prune their directories."""
    replaced = done.select(
        F.col("source_name").alias("_seal_source"), F.col("run_id").alias("_seal_run")
    ).distinct()
    return seal.join(replaced, ["_seal_source", "_seal_run"], "left_anti")


def _clean_rows(spark, root, data, partition_by, sources=None) -> DataFrame:
    paths = [root] if sources is None else [f"{root}/source_name={s}" for s in sources]
    reader = spark.read.schema(bronze_schema(data, partition_by)).option("basePath", root)
    names = [f.name for f in data.fields]
    stored = ["_ingestion_ts", "_source_name", RUN_ID, "ingestion_date", "source_name"]
    return reader.parquet(*paths).where(F.col(OUTCOME) == CLEAN).select(*names, *stored)


def _sealed_rows(rows: DataFrame, seal: DataFrame) -> DataFrame:
    """Rows of sealed runs with their checksum. The date is compared too: an attempt that
    crashed the day before left files under the same run id."""
    same_run = (
        (F.col(RUN_ID) == F.col("_seal_run"))
        & (F.col("source_name") == F.col("_seal_source"))
        & (F.col("ingestion_date") == F.col("_seal_date"))
    )
    return rows.join(seal, same_run)


# --- compaction -------------------------------------------------------------------

COMPACTION_SCHEMA = "compaction_id STRING, source_name STRING, run_id STRING, ingestion_date STRING"


def read_compactions(spark: SparkSession, compacted_root: str) -> DataFrame:
    log = f"{compacted_root}/log"
    if not path_exists(spark, log):
        return spark.createDataFrame([], COMPACTION_SCHEMA)
    return spark.read.schema(COMPACTION_SCHEMA).parquet(log)


def _compacted_rows(spark, compacted_root, data, done) -> DataFrame:
    text = T.StringType()
    schema = T.StructType(
        list(data.fields)
        + [
            T.StructField("_ingestion_ts", T.TimestampType()),
            T.StructField("_source_name", text),
            T.StructField(RUN_ID, text),
            T.StructField("compaction_id", text),
            T.StructField("source_name", text),
            T.StructField("ingestion_date", text),
        ]
    )
    if not path_exists(spark, f"{compacted_root}/data"):
        return spark.createDataFrame([], schema)
    finished = done.select("compaction_id", "source_name", "ingestion_date").distinct()
    rows = spark.read.schema(schema).parquet(f"{compacted_root}/data")
    return rows.join(finished, ["compaction_id", "source_name", "ingestion_date"], "left_semi")


def compact(
    spark: SparkSession,
    root: str,
    compacted_root: str,
    audit: DataFrame,
    data: T.StructType,
    compaction_id: str,
    *,
    source_name: str,
    before: str,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Merge the small files of a source's closed days (``ingestion_date < before``).

    The rows of all committed runs of a day are rewritten into files of AQE's advisory
    partition size, below the configured partition columns; a day or value holding most
    of the rows is split, small ones are merged. Runs are copied with the schema that was
    committed with them, runs of each schema apart; ``data`` serves runs without one. A copy
    replaces its runs only after count and checksum of every run agree with the audit row,
    which was sealed when the run was written. Returns the days that were copied
    ``(source_name, ingestion_date, row_count, checksum)``, by schema.
    """
    check_path_safe("compaction_id", compaction_id)
    days = ["source_name", "ingestion_date"]
    done = read_compactions(spark, compacted_root)
    seals = _still_open(_seals(audit, [source_name]), done).where(F.col("_seal_date") < before)
    schemas = [r[0] for r in seals.select("_seal_schema").distinct().collect()]
    copies = []
    for number, text in enumerate(sorted(schemas, key=str)):
        schema = data if text is None else T.StructType.fromJson(json.loads(text))
        mine = seals.where(F.col("_seal_schema").eqNullSafe(F.lit(text)))
        copy_id = compaction_id if len(schemas) == 1 else f"{compaction_id}.{number}"
        copied = _copy_runs(spark, root, compacted_root, mine, schema, copy_id, source_name, partition_by)
        names = [f.name for f in schema.fields]
        copies.append(checksum_by(copied.select(*{*names, *days}), days, names))
    if not copies:
        return spark.createDataFrame(
            [], "source_name STRING, ingestion_date STRING, row_count BIGINT, checksum STRING"
        )
    out = copies[0]
    for more in copies[1:]:
        out = out.unionByName(more)
    return out.select(*days, "row_count", "checksum")


def _copy_runs(
    spark, root, compacted_root, seals, schema, copy_id, source_name, partition_by
) -> DataFrame:
    """Write one compaction of runs that share a schema, prove it and list it."""
    names = [f.name for f in schema.fields]
    kept = [*names, "_ingestion_ts", "_source_name", RUN_ID]
    inner = [c for c in partition_by if c in names]
    directories = ["source_name", "ingestion_date", *inner]
    closed = _sealed_rows(_clean_rows(spark, root, schema, inner, [source_name]), seals)
    target = f"{compacted_root}/data/compaction_id={copy_id}"
    (
        closed.select(*kept, "source_name", "ingestion_date")
        .hint("rebalance", *[F.col(d) for d in directories])
        .write.mode("overwrite")
        .partitionBy(*directories)
        .parquet(target)
    )
    text = T.StringType()
    stored = T.StructType(
        list(schema.fields)
        + [
            T.StructField("_ingestion_ts", T.TimestampType()),
            T.StructField("_source_name", text),
            T.StructField(RUN_ID, text),
            T.StructField("source_name", text),
            T.StructField("ingestion_date", text),
        ]
    )
    copied = spark.read.schema(stored).parquet(target)
    found = checksum_by(copied.select(*{*names, RUN_ID}), [RUN_ID], names)
    check = seals.join(found, F.col("_seal_run") == F.col(RUN_ID), "left")
    same = (F.coalesce("row_count", F.lit(0)) == F.col("_seal_rows")) & (
        (F.col("_seal_rows") == 0) | F.col("checksum").eqNullSafe(F.col("_checksum"))
    )
    if not check.where(~F.coalesce(same, F.lit(False))).isEmpty():
        raise StorageWriteError(target, "compacted runs differ from what was sealed")
    log = seals.select(
        F.lit(copy_id).alias("compaction_id"),
        F.col("_seal_source").alias("source_name"),
        F.col("_seal_run").alias("run_id"),
        F.col("_seal_date").alias("ingestion_date"),
    )
    log.write.mode("append").parquet(f"{compacted_root}/log")
    return copied
