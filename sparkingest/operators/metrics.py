"""Run metrics, SLA and coverage reports, gaps and reconciliation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkingest.errors import ConfigurationError
from sparkingest.functions.fingerprint import checksum_by
from sparkingest.operators.audit import FAILURE


def run_seconds() -> Column:
    """Duration of an audit row in whole seconds."""
    return F.unix_timestamp("pipeline_end_ts") - F.unix_timestamp("pipeline_start_ts")


def sla_breaches(
    audit: DataFrame, threshold_seconds: int | None = None, deadline: str | None = None
) -> DataFrame:
    """Runs over the duration limit or, with ``deadline`` ("HH:mm"), ended after it on
    the day they started."""
    slow = F.lit(False) if threshold_seconds is None else run_seconds() > threshold_seconds
    late = F.lit(False)
    if deadline is not None:
        hours, minutes = (int(part) for part in deadline.split(":"))
        allowed = F.date_trunc("day", "pipeline_start_ts") + F.lit(
            dt.timedelta(hours=hours, minutes=minutes)
        )
        late = F.col("pipeline_end_ts") > allowed
    report = audit.withColumns(
        {"duration_seconds": run_seconds(), "too_slow": slow, "past_deadline": late}
    )
    return report.where("too_slow OR past_deadline")


def run_metrics(audit: DataFrame, by: Sequence[str] = ("source_name",)) -> DataFrame:
    """Throughput, duration, quality pass rate and quarantine rate per group."""
    totals = audit.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") == FAILURE).alias("failed_runs"),
        F.sum("records_read").alias("records_read"),
        F.sum("records_written").alias("records_written"),
        F.sum("quarantine_count").alias("quarantine_count"),
        F.sum(run_seconds()).alias("duration_seconds"),
    )
    read = F.col("records_read").cast("double")
    written = F.col("records_written").cast("double")
    return totals.withColumns(
        {
            "rows_per_minute": F.try_divide(
                written * 60, F.col("duration_seconds").cast("double")
            ),
            "quality_pass_rate": F.try_divide(written, read),
            "quarantine_rate": F.try_divide(F.col("quarantine_count").cast("double"), read),
        }
    )


def coverage(seen: DataFrame, expected: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Share of the expected keys of each group that occur in ``seen``, in percent."""
    present = seen.select(key).distinct().withColumn("_present", F.lit(True))
    counts = (
        expected.select(*by, key)
        .distinct()
        .join(present, key, "left")
        .groupBy(*by)
        .agg(F.count(key).alias("expected"), F.count("_present").alias("seen"))
    )
    percent = F.try_divide(F.col("seen") * F.lit(100.0), F.col("expected").cast("double"))
    return counts.withColumn("coverage_percent", percent)


def quality_trend(
    daily: DataFrame, source: str, day: str, total: str, passed: str, window_days: int = 7
) -> DataFrame:
    """Pass rate per day, change to the day before and rate over the last rows.

    ``daily`` holds one row per source and day, so a window holds days, not records.
    """
    ordered = Window.partitionBy(source).orderBy(day)
    recent = ordered.rowsBetween(1 - window_days, Window.currentRow)
    rate = F.try_divide(F.col(passed).cast("double"), F.col(total).cast("double"))
    moving = F.try_divide(
        F.sum(passed).over(recent).cast("double"), F.sum(total).over(recent).cast("double")
    )
    return (
        daily.withColumns({"pass_rate": rate, "moving_pass_rate": moving})
        .withColumn("previous_pass_rate", F.lag("pass_rate").over(ordered))
        .withColumn("change", F.col("pass_rate") - F.col("previous_pass_rate"))
    )


# How many fine buckets make a coarse one; bounds the rows of a window group.
_COARSE = 4096


def _start_of(micros: str, width: int) -> Column:
    """Start of the bucket of ``width`` microseconds, in whole numbers."""
    return F.col(micros) - F.pmod(F.col(micros), F.lit(width).cast("bigint"))


def detect_gaps(df: DataFrame, key: str, ts: str, threshold: dt.timedelta) -> DataFrame:
    """Silences longer than ``threshold``: ``(key, gap_start, gap_end, gap_seconds)``.

    Two records in one bucket of the threshold's width cannot bound such a gap, so only
    each bucket's first and last time matter. They come from a map-side aggregate, and
    windows run over buckets instead of records: at most 4096 per group, then over one
    row per 4096 buckets. A key holding a third of all records costs no more.
    """
    width = threshold // dt.timedelta(microseconds=1)
    if width <= 0:
        raise ConfigurationError("threshold", "must be positive")
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    buckets = (
        df.where(F.col(ts).isNotNull())
        .withColumn("_us", micros)
        .groupBy(F.col(key), _start_of("_us", width).alias("_bucket"))
        .agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"))
        .withColumn("_coarse", _start_of("_bucket", min(width * _COARSE, 2**62)))
    )
    fine = Window.partitionBy(key, "_coarse").orderBy("_bucket")
    inside = buckets.withColumn("_previous", F.lag("_last").over(fine)).where(
        "_previous IS NOT NULL"
    )
    coarse = buckets.groupBy(key, "_coarse").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last")
    )
    across = coarse.withColumn(
        "_previous", F.lag("_last").over(Window.partitionBy(key).orderBy("_coarse"))
    ).where("_previous IS NOT NULL")
    columns = [key, "_previous", "_first"]
    gaps = inside.select(*columns).unionByName(across.select(*columns))
    return gaps.where(F.col("_first") - F.col("_previous") > F.lit(width)).select(
        key,
        F.timestamp_micros("_previous").alias("gap_start"),
        F.timestamp_micros("_first").alias("gap_end"),
        ((F.col("_first") - F.col("_previous")) / F.lit(1_000_000)).alias("gap_seconds"),
    )


def covered_intervals(df: DataFrame, key: str, ts: str, threshold: dt.timedelta) -> DataFrame:
    """``key, first_us, last_us``: the times of each key as stretches without a silence longer
    than ``threshold``, in microseconds. Null times count for nothing, a null key is a key.

    This is the state of an incremental gap detection: ``merge_intervals`` adds a batch's to
    it, in any order and more than once, and ``interval_gaps`` reads the gaps off.
    """
    width = _width(threshold)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    buckets = (
        df.where(F.col(ts).isNotNull())
        .withColumn("_us", micros)
        .groupBy(F.col(key), _start_of("_us", width).alias("_bucket"))
        .agg(F.min("_us").alias("first_us"), F.max("_us").alias("last_us"))
    )
    return _coalesced(buckets.select(key, "first_us", "last_us"), key, width)


def merge_intervals(
    state: DataFrame, batch: DataFrame, key: str, threshold: dt.timedelta
) -> DataFrame:
    """The intervals of both, coalesced. The union is idempotent and has no order: a batch
    that comes late closes gaps, and one that is merged again changes nothing."""
    columns = [key, "first_us", "last_us"]
    # One interval a start, so that windows over starts have no ties.
    both = (
        state.select(columns)
        .unionByName(batch.select(columns))
        .groupBy(key, "first_us")
        .agg(F.max("last_us").alias("last_us"))
    )
    return _coalesced(both, key, _width(threshold))


def interval_gaps(state: DataFrame, key: str, threshold: dt.timedelta) -> DataFrame:
    """The gaps between coalesced intervals, as ``detect_gaps`` over all their records."""
    seen = _reached(state.select(key, "first_us", "last_us"), key, _width(threshold))
    return seen.where("_reach IS NOT NULL").select(
        key,
        F.timestamp_micros("_reach").alias("gap_start"),
        F.timestamp_micros("first_us").alias("gap_end"),
        ((F.col("first_us") - F.col("_reach")) / F.lit(1_000_000)).alias("gap_seconds"),
    )


def _width(threshold: dt.timedelta) -> int:
    width = threshold // dt.timedelta(microseconds=1)
    if width <= 0:
        raise ConfigurationError("threshold", "must be positive")
    return width


def _carried(rows: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the greatest ``value`` in earlier chunks of the key.

    Chunks are aggregated first, so one task sees a row a chunk of a hot key, not its rows.
    """
    earlier = (
        Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    chunks = (
        rows.groupBy(F.col(key).alias("_key"), "_chunk")
        .agg(F.max(value).alias("_most"))
        .select(
            "_key",
            F.col("_chunk").alias("_at"),
            F.max("_most").over(earlier).alias(name),
        )
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_chunk") == F.col("_at"))
    return rows.join(chunks, same).drop("_key", "_at")


def _reached(intervals: DataFrame, key: str, width: int) -> DataFrame:
    """Each interval with ``_reach``, the latest time that those before it cover."""
    before = (
        Window.partitionBy(key, "_chunk")
        .orderBy("first_us", "last_us")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    chunked = intervals.withColumn("_chunk", _start_of("first_us", min(width * _COARSE, 2**62)))
    inside = chunked.withColumn("_inside", F.max("last_us").over(before))
    return _carried(inside, key, F.col("last_us"), "_earlier").select(
        key, "first_us", "last_us", "_chunk", F.greatest("_inside", "_earlier").alias("_reach")
    )


def _coalesced(intervals: DataFrame, key: str, width: int) -> DataFrame:
    """Intervals at most ``width`` apart become one, by chunks of the key's time."""
    so_far = (
        Window.partitionBy(key, "_chunk")
        .orderBy("first_us", "last_us")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    opens = F.col("_reach").isNull() | (F.col("first_us") - F.col("_reach") > F.lit(width))
    opened = _reached(intervals, key, width).withColumn("_open", F.when(opens, F.col("first_us")))
    inside = opened.withColumn("_inside", F.max("_open").over(so_far))
    return (
        _carried(inside, key, F.col("_open"), "_earlier")
        # The interval that opened last before this one, here or in an earlier chunk.
        .groupBy(key, F.coalesce("_inside", "_earlier").alias("first_us"))
        .agg(F.max("last_us").alias("last_us"))
    )


def reconcile(
    source: DataFrame, target: DataFrame, by: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Counts and checksums of both sides per group, joined outer, with a verdict.

    Both sides shrink to one row per group before they meet.
    """
    by = list(by)
    left, right = (
        checksum_by(df.select(*by, *columns), by, columns).withColumnsRenamed(
            {"row_count": f"{side}_rows", "checksum": f"{side}_checksum"}
            | {name: f"_{side}_{name}" for name in by}
        )
        for df, side in ((source, "source"), (target, "target"))
    )
    same_group = reduce(
        and_, [F.col(f"_source_{name}").eqNullSafe(F.col(f"_target_{name}")) for name in by]
    )
    verdict = (
        F.when(F.col("target_rows").isNull(), F.lit("MISSING_IN_TARGET"))
        .when(F.col("source_rows").isNull(), F.lit("MISSING_IN_SOURCE"))
        .when(F.col("source_rows") != F.col("target_rows"), F.lit("COUNT_MISMATCH"))
        .when(F.col("source_checksum") != F.col("target_checksum"), F.lit("CONTENT_MISMATCH"))
        .otherwise(F.lit("MATCH"))
    )
    both = left.join(right, same_group, "full_outer")
    keys = [F.coalesce(f"_source_{name}", f"_target_{name}").alias(name) for name in by]
    sides = ["source_rows", "target_rows", "source_checksum", "target_checksum"]
    return both.select(*keys, *sides, verdict.alias("verdict"))
