from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.conftest import plan_of

from sparkingest.errors import ConnectorError
from sparkingest.operators.watermark import (
    CHECKPOINT_SCHEMA,
    INTEGER,
    TIMESTAMP,
    Watermark,
    append_watermark,
    decode_watermarks,
    incremental_scan,
    latest_watermarks,
    next_watermark,
    read_log,
    read_watermark,
    watermark_kind,
)

AT = dt.datetime(2024, 1, 1)


def test_round_trip_of_both_kinds_and_several_sources(spark, tmp_path):
    path = f"{tmp_path}/log"
    assert read_watermark(spark, path, "a") is None
    moment = dt.datetime(2024, 1, 1, 12, 30, 0, 123456)
    append_watermark(spark, path, "a", Watermark(TIMESTAMP, ts=moment), AT, "r1")
    append_watermark(spark, path, "b", Watermark(INTEGER, integer=42), AT, "r1")
    assert read_watermark(spark, path, "a") == Watermark(TIMESTAMP, ts=moment)
    assert read_watermark(spark, path, "b") == Watermark(INTEGER, integer=42)
    assert read_watermark(spark, path, "c") is None


def test_newest_entry_wins_and_ties_go_by_run(spark, tmp_path):
    path = f"{tmp_path}/log"
    for value, at, run in ((5, AT, "r2"), (9, AT - dt.timedelta(1), "r9"), (7, AT, "r3")):
        append_watermark(spark, path, "a", Watermark(INTEGER, integer=value), at, run)
    assert read_watermark(spark, path, "a").integer == 7


@pytest.mark.parametrize(
    ("tag", "message"),
    [
        ("TIMESTAMP", "a time mark without its time"),
        ("INTEGER", "a number mark without its number"),
        ("LSN", "no such kind of mark: LSN"),
        (None, "no such kind of mark: null"),
    ],
)
def test_unreadable_entries(spark, tmp_path, tag, message):
    log = spark.createDataFrame([("a", tag, None, None, AT, "r")], CHECKPOINT_SCHEMA)
    assert message in decode_watermarks(log).first()["error"]
    log.write.parquet(f"{tmp_path}/log")
    with pytest.raises(ConnectorError, match=message.split(":")[0]):
        read_watermark(spark, f"{tmp_path}/log", "a")


@pytest.mark.parametrize(
    ("data_type", "kind"),
    [
        ("INT", INTEGER),
        ("BIGINT", INTEGER),
        ("DECIMAL(18,0)", INTEGER),
        ("TIMESTAMP", TIMESTAMP),
        ("TIMESTAMP_NTZ", TIMESTAMP),
        ("DATE", TIMESTAMP),
    ],
)
def test_kinds(spark, data_type, kind):
    assert watermark_kind(T.StructType.fromDDL(f"c {data_type}")["c"].dataType) == kind


@pytest.mark.parametrize("data_type", ["STRING", "DOUBLE", "DECIMAL(38,10)"])
def test_other_types_are_refused(spark, data_type):
    with pytest.raises(ConnectorError, match="unsupported"):
        watermark_kind(T.StructType.fromDDL(f"c {data_type}")["c"].dataType)


def test_empty_batch_gives_no_entry(spark):
    empty = spark.createDataFrame([], "id BIGINT")
    assert next_watermark(empty, "id", "a", F.lit(AT), "r").isEmpty()
    nulls = spark.createDataFrame([(None,)], "id BIGINT")
    assert next_watermark(nulls, "id", "a", F.lit(AT), "r").isEmpty()


@pytest.mark.parametrize("data_type", ["TIMESTAMP", "TIMESTAMP_NTZ", "DATE"])
def test_strict_comparison_per_type(spark, data_type):
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(d,) for d in days], "t TIMESTAMP")
    df = df.select(F.col("t").cast(data_type).alias("t"))
    mark = Watermark(TIMESTAMP, ts=days[1])
    assert incremental_scan(df, "t", mark).count() == 1
    assert incremental_scan(df, "t", mark, lag_seconds=1).count() == 2
    assert incremental_scan(df, "t", None).count() == 3


def test_two_incremental_runs(spark, tmp_path):
    path = f"{tmp_path}/log"
    first = spark.range(1, 6)
    row = next_watermark(first, "id", "s", F.lit(AT), "r1").first()
    append_watermark(spark, path, "s", Watermark(INTEGER, integer=row.watermark_int), AT, "r1")
    second = incremental_scan(spark.range(1, 8), "id", read_watermark(spark, path, "s"))
    assert sorted(r.id for r in second.collect()) == [6, 7]


def test_latest_aggregates_before_the_shuffle(spark, tmp_path):
    append_watermark(spark, f"{tmp_path}/l", "a", Watermark(INTEGER, integer=1), AT, "r")
    plan = plan_of(latest_watermarks(read_log(spark, f"{tmp_path}/l")))
    assert plan.index("functions=[max_by") < plan.index("Exchange") < plan.rindex("partial_max_by")
