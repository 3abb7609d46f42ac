from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from tests.conftest import plan_of, rows_of

from sparkingest.operators.quality import (
    CODES,
    Completeness,
    CorruptRecord,
    Pattern,
    Range,
    Referential,
    Timeliness,
    TypeConformance,
    classify,
    settle_batch_rules,
    completeness_metrics,
    quarantine_rate,
    revalidate,
    split,
)


def codes(df):
    return {r.id: list(r[CODES]) for r in df.collect()}


def test_null_passes_all_but_completeness(spark):
    df = spark.createDataFrame([(1, None, None, None)], "id INT, n BIGINT, s STRING, t TIMESTAMP")
    rules = [
        Range("n", 0, 10),
        Pattern("s", "^x$"),
        Timeliness("t", 1, dt.datetime(2024, 1, 1)),
        TypeConformance("s", "BIGINT"),
        Referential("n", spark.range(5), "id"),
        Completeness(("n",)),
    ]
    assert codes(classify(df, rules)) == {1: ["NULL_IN_REQUIRED_COLUMN"]}


def test_bounds_are_inclusive_and_may_be_open(spark):
    df = spark.createDataFrame([(i, i) for i in range(-1, 12)], "id INT, n INT")
    broken = [k for k, v in codes(classify(df, [Range("n", 0, 10)])).items() if v]
    assert sorted(broken) == [-1, 11]
    assert not any(codes(classify(df, [Range("n")])).values())
    assert [k for k, v in codes(classify(df, [Range("n", maximum=10)])).items() if v] == [11]


def test_staleness_boundary(spark):
    as_of = dt.datetime(2024, 1, 2)
    rows = [(1, as_of - dt.timedelta(hours=24)), (2, as_of - dt.timedelta(hours=24, seconds=1))]
    df = spark.createDataFrame(rows, "id INT, t TIMESTAMP")
    assert codes(classify(df, [Timeliness("t", 24, as_of)])) == {1: [], 2: ["STALE_RECORD"]}


def test_codes_collect_in_rule_order_without_repeats(spark):
    df = spark.createDataFrame([(1, "x", "raw")], "id INT, n STRING, _corrupt_record STRING")
    rules = [TypeConformance("n", "INT"), CorruptRecord(), TypeConformance("n", "DATE")]
    assert codes(classify(df, rules)) == {1: ["SCHEMA_TYPE_MISMATCH", "CORRUPT_RECORD"]}


def test_no_rules_means_clean(spark):
    clean, held = split(classify(spark.range(3), []))
    assert (clean.count(), held.count()) == (3, 0)


def test_completeness_metrics_of_an_empty_batch(spark):
    empty = spark.createDataFrame([], "a INT")
    row = completeness_metrics(empty, Completeness(("a",), 0.9)).first()
    assert (row.total, row.rate, row.passed) == (0, None, True)


@pytest.fixture
def feed(spark):
    """A third of the rows share one orphaned key; nulls occur."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 100)
    return spark.range(3000).select("id", F.when(F.col("id") % 50 != 1, hot).alias("k"))


@pytest.mark.parametrize("limit", ["10MB", "1b", "-1"])
def test_referential_under_any_plan(spark, feed, conf, limit):
    """Broadcast or not, repeated and null reference keys included."""
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    reference = (
        spark.range(100)
        .where("id % 10 <> 7")
        .select(F.col("id").alias("r"))
        .unionByName(spark.range(40).select(F.col("id").alias("r")).where("id % 10 <> 7"))
        .unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS r"))
    )
    rule = Referential("k", reference, "r")
    flagged = classify(feed, [rule])
    assert flagged.count() == 3000
    expected = {
        r.id: ["ORPHAN_REFERENCE"] if r.k is not None and r.k % 10 == 7 else []
        for r in feed.collect()
    }
    assert codes(flagged) == expected


def test_completeness_threshold_is_decided_on_the_batch(spark):
    rows = spark.range(100).select("id", F.when(F.col("id") != 5, F.col("id")).alias("v"))
    met, missed = Completeness(("v",), 0.95), Completeness(("v",), 0.999)
    assert settle_batch_rules(rows, [met]) == []
    assert settle_batch_rules(rows, [missed]) == [missed]
    assert settle_batch_rules(rows.limit(0), [missed]) == []
    strict = Completeness(("v",))
    assert settle_batch_rules(rows, [strict]) == [strict]


def test_split_keeps_every_row(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders = orders.unionByName(orders.limit(50))
    flagged = classify(orders, [Range("o_totalprice", 0, 300000)])
    clean, held = split(flagged)
    both = clean.unionByName(held.drop(CODES))
    assert both.exceptAll(orders).isEmpty() and orders.exceptAll(both).isEmpty()
    assert not clean.isEmpty() and not held.isEmpty()


def test_quarantine_rate_alert_is_strict(spark):
    flagged = classify(spark.range(20), [Range("id", 1)])
    row = quarantine_rate(flagged, 0.05).first()
    assert (row.total, row.quarantined, row.rate, row.alert) == (20, 1, 0.05, False)
    assert quarantine_rate(flagged, 0.04).first().alert
    assert not quarantine_rate(flagged.where("id < 0"), 0.0).first().alert


def test_revalidate_skips_released_rows(spark):
    held = spark.createDataFrame(
        [("r:1", 5, ["RANGE_VIOLATION"]), ("r:2", 50, ["RANGE_VIOLATION"]), ("r:3", 6, ["X"])],
        f"row_id STRING, n INT, {CODES} ARRAY<STRING>",
    )
    done = spark.createDataFrame([("r:3",)], "row_id STRING")
    released, kept = revalidate(held, [Range("n", 0, 10)], done)
    assert rows_of(released.select("row_id")) == [("r:1",)]
    assert rows_of(kept.select("row_id", CODES)) == [("r:2", ["RANGE_VIOLATION"])]
