"""Extraction watermarks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sparkingest.operators.watermark import (
    INTEGER,
    TIMESTAMP,
    Watermark,
    decode_watermarks,
    incremental_scan,
    latest_watermarks,
    next_watermark,
    read_log,
    read_watermark,
)
from sparkingest.plans.catalog import day, prepared, query, sql_day, table
from sparkingest.session import timestamp_literal

_CUT = dt.datetime(1999, 6, 1)


@query(
    "incremental_ts",
    f"""SELECT o_orderkey, {sql_day('o_orderdate')} AS o_orderdate FROM orders
        WHERE o_orderdate > TIMESTAMP '1999-06-01 00:00:00'""",
)
def incremental_ts(spark, sf_dir):
    newer = incremental_scan(
        table(spark, sf_dir, "orders"), "o_orderdate", Watermark(TIMESTAMP, ts=_CUT)
    )
    return newer.select("o_orderkey", day("o_orderdate").alias("o_orderdate"))


@query("incremental_int", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 700")
def incremental_int(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    newer = incremental_scan(orders, "o_orderkey", Watermark(INTEGER, integer=700))
    return newer.select("o_orderkey", "o_custkey")


@query(
    "incremental_lag",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_orderdate > TIMESTAMP '1999-05-25 00:00:00'""",
)
def incremental_lag(spark, sf_dir):
    """A week behind the mark is read again; the repeats fall to the merge key."""
    orders = table(spark, sf_dir, "orders")
    mark = Watermark(TIMESTAMP, ts=_CUT)
    first = orders.where(F.col("o_orderdate") > timestamp_literal(_CUT).cast("timestamp_ntz"))
    again = incremental_scan(orders, "o_orderdate", mark, lag_seconds=7 * 24 * 3600)
    columns = ["o_orderkey", "o_custkey"]
    return first.select(*columns).unionByName(again.select(*columns)).dropDuplicates(["o_orderkey"])


def _first_slice(spark, sf_dir):
    """What the source held at the first run."""
    orders = table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderdate") <= timestamp_literal(_CUT).cast("timestamp_ntz"))


def _checkpoint(spark, sf_dir):
    """Checkpoint table after the first run over the first slice."""

    def advance(path):
        at = F.lit(dt.datetime(2024, 1, 1, 3))
        by_date = _first_slice(spark, sf_dir)
        by_key = table(spark, sf_dir, "orders").where("o_orderkey <= 500")
        for batch, column, source in (
            (by_date, "o_orderdate", "orders-by-date"),
            (by_key, "o_orderkey", "orders-by-key"),
        ):
            row = next_watermark(batch, column, source, at, "run-1")
            row.write.mode("append").parquet(path)

    return prepared(spark, sf_dir, "watermarks", advance)


@query(
    "incremental_first_run",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_orderdate <= TIMESTAMP '1999-06-01 00:00:00'""",
)
def incremental_first_run(spark, sf_dir):
    """No checkpoint for the source: the whole slice is read."""
    mark = read_watermark(spark, _checkpoint(spark, sf_dir), "never-read")
    slice_ = incremental_scan(_first_slice(spark, sf_dir), "o_orderdate", mark)
    return slice_.select("o_orderkey", "o_custkey")


@query(
    "incremental_second_run",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >
         (SELECT max(o_orderdate) FROM orders
          WHERE o_orderdate <= TIMESTAMP '1999-06-01 00:00:00')""",
)
def incremental_second_run(spark, sf_dir):
    mark = read_watermark(spark, _checkpoint(spark, sf_dir), "orders-by-date")
    newer = incremental_scan(table(spark, sf_dir, "orders"), "o_orderdate", mark)
    return newer.select("o_orderkey", "o_custkey")


@query(
    "watermark_max",
    """SELECT 'lineitem' AS source_id, 'TIMESTAMP' AS watermark_type,
              strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS watermark FROM lineitem
       UNION ALL
       SELECT 'orders', 'INTEGER', CAST(max(o_orderkey) AS VARCHAR) FROM orders""",
)
def watermark_max(spark, sf_dir):
    at = F.lit(dt.datetime(2024, 1, 1))
    by_date = next_watermark(table(spark, sf_dir, "lineitem"), "l_shipdate", "lineitem", at, "r")
    by_key = next_watermark(table(spark, sf_dir, "orders"), "o_orderkey", "orders", at, "r")
    text = F.coalesce(
        F.date_format("watermark_ts", "yyyy-MM-dd HH:mm:ss"), F.col("watermark_int").cast("string")
    )
    rows = by_date.unionByName(by_key)
    return rows.select("source_id", "watermark_type", text.alias("watermark"))


@query(
    "watermark_advance",
    """SELECT 'orders-by-key' AS source_id, 'INTEGER' AS watermark_type,
              CAST(max(o_orderkey) AS VARCHAR) AS value, 'run-2' AS run_id FROM orders
       UNION ALL
       SELECT 'orders-by-date', 'TIMESTAMP',
              strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%f'), 'run-2' FROM orders""",
)
def watermark_advance(spark, sf_dir):
    """State of the log after a second run moved both sources."""

    def advance(path):
        read_log(spark, _checkpoint(spark, sf_dir)).write.parquet(path)
        for column, source in (("o_orderdate", "orders-by-date"), ("o_orderkey", "orders-by-key")):
            mark = read_watermark(spark, path, source)
            batch = incremental_scan(table(spark, sf_dir, "orders"), column, mark)
            row = next_watermark(batch, column, source, F.lit(dt.datetime(2024, 1, 2)), "run-2")
            row.write.mode("append").parquet(path)

    log = read_log(spark, prepared(spark, sf_dir, "watermarks-advanced", advance))
    state = decode_watermarks(latest_watermarks(log))
    return state.select("source_id", "watermark_type", "value", "run_id")


def log_of_orders(orders):
    """One checkpoint entry per order: customers are sources, and those with an even key
    share source ``busy``, which therefore holds about half of the log."""
    key = F.col("o_orderkey")
    source = F.when(F.col("o_custkey") % 2 == 0, F.lit("busy")).otherwise(
        F.concat(F.lit("customer-"), F.col("o_custkey").cast("string"))
    )
    return orders.select(
        source.alias("source_id"),
        F.when(key % 2 == 0, F.lit(INTEGER)).otherwise(F.lit(TIMESTAMP)).alias("watermark_type"),
        F.when(key % 2 == 1, F.col("o_orderdate").cast("timestamp")).alias("watermark_ts"),
        F.when(key % 2 == 0, key).alias("watermark_int"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.lpad(key.cast("string"), 12, "0").alias("run_id"),
    )


_LOG_SQL = """
  SELECT CASE WHEN o_custkey % 2 = 0 THEN 'busy' ELSE 'customer-' || o_custkey END AS source_id,
         CASE WHEN o_orderkey % 2 = 0 THEN 'INTEGER' ELSE 'TIMESTAMP' END AS watermark_type,
         CASE WHEN o_orderkey % 2 = 1 THEN o_orderdate END AS watermark_ts,
         CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS watermark_int,
         o_orderdate AS updated_at, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS run_id
  FROM orders"""

_STATE_SQL = f"""
  SELECT source_id, watermark_type,
         coalesce(strftime(watermark_ts, '%Y-%m-%d %H:%M:%S.%f'),
                  CAST(watermark_int AS VARCHAR)) AS value,
         {sql_day('updated_at')} AS updated_on, run_id
  FROM (SELECT *, row_number() OVER (PARTITION BY source_id
                                     ORDER BY updated_at DESC, run_id DESC) AS rn
        FROM ({_LOG_SQL})) WHERE rn = 1"""


def _state(log):
    return decode_watermarks(latest_watermarks(log)).select(
        "source_id", "watermark_type", "value", day("updated_at").alias("updated_on"), "run_id"
    )


@query("watermark_latest", _STATE_SQL)
def watermark_latest(spark, sf_dir):
    return _state(log_of_orders(table(spark, sf_dir, "orders")))


@query("watermark_upsert", _STATE_SQL)
def watermark_upsert(spark, sf_dir):
    """Two appends to a stored log: sources seen before move, new ones appear."""

    def append(path):
        orders = table(spark, sf_dir, "orders")
        old = F.col("o_orderdate") <= timestamp_literal(_CUT).cast("timestamp_ntz")
        log_of_orders(orders.where(old)).write.parquet(path)
        log_of_orders(orders.where(~old)).write.mode("append").parquet(path)

    return _state(read_log(spark, prepared(spark, sf_dir, "watermark-log", append)))


@query(
    "watermark_decode",
    f"""SELECT run_id,
          CASE WHEN tag = 'TIMESTAMP' THEN strftime(watermark_ts, '%Y-%m-%d %H:%M:%S.%f')
               WHEN tag = 'INTEGER' THEN CAST(watermark_int AS VARCHAR) END AS value,
          CASE WHEN tag = 'TIMESTAMP' AND watermark_ts IS NULL
                 THEN 'a time mark without its time'
               WHEN tag = 'INTEGER' AND watermark_int IS NULL
                 THEN 'a number mark without its number'
               WHEN tag NOT IN ('TIMESTAMP', 'INTEGER')
                 THEN 'no such kind of mark: ' || tag END AS error
        FROM (SELECT *, CASE CAST(run_id AS BIGINT) % 5 WHEN 0 THEN 'INTEGER' WHEN 1 THEN 'TIMESTAMP'
                        WHEN 2 THEN 'VERSION' ELSE watermark_type END AS tag FROM ({_LOG_SQL}))""",
)
def watermark_decode(spark, sf_dir):
    """Wrong tags and missing values are injected on the run id."""
    log = log_of_orders(table(spark, sf_dir, "orders"))
    fault = F.col("run_id").cast("bigint") % 5
    tag = (
        F.when(fault == 0, F.lit(INTEGER))
        .when(fault == 1, F.lit(TIMESTAMP))
        .when(fault == 2, F.lit("VERSION"))
        .otherwise(F.col("watermark_type"))
    )
    return decode_watermarks(log.withColumn("watermark_type", tag)).select(
        "run_id", "value", "error"
    )
