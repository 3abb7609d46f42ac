"""Refined tables, raw-layer reads and upkeep, run reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sparkingest.operators import hashtree, keyed, lake, metrics, silver
from sparkingest.operators.quality import CODES, Range, split
from sparkingest.plans.catalog import (
    cents,
    day,
    prepared,
    query,
    sql_cents,
    sql_checksum,
    sql_day,
    table,
)
from sparkingest.plans.queries_raw import (
    FAULTY_SQL,
    FEED_KINDS,
    FEED_SQL,
    LINE_SQL,
    RUN_LOG_SQL,
    RUN_SQL,
    faulty_feed,
    faulty_runs,
    feed,
    lines,
    run_log,
)
from sparkingest.session import materialize

LINE_ORDER = [
    "shipped",
    "price_cents",
    "l_partkey",
    "l_suppkey",
    "quantity",
    "discount_pct",
    "tax_pct",
    "l_returnflag",
    "l_linestatus",
]
_LINE_ORDER_SQL = ", ".join(f"{c} DESC" for c in LINE_ORDER)
_LATEST_LINES_SQL = f"""
  SELECT * EXCLUDE rn FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY {_LINE_ORDER_SQL}) AS rn FROM ({LINE_SQL})) WHERE rn = 1"""


@query(
    "silver_merge",
    f"""SELECT strftime(shipped, '%Y-%m') AS part, l_orderkey, l_linenumber, l_partkey, l_suppkey,
               price_cents, strftime(shipped, '%Y-%m-%d') AS shipped
        FROM ({_LATEST_LINES_SQL})""",
)
def silver_merge(spark, sf_dir):
    """Three merges by return flag on a key that repeats within and across them; rows move
    between month partitions when a later version ships in another month."""

    def run(path):
        for flag in ("N", "A", "R"):
            batch = lines(spark, sf_dir).where(F.col("l_returnflag") == flag)
            silver.merge(
                spark,
                path,
                batch,
                ["l_orderkey", "l_linenumber"],
                LINE_ORDER,
                F.date_format("shipped", "yyyy-MM"),
            )

    path = prepared(spark, sf_dir, "silver-lines", run)
    rows = silver.read_silver(spark, path, lines(spark, sf_dir).schema)
    return rows.select(
        "part",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "price_cents",
        day("shipped").alias("shipped"),
    )


@query(
    "silver_merge_narrow",
    """SELECT CAST(o_orderkey % 5 AS VARCHAR) AS part, o_orderkey, 1 + CAST(o_orderkey % 3 = 0 AS BIGINT) AS version,
              CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS note,
              CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS o_custkey
       FROM orders""",
)
def silver_merge_narrow(spark, sf_dir):
    """A second batch lacks a column of the table and brings another one: the rows that it
    does not replace keep what they have."""
    orders = table(spark, sf_dir, "orders")
    label = (F.col("o_orderkey") % 5).cast("string")

    def run(path):
        first = orders.selectExpr("o_orderkey", "CAST(1 AS BIGINT) AS version", "o_orderpriority AS note")
        second = orders.where("o_orderkey % 3 = 0").selectExpr(
            "o_orderkey", "CAST(2 AS BIGINT) AS version", "o_custkey"
        )
        for batch in (first, second):
            silver.merge(spark, path, batch, ["o_orderkey"], ["version"], label)

    path = prepared(spark, sf_dir, "silver-narrow", run)
    rows = silver.read_silver(spark, path, silver.table_schema(spark, path))
    return rows.select("part", "o_orderkey", "version", "note", "o_custkey")


@query(
    "silver_conform",
    """SELECT CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey END AS order_id,
              CASE WHEN o_orderkey % 89 <> 0 THEN o_custkey END AS customer_id,
              strftime(o_orderdate, '%Y-%m-%d') AS order_day,
              CASE WHEN o_orderkey % 97 = 0 THEN 'SCHEMA_TYPE_MISMATCH' ELSE '' END AS codes
       FROM orders""",
)
def silver_conform(spark, sf_dir):
    """Standard names and types; rows whose values do not cast go to quarantine first, each
    of them, and the others are reduced to one row per order."""
    standard = {
        "order_id": ("o_orderkey", "BIGINT"),
        "customer_id": ("o_custkey", "BIGINT"),
        "order_day": ("o_orderdate", "DATE"),
        "source_key": ("source_key", "BIGINT"),
    }
    raw = faulty_feed(spark, sf_dir).withColumn(
        "source_key", F.regexp_replace("o_orderkey", "BAD-", "")
    )
    clean, held = split(silver.conform(raw, standard))
    newest = silver.latest_per_key(clean, ["order_id"], ["source_key"])
    nothing = F.array().cast("array<string>")
    return newest.withColumn(CODES, nothing).unionByName(held).select(
        "order_id",
        "customer_id",
        day("order_day").alias("order_day"),
        F.concat_ws(",", CODES).alias("codes"),
    )


@query(
    "silver_dedupe",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price_cents,
               strftime(shipped, '%Y-%m-%d') AS shipped FROM ({_LATEST_LINES_SQL})""",
)
def silver_dedupe(spark, sf_dir):
    latest = silver.latest_per_key(
        lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], LINE_ORDER
    )
    return latest.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "price_cents",
        day("shipped").alias("shipped"),
    )


@query(
    "gold_daily_rollup",
    f"""SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_day, c_mktsegment AS segment,
               count(*) AS orders, CAST(sum({sql_cents('o_totalprice')}) AS BIGINT) AS cents
        FROM orders JOIN customer ON o_custkey = c_custkey
        GROUP BY ROLLUP (1, 2)""",
)
def gold_daily_rollup(spark, sf_dir):
    """Orders per day and market segment with subtotals; aggregated before the shuffle."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment")
    )
    joined = feed(spark, sf_dir).join(customer, "o_custkey")
    # Subtotals are rolled up from days and segments, not from copies of every order.
    daily = joined.groupBy(day("o_orderdate").alias("order_day"), "segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_cents").alias("c")
    )
    return daily.rollup("order_day", "segment").agg(
        F.sum("n").alias("orders"), F.sum("c").alias("cents")
    )


_CHANGES_SQL = f"""
  SELECT l_orderkey AS o_orderkey, l_suppkey AS o_custkey, price_cents AS o_cents,
         CASE l_returnflag WHEN 'R' THEN 'D' WHEN 'A' THEN 'U' ELSE 'I' END AS op,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber DESC, {_LINE_ORDER_SQL}) AS rn
  FROM ({LINE_SQL})"""


@query(
    "cdc_apply",
    f"""WITH newest AS (SELECT * FROM ({_CHANGES_SQL}) WHERE rn = 1)
        SELECT o_orderkey, o_custkey, {sql_cents('o_totalprice')} AS o_cents FROM orders
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM newest)
        UNION ALL
        SELECT o_orderkey, o_custkey, o_cents FROM newest WHERE op <> 'D'""",
)
def cdc_apply(spark, sf_dir):
    """Lines are a change log for orders: a third deletes, the newest change decides."""
    base = feed(spark, sf_dir).select("o_orderkey", "o_custkey", "o_cents")
    operation = (
        F.when(F.col("l_returnflag") == "R", F.lit("D"))
        .when(F.col("l_returnflag") == "A", F.lit("U"))
        .otherwise(F.lit("I"))
    )
    changes = lines(spark, sf_dir).withColumns(
        {
            "o_orderkey": F.col("l_orderkey"),
            "o_custkey": F.col("l_suppkey"),
            "o_cents": F.col("price_cents"),
            "op": operation,
        }
    )
    return silver.apply_changes(
        base, changes, ["o_orderkey"], ["l_linenumber", *LINE_ORDER], "op"
    )


def _change_batches(spark, sf_dir):
    """Lines as changes of orders, the later half of the versions first. The version of a
    change is its line's number, and of two with one number the greater line counts."""
    operation = (
        F.when(F.col("l_returnflag") == "R", "D").when(F.col("l_returnflag") == "A", "U").otherwise("I")
    )
    changes = lines(spark, sf_dir).withColumn("op", operation)
    return [changes.where("l_linenumber >= 4"), changes.where("l_linenumber < 4")]


def _cdc_table(spark, sf_dir):
    def run(path):
        for batch in _change_batches(spark, sf_dir):
            silver.merge_changes(
                spark,
                path,
                batch,
                ["l_orderkey"],
                ["l_linenumber", *LINE_ORDER],
                "op",
                F.date_format("shipped", "yyyy"),
            )

    return prepared(spark, sf_dir, "silver-changes", run)


def _changed_sql(lines_sql: str) -> str:
    return f"""
        SELECT part, l_orderkey, l_linenumber, price_cents FROM (
          SELECT *, strftime(shipped, '%Y') AS part,
                 row_number() OVER (PARTITION BY l_orderkey
                                    ORDER BY l_linenumber DESC, {_LINE_ORDER_SQL}) AS rn
          FROM ({lines_sql})) WHERE rn = 1 AND l_returnflag <> 'R'"""


@query("cdc_merge", _changed_sql(LINE_SQL))
def cdc_merge(spark, sf_dir):
    """Two batches of changes out of order, a third of them deletes: of every order the
    greatest version decides, whichever batch brought it."""
    rows = silver.read_silver(spark, _cdc_table(spark, sf_dir))
    return rows.select("part", "l_orderkey", "l_linenumber", "price_cents")


@query("as_of_version", _changed_sql(f"SELECT * FROM ({LINE_SQL}) WHERE l_linenumber >= 4"))
def as_of_version(spark, sf_dir):
    """The same table as of its first commit: rows and deletes of the first batch alone."""
    rows = silver.read_silver(spark, _cdc_table(spark, sf_dir), version=1)
    return rows.select("part", "l_orderkey", "l_linenumber", "price_cents")


@query(
    "silver_compaction",
    f"""SELECT 'live' AS kind, part, CAST(count(*) AS BIGINT) AS row_count
        FROM ({_changed_sql(LINE_SQL)}) GROUP BY 2
        UNION ALL
        SELECT 'stored', 'all', count(DISTINCT l_orderkey) FROM lineitem""",
)
def silver_compaction(spark, sf_dir):
    """After the third commit, a compaction of every file with replaced rows: readers see the
    same rows, and stored are one row or tombstone per key."""

    def run(path):
        for batch in _change_batches(spark, sf_dir):
            keys, versions = ["l_orderkey"], ["l_linenumber", *LINE_ORDER]
            part = F.date_format("shipped", "yyyy")
            silver.merge_changes(spark, path, batch, keys, versions, "op", part)
        keyed.compact(spark, path, replaced_share=0.0)

    path = prepared(spark, sf_dir, "silver-compacted", run)
    live = silver.read_silver(spark, path).groupBy("part").agg(F.count(F.lit(1)).alias("row_count"))
    stored = silver.live_partitions(spark, path).agg(F.sum("row_count").alias("row_count"))
    return live.select(F.lit("live").alias("kind"), "part", "row_count").unionByName(
        stored.select(F.lit("stored").alias("kind"), F.lit("all").alias("part"), "row_count")
    )


# --- raw-layer reads -------------------------------------------------------------------


def _event_days(spark, sf_dir):
    """Events as daily full refreshes of five sources, partitioned by date and source."""

    def land(path):
        # One source lands a day later, so that the sources' newest days differ.
        late = F.when(F.col("event_type") == "click", F.expr("INTERVAL 1 DAY")).otherwise(
            F.expr("INTERVAL 0 DAY")
        )
        events = table(spark, sf_dir, "events").select(
            "event_id",
            "user_id",
            F.col("event_type").alias("source_name"),
            F.date_format(F.col("ts") + late, "yyyy-MM-dd").alias("ingestion_date"),
        )
        events.hint("rebalance", F.col("ingestion_date")).write.partitionBy(
            "ingestion_date", "source_name"
        ).parquet(path)

    path = prepared(spark, sf_dir, "event-days", land)
    schema = "event_id BIGINT, user_id BIGINT, ingestion_date STRING, source_name STRING"
    return spark.read.schema(schema).parquet(path)


_EVENT_DAYS_SQL = f"""
  SELECT event_id, user_id, event_type AS source_name,
         {sql_day("(ts + to_days(CAST(event_type = 'click' AS INTEGER)))")} AS ingestion_date
  FROM events"""


@query(
    "latest_snapshot",
    f"""SELECT event_id, user_id, source_name, ingestion_date FROM ({_EVENT_DAYS_SQL}) e
        WHERE ingestion_date = (SELECT max(ingestion_date) FROM ({_EVENT_DAYS_SQL}) m
                                WHERE m.source_name = e.source_name)""",
)
def latest_snapshot(spark, sf_dir):
    return lake.latest_snapshot(_event_days(spark, sf_dir))


@query(
    "as_of_read",
    f"""SELECT o_orderkey, o_custkey, {RUN_SQL} AS _run_id FROM ({FAULTY_SQL})
        WHERE codes = '' AND o_orderstatus IN ('F', 'O')""",
)
def as_of_read(spark, sf_dir):
    """The raw layer before the third run committed."""
    landed = faulty_runs(spark, sf_dir)
    moment = dt.datetime(2024, 1, 3)
    rows = lake.as_of(landed.rows(spark), landed.audit(spark), moment, ["o_orderkey"])
    return rows.select("o_orderkey", "o_custkey", "_run_id")


@query(
    "bronze_replay",
    f"""SELECT o_orderkey, o_custkey, o_cents,
               CASE WHEN o_cents > 40000000 THEN 'RANGE_VIOLATION' ELSE '' END AS codes
        FROM ({FAULTY_SQL}) WHERE codes = '' AND o_orderstatus IN ('F', 'P')""",
)
def bronze_replay(spark, sf_dir):
    """Two runs again under a tighter rule."""
    landed = faulty_runs(spark, sf_dir)
    clean, held = lake.replay(
        landed.rows(spark),
        landed.spec.metadata.source_name,
        ["run-0001", "run-0003"],
        [Range("o_cents", 0, 40_000_000)],
    )
    columns = ["o_orderkey", "o_custkey", "o_cents"]
    return clean.select(*columns, F.lit("").alias("codes")).unionByName(
        held.select(*columns, F.concat_ws(",", CODES).alias("codes"))
    )


@query(
    "retention_expired",
    f"""SELECT 'quarantine' AS kind, ingestion_date AS partition_date, count(*) AS row_count
        FROM ({_EVENT_DAYS_SQL})
        WHERE CAST(ingestion_date AS DATE) < DATE '2024-04-10' - 90 GROUP BY 2
        UNION ALL
        SELECT 'audit', {sql_day('o_orderdate')}, count(*) FROM orders
        WHERE CAST(o_orderdate AS DATE) < DATE '2004-01-01' - 2555 GROUP BY 2""",
)
def retention_expired(spark, sf_dir):
    """Partitions past 90 days of quarantine and past 2555 days of audit retention."""
    held = lake.expired_partitions(
        _event_days(spark, sf_dir), "ingestion_date", 90, dt.date(2024, 4, 10)
    )
    runs = run_log(spark, sf_dir).withColumn("run_date", day("pipeline_start_ts"))
    old_runs = lake.expired_partitions(runs, "run_date", 2555, dt.date(2004, 1, 1))
    return held.select(
        F.lit("quarantine").alias("kind"),
        F.col("ingestion_date").alias("partition_date"),
        "row_count",
    ).unionByName(
        old_runs.select(
            F.lit("audit").alias("kind"), F.col("run_date").alias("partition_date"), "row_count"
        )
    )


# --- reports -------------------------------------------------------------------------------


@query(
    "sla_breaches",
    f"""SELECT * FROM (
          SELECT run_id, source_name,
                 CAST(epoch(pipeline_end_ts) - epoch(pipeline_start_ts) AS BIGINT)
                   AS duration_seconds,
                 epoch(pipeline_end_ts) - epoch(pipeline_start_ts) > 28000 AS too_slow,
                 pipeline_end_ts > date_trunc('day', pipeline_start_ts) + INTERVAL 6 HOUR
                   AS past_deadline
          FROM ({RUN_LOG_SQL})) WHERE too_slow OR past_deadline""",
)
def sla_breaches(spark, sf_dir):
    report = metrics.sla_breaches(run_log(spark, sf_dir), 28_000, "06:00")
    return report.select("run_id", "source_name", "duration_seconds", "too_slow", "past_deadline")


@query(
    "run_metrics",
    f"""SELECT *, CAST(records_written AS DOUBLE) * 60 / duration_seconds AS rows_per_minute,
               CAST(records_written AS DOUBLE) / records_read AS quality_pass_rate,
               CAST(quarantine_count AS DOUBLE) / records_read AS quarantine_rate
        FROM (SELECT source_name, count(*) AS runs,
                count(*) FILTER (status = 'FAILURE') AS failed_runs,
                CAST(sum(records_read) AS BIGINT) AS records_read,
                CAST(sum(records_written) AS BIGINT) AS records_written,
                CAST(sum(quarantine_count) AS BIGINT) AS quarantine_count,
                CAST(sum(epoch(pipeline_end_ts) - epoch(pipeline_start_ts)) AS BIGINT)
                  AS duration_seconds
              FROM ({RUN_LOG_SQL}) GROUP BY 1)""",
)
def run_metrics(spark, sf_dir):
    return metrics.run_metrics(run_log(spark, sf_dir))


@query(
    "coverage_percent",
    """SELECT n_name, count(*) AS expected, count(k) AS seen,
              count(k) * 100.0::DOUBLE / count(*) AS coverage_percent
       FROM customer JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders) ON c_custkey = k
       GROUP BY 1""",
)
def coverage_percent(spark, sf_dir):
    """Customers of each nation that have ordered."""
    seen = table(spark, sf_dir, "orders")
    nation = table(spark, sf_dir, "nation")
    expected = table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return metrics.coverage(
        seen.select(F.col("o_custkey").alias("c_custkey")), expected, "c_custkey", ["n_name"]
    )


@query(
    "quality_trend",
    """WITH daily AS (
         SELECT o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS order_day, count(*) AS total,
                count(*) FILTER (o_totalprice <= 400000) AS passed FROM orders GROUP BY 1, 2),
       rated AS (
         SELECT *, CAST(passed AS DOUBLE) / total AS pass_rate,
           CAST(sum(passed) OVER w AS DOUBLE) / CAST(sum(total) OVER w AS DOUBLE)
             AS moving_pass_rate
         FROM daily WINDOW w AS (PARTITION BY o_orderstatus ORDER BY order_day
                                 ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
       SELECT *, lag(pass_rate) OVER v AS previous_pass_rate,
              pass_rate - lag(pass_rate) OVER v AS change
       FROM rated WINDOW v AS (PARTITION BY o_orderstatus ORDER BY order_day)""",
)
def quality_trend(spark, sf_dir):
    daily = (
        feed(spark, sf_dir)
        .groupBy("o_orderstatus", day("o_orderdate").alias("order_day"))
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("o_cents") <= 40_000_000).alias("passed"),
        )
    )
    return metrics.quality_trend(daily, "o_orderstatus", "order_day", "total", "passed")


_GAPS_SQL = """
  SELECT user_id, strftime(previous, '%Y-%m-%d %H:%M:%S.%f') AS gap_start,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS gap_end,
         (epoch_us(ts) - epoch_us(previous)) / 1000000.0::DOUBLE AS gap_seconds
  FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS previous FROM (
          SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, ts FROM events))
  WHERE epoch_us(ts) - epoch_us(previous) > 43200000000"""


def _device_events(spark, sf_dir):
    """One device holds a third of all events."""
    device = F.when(F.col("user_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id"))
    return table(spark, sf_dir, "events").select(device.alias("user_id"), "ts")


def _shown(gaps):
    shown = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return gaps.withColumns(
        {"gap_start": F.date_format("gap_start", shown), "gap_end": F.date_format("gap_end", shown)}
    )


@query("gap_detect", _GAPS_SQL)
def gap_detect(spark, sf_dir):
    """Silences beyond twelve hours."""
    events = _device_events(spark, sf_dir)
    return _shown(metrics.detect_gaps(events, "user_id", "ts", dt.timedelta(hours=12)))


@query("gap_incremental", _GAPS_SQL)
def gap_incremental(spark, sf_dir):
    """The same gaps from a state of covered intervals, over three batches that are out of
    order and interleaved in time, the first of which is merged twice."""
    threshold = dt.timedelta(hours=12)
    events = _device_events(spark, sf_dir)
    batch = F.pmod(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(3))
    state = None
    for part in (2, 0, 1, 2):
        new = metrics.covered_intervals(events.where(batch == part), "user_id", "ts", threshold)
        merged = new if state is None else metrics.merge_intervals(state, new, "user_id", threshold)
        state = materialize(merged, "covered-intervals")
    return _shown(metrics.interval_gaps(state, "user_id", threshold))


_TARGET_SQL = f"""
  SELECT strftime(o_orderdate, '%Y-%m') AS month, * REPLACE (
    CASE WHEN o_orderkey % 501 = 0 THEN o_cents + 1 ELSE o_cents END AS o_cents)
  FROM ({FEED_SQL}) WHERE o_orderkey % 400 <> 0 AND strftime(o_orderdate, '%Y-%m') <> '1996-02'"""


@query(
    "reconcile",
    f"""SELECT *, CASE WHEN target_rows IS NULL THEN 'MISSING_IN_TARGET'
                      WHEN source_rows <> target_rows THEN 'COUNT_MISMATCH'
                      WHEN source_checksum <> target_checksum THEN 'CONTENT_MISMATCH'
                      ELSE 'MATCH' END AS verdict
        FROM (SELECT s.month, s.row_count AS source_rows, t.row_count AS target_rows,
                     s.checksum AS source_checksum, t.checksum AS target_checksum
              FROM ({sql_checksum(f"(SELECT strftime(o_orderdate, '%Y-%m') AS month, * FROM ({FEED_SQL}))",
                                  FEED_KINDS, ('month',))}) s
              LEFT JOIN ({sql_checksum(f'({_TARGET_SQL})', FEED_KINDS, ('month',))}) t
              ON s.month = t.month)""",
)
def reconcile(spark, sf_dir):
    """A target that lost a month and some rows and changed some cents."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    source = feed(spark, sf_dir).withColumn("month", month)
    key = F.col("o_orderkey")
    target = source.where((key % 400 != 0) & (F.col("month") != "1996-02")).withColumn(
        "o_cents", F.col("o_cents") + F.when(key % 501 == 0, F.lit(1)).otherwise(F.lit(0))
    )
    return metrics.reconcile(source, target, ["month"], list(FEED_KINDS))


# A copy of the line items with every kind of difference, by rules on the order's number.
_COPY_SQL = f"""
  SELECT * REPLACE (CASE WHEN l_orderkey % 101 = 1 THEN price_cents + 1 ELSE price_cents END
                    AS price_cents)
  FROM ({LINE_SQL}) WHERE l_orderkey % 97 <> 0 AND NOT (l_orderkey % 89 = 2 AND l_linenumber = 1)
  UNION ALL SELECT * FROM ({LINE_SQL}) WHERE l_orderkey % 103 = 3 AND l_orderkey % 97 <> 0
  UNION ALL SELECT * REPLACE (-l_orderkey AS l_orderkey) FROM ({LINE_SQL}) WHERE l_orderkey % 107 = 4"""
_COPY_COLUMNS = ["l_orderkey", "l_linenumber", "price_cents", "l_partkey", "l_suppkey"]


@query(
    "reconcile_rows",
    f"""WITH counted AS (
          SELECT {", ".join(_COPY_COLUMNS)}, CAST(sum(s) AS BIGINT) AS s, CAST(sum(t) AS BIGINT) AS t
          FROM (SELECT {", ".join(_COPY_COLUMNS)}, 1 AS s, 0 AS t FROM ({LINE_SQL})
                UNION ALL SELECT {", ".join(_COPY_COLUMNS)}, 0, 1 FROM ({_COPY_SQL}))
          GROUP BY ALL),
        keyed AS (
          SELECT l_orderkey, CAST(sum(s) AS BIGINT) AS source_rows,
                 CAST(sum(t) AS BIGINT) AS target_rows,
                 CAST(sum(greatest(s - t, 0)) AS BIGINT) AS only_source,
                 CAST(sum(greatest(t - s, 0)) AS BIGINT) AS only_target
          FROM counted GROUP BY l_orderkey)
        SELECT *, CASE WHEN target_rows = 0 THEN 'MISSING_IN_TARGET'
                       WHEN source_rows = 0 THEN 'MISSING_IN_SOURCE'
                       WHEN source_rows <> target_rows THEN 'COUNT_MISMATCH'
                       ELSE 'CONTENT_MISMATCH' END AS verdict
        FROM keyed WHERE only_source + only_target > 0""",
)
def reconcile_rows(spark, sf_dir):
    """Orders whose lines differ between the lines and a copy that lost, changed, repeated and
    invented some."""
    source = lines(spark, sf_dir)
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    changed = F.col("price_cents") + F.when(order % 101 == 1, F.lit(1)).otherwise(F.lit(0))
    target = (
        source.where((order % 97 != 0) & ~((order % 89 == 2) & (line == 1)))
        .withColumn("price_cents", changed)
        .unionByName(source.where((order % 103 == 3) & (order % 97 != 0)))
        .unionByName(source.where(order % 107 == 4).withColumn("l_orderkey", -order))
    )
    return hashtree.reconcile_rows(source, target, ["l_orderkey"], _COPY_COLUMNS)
