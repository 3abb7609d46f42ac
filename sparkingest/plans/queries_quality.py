"""Quality rules, quarantine and recovery."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sparkingest.operators.quality import (
    CODES,
    Completeness,
    Pattern,
    Range,
    Referential,
    Timeliness,
    TypeConformance,
    classify,
    completeness_metrics,
    is_clean,
    quarantine_rate,
    revalidate,
)
from sparkingest.plans.catalog import prepared, query, sql_cents, table
from sparkingest.plans.queries_raw import (
    FAULTY_SQL,
    RUN_SQL,
    faulty_feed,
    faulty_runs,
    feed,
    land_faulty_runs,
    rules,
)
from sparkingest.plans.recover import recover


def _codes():
    return F.concat_ws(",", CODES).alias("codes")


@query(
    "dq_completeness",
    """SELECT column_name, total, filled, CAST(filled AS DOUBLE) / total AS rate,
              CAST(filled AS DOUBLE) / total >= 0.98 AS passed
       FROM (SELECT 'o_custkey' AS column_name, count(*) AS total,
                    count(*) FILTER (o_orderkey % 89 <> 0) AS filled FROM orders
             UNION ALL
             SELECT 'o_orderpriority', count(*), count(*) FILTER (o_orderpriority <> '5-LOW')
             FROM orders)""",
)
def dq_completeness(spark, sf_dir):
    """Every 89th customer and every low priority are missing."""
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 89 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"),
    )
    return completeness_metrics(orders, Completeness(("o_custkey", "o_orderpriority"), 0.98))


@query(
    "dq_referential",
    """SELECT l_orderkey, l_linenumber, l_partkey, count(*) AS copies FROM lineitem
       WHERE l_partkey % 10 = 0 GROUP BY ALL""",
)
def dq_referential(spark, sf_dir):
    """Every line against a part table lacking every tenth part."""
    parts = table(spark, sf_dir, "part").where("p_partkey % 10 <> 0")
    rule = Referential("l_partkey", parts, "p_partkey")
    slim = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orphans = classify(slim, [rule]).where(~is_clean())
    return orphans.groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(
        F.count(F.lit(1)).alias("copies")
    )


@query(
    "dq_range",
    f"""SELECT o_orderkey, {sql_cents('o_totalprice')} AS o_cents FROM orders
        WHERE {sql_cents('o_totalprice')} NOT BETWEEN 500000 AND 40000000""",
)
def dq_range(spark, sf_dir):
    flagged = classify(feed(spark, sf_dir), [Range("o_cents", 500_000, 40_000_000)])
    return flagged.where(~is_clean()).select("o_orderkey", "o_cents")


@query(
    "dq_pattern",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE NOT regexp_matches(o_orderpriority, '^[0-9]-[A-Z]+$')""",
)
def dq_pattern(spark, sf_dir):
    flagged = classify(feed(spark, sf_dir), [Pattern("o_orderpriority", "^[0-9]-[A-Z]+$")])
    return flagged.where(~is_clean()).select("o_orderkey", "o_orderpriority")


@query(
    "dq_timeliness",
    """SELECT event_id, user_id FROM events
       WHERE ts < TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 72 HOUR""",
)
def dq_timeliness(spark, sf_dir):
    rule = Timeliness("ts", 72, dt.datetime(2024, 1, 30, 12))
    flagged = classify(table(spark, sf_dir, "events"), [rule])
    return flagged.where(~is_clean()).select("event_id", "user_id")


@query(
    "dq_classify",
    """SELECT o_orderkey AS k, concat_ws(',',
         CASE WHEN o_orderkey % 97 = 0 THEN 'SCHEMA_TYPE_MISMATCH' END,
         CASE WHEN o_orderkey % 89 = 0 THEN 'NULL_IN_REQUIRED_COLUMN' END,
         CASE WHEN o_totalprice > 400000 THEN 'RANGE_VIOLATION' END,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'PATTERN_MISMATCH' END,
         CASE WHEN o_orderdate < TIMESTAMP '2001-08-01' - INTERVAL 48000 HOUR
           THEN 'STALE_RECORD' END,
         CASE WHEN o_custkey % 10 = 0 AND o_orderkey % 89 <> 0 THEN 'ORPHAN_REFERENCE' END) AS codes
       FROM orders""",
)
def dq_classify(spark, sf_dir):
    """Six rules in one pass; a row collects every code it earns."""
    customer = table(spark, sf_dir, "customer").where("c_custkey % 10 <> 0")
    checks = [
        TypeConformance("o_orderkey", "BIGINT"),
        Completeness(("o_custkey",)),
        Range("o_cents", 0, 40_000_000),
        Pattern("o_orderpriority", "^[0-9]-[A-Z]+$"),
        Timeliness("o_orderdate", 48_000, dt.datetime(2001, 8, 1)),
        Referential("o_custkey", customer, "c_custkey"),
    ]
    flagged = classify(faulty_feed(spark, sf_dir), checks)
    key = F.regexp_replace("o_orderkey", "BAD-", "").cast("bigint")
    return flagged.select(key.alias("k"), _codes())


@query(
    "quarantine_split",
    f"""SELECT CASE codes WHEN '' THEN 'clean' ELSE 'quarantined' END AS outcome,
               {RUN_SQL} AS run_id, o_orderkey, o_custkey, _corrupt_record, codes
        FROM ({FAULTY_SQL})""",
)
def quarantine_split(spark, sf_dir):
    """Raw rows and quarantined rows of three runs together are the whole feed."""
    landed = faulty_runs(spark, sf_dir)
    columns = ["o_orderkey", "o_custkey", "_corrupt_record"]
    clean = landed.rows(spark).select(
        F.lit("clean").alias("outcome"),
        F.col("_run_id").alias("run_id"),
        *columns,
        F.lit("").alias("codes"),
    )
    held = landed.quarantine(spark)
    return clean.unionByName(
        held.select(
            F.lit("quarantined").alias("outcome"),
            F.col("_run_id").alias("run_id"),
            *columns,
            _codes(),
        )
    )


@query(
    "quarantine_alert",
    f"""SELECT {RUN_SQL} AS run_id, count(*) AS total,
               count(*) FILTER (codes <> '') AS quarantined,
               CAST(count(*) FILTER (codes <> '') AS DOUBLE) / count(*) AS rate,
               CAST(count(*) FILTER (codes <> '') AS DOUBLE) / count(*) > 0.05 AS alert
        FROM ({FAULTY_SQL}) GROUP BY 1""",
)
def quarantine_alert(spark, sf_dir):
    landed = faulty_runs(spark, sf_dir)
    held = landed.quarantine(spark)
    clean = landed.rows(spark).select(
        F.col("_run_id").alias("run_id"), F.array().cast("array<string>").alias(CODES)
    )
    flagged = clean.unionByName(held.select(F.col("_run_id").alias("run_id"), CODES))
    return quarantine_rate(flagged, 0.05, ["run_id"])


@query(
    "quarantine_recover",
    f"""SELECT CASE WHEN codes = 'ORPHAN_REFERENCE' THEN 'released' ELSE 'held' END AS outcome,
               {RUN_SQL} AS run_id, o_orderkey, o_custkey, o_cents,
               CASE WHEN codes = 'ORPHAN_REFERENCE' THEN ''
                    ELSE replace(codes, ',ORPHAN_REFERENCE', '') END AS codes
        FROM (SELECT * REPLACE (replace(replace(codes, 'CORRUPT_RECORD,', ''),
                                        'CORRUPT_RECORD', '') AS codes)
              FROM ({FAULTY_SQL}) WHERE codes <> '')""",
)
def quarantine_recover(spark, sf_dir):
    """The whole customer table arrives: rows held only as orphans are released."""
    landed = faulty_runs(spark, sf_dir)
    held = landed.quarantine(spark)
    nothing_yet = held.select("row_id").where("row_id IS NULL")
    released, kept = revalidate(held, rules(spark, sf_dir, whole_dimension=True), nothing_yet)
    return (
        released.withColumn("outcome", F.lit("released"))
        .unionByName(kept.withColumn("outcome", F.lit("held")))
        .select(
            "outcome",
            F.col("_run_id").alias("run_id"),
            "o_orderkey",
            "o_custkey",
            "o_cents",
            _codes(),
        )
    )


@query(
    "quarantine_release",
    f"""SELECT CASE WHEN codes = '' THEN {RUN_SQL} ELSE 'run-0004' END AS _run_id, o_orderkey,
               o_custkey, o_cents
        FROM ({FAULTY_SQL}) WHERE codes IN ('', 'ORPHAN_REFERENCE')""",
)
def quarantine_release(spark, sf_dir):
    """The released rows join the raw layer as a fourth run, in a copy of the three others;
    a second recovery finds nothing more."""

    def run(root):
        landed = land_faulty_runs(spark, sf_dir, root)
        for run_id in ("run-0004", "run-0005"):
            recover(
                spark,
                landed.spec,
                landed.schema,
                run_id=run_id,
                run_ts=dt.datetime(2024, 1, 4),
                rules=rules(spark, sf_dir, whole_dimension=True),
            )
        return landed

    rows = prepared(spark, sf_dir, "recovered-runs", run).rows(spark)
    return rows.select("_run_id", "o_orderkey", "o_custkey", "o_cents")
