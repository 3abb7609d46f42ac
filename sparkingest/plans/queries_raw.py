"""The raw layer: ingestion runs, their audit and lineage, reconciliation, compaction."""

from __future__ import annotations

import contextlib
import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkingest.config import (
    Audit,
    Connection,
    Metadata,
    Quarantine,
    SchemaEnforcement,
    SourceSpec,
    Storage,
)
from sparkingest.errors import ConnectorError, StorageWriteError
from sparkingest.functions.fingerprint import batch_checksum, checksum_by
from sparkingest.operators import audit as audit_table
from sparkingest.operators import bronze
from sparkingest.operators.quality import Completeness, Pattern, Range, Referential
from sparkingest.plans.catalog import (
    cents,
    day,
    ddl,
    prepared,
    query,
    sql_cents,
    sql_checksum,
    sql_day,
    table,
)
from sparkingest.plans.ingest import RunResult, ingest

FEED = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_cents BIGINT, o_orderdate DATE, "
    "o_orderpriority STRING, o_orderstatus STRING"
)

# Column kinds of the canonical row text, for the SQL side.
FEED_KINDS = {
    "o_orderkey": "plain",
    "o_custkey": "plain",
    "o_cents": "plain",
    "o_orderdate": "plain",
    "o_orderpriority": "text",
    "o_orderstatus": "text",
}
FEED_SQL = (
    f"SELECT o_orderkey, o_custkey, {sql_cents('o_totalprice')} AS o_cents, "
    "CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority, o_orderstatus FROM orders"
)


def feed(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        cents("o_totalprice").alias("o_cents"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_orderpriority",
        "o_orderstatus",
    )


@dataclass(frozen=True)
class Landed:
    """A raw layer filled by some runs."""

    spec: SourceSpec
    results: tuple[RunResult, ...]

    @property
    def schema(self) -> StructType:
        return self.results[0].schema

    def audit(self, spark) -> DataFrame:
        return audit_table.read_audit(spark, self.spec.audit.path)

    def quarantine(self, spark) -> DataFrame:
        return bronze.read_quarantine(
            spark, self.spec.quarantine.path, self.schema, self.audit(spark)
        )

    def rows(self, spark, **options) -> DataFrame:
        return bronze.read_bronze(
            spark,
            self.spec.storage.path,
            self.audit(spark),
            self.schema,
            partition_by=self.spec.storage.partition_by,
            **options,
        )


def _csv_spec(root: str, path: str, schema: StructType, **storage) -> SourceSpec:
    return SourceSpec(
        metadata=Metadata("orders", "orders"),
        connection=Connection("file", file_path=path, file_format="csv"),
        storage=Storage(f"{root}/bronze", **storage),
        audit=Audit(f"{root}/audit", f"{root}/lineage"),
        quarantine=Quarantine(f"{root}/quarantine", alert_threshold=0.05),
        schema_enforcement=SchemaEnforcement(registered=schema),
    )


# --- one clean run ------------------------------------------------------------------


def clean_run(spark, sf_dir) -> Landed:
    def run(root):
        feed(spark, sf_dir).write.option("header", True).csv(f"{root}/feed")
        spec = _csv_spec(root, f"{root}/feed", ddl(FEED))
        result = ingest(
            spark, spec, run_id="run-0001", run_ts=dt.datetime(2024, 1, 1, 3), verify_stored=True
        )
        return Landed(spec, (result,))

    return prepared(spark, sf_dir, "clean-run", run)


@query(
    "ingest_orders",
    f"""SELECT o_orderkey, o_custkey, o_cents, {sql_day('o_orderdate')} AS o_orderdate,
               o_orderpriority, o_orderstatus, '2024-01-01 03:00:00' AS _ingestion_ts,
               'orders' AS _source_name, 'run-0001' AS _run_id, c.checksum AS _checksum,
               '2024-01-01' AS ingestion_date, 'orders' AS source_name
        FROM ({FEED_SQL}), ({sql_checksum(f'({FEED_SQL})', FEED_KINDS)}) c""",
)
def ingest_orders(spark, sf_dir):
    """Flagship: CSV feed, strict scan, one-pass write, reconcile, seal, commit, read back."""
    rows = clean_run(spark, sf_dir).rows(spark)
    return rows.withColumns(
        {
            "o_orderdate": day("o_orderdate"),
            "_ingestion_ts": F.date_format("_ingestion_ts", "yyyy-MM-dd HH:mm:ss"),
        }
    )


@query(
    "bronze_enrich",
    """SELECT 'orders' AS _source_name, 'run-0001' AS _run_id, '2024-01-01' AS ingestion_date,
              'orders' AS source_name, count(*) AS n, CAST(64 AS INTEGER) AS seal_length
       FROM orders""",
)
def bronze_enrich(spark, sf_dir):
    rows = clean_run(spark, sf_dir).rows(spark)
    keys = ["_source_name", "_run_id", "ingestion_date", "source_name"]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.length("_checksum")).alias("seal_length")
    )


@query(
    "bronze_immutable",
    """SELECT 'run-0001' AS _run_id, o_orderstatus, count(*) AS n,
              CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 2""",
)
def bronze_immutable(spark, sf_dir):
    """The committed run is offered again with other rows; it is refused and unchanged."""

    def run(root):
        landed = clean_run(spark, sf_dir)
        other = Connection("stream", reader=lambda _: feed(spark, sf_dir).where("o_custkey > 9"))
        try:
            ingest(
                spark,
                replace(landed.spec, connection=other),
                run_id="run-0001",
                run_ts=dt.datetime(2024, 1, 1, 3),
            )
        except StorageWriteError:
            return landed
        raise AssertionError("a committed run was written again")

    rows = prepared(spark, sf_dir, "rewritten-run", run).rows(spark)
    return rows.groupBy("_run_id", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")
    )


# --- faulty runs with rules -----------------------------------------------------------

RULES_SQL = """
  SELECT *, concat_ws(',',
     CASE WHEN _corrupt_record IS NOT NULL THEN 'CORRUPT_RECORD' END,
     CASE WHEN o_orderkey IS NULL OR o_custkey IS NULL THEN 'NULL_IN_REQUIRED_COLUMN' END,
     CASE WHEN o_cents > 45000000 THEN 'RANGE_VIOLATION' END,
     CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-4]-') THEN 'PATTERN_MISMATCH' END,
     CASE WHEN o_custkey % 50 = 0 THEN 'ORPHAN_REFERENCE' END) AS codes"""

# Every 97th key does not parse, every 89th customer is missing. The corrupt text is the line.
FAULTY_SQL = f"""
  {RULES_SQL} FROM (
    SELECT CASE WHEN k % 97 <> 0 THEN k END AS o_orderkey, custkey AS o_custkey, o_cents,
           o_orderdate, o_orderpriority, o_orderstatus,
           CASE WHEN k % 97 = 0 THEN concat_ws(',', 'BAD-' || k,
             coalesce(CAST(custkey AS VARCHAR), ''), CAST(o_cents AS VARCHAR),
             strftime(o_orderdate, '%Y-%m-%d'), o_orderpriority, o_orderstatus)
           END AS _corrupt_record, k
    FROM (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 89 <> 0 THEN o_custkey END AS custkey,
                 o_cents, o_orderdate, o_orderpriority, o_orderstatus FROM ({FEED_SQL})))"""

FAULTY_KINDS = FEED_KINDS | {"_corrupt_record": "text"}

# The runs, one per order status.
RUN_OF_STATUS = {"F": "run-0001", "O": "run-0002", "P": "run-0003"}
RUN_SQL = "CASE o_orderstatus WHEN 'F' THEN 'run-0001' WHEN 'O' THEN 'run-0002' ELSE 'run-0003' END"


def rules(spark, sf_dir, *, whole_dimension: bool = False):
    """Four rules; the reference lacks every 50th customer unless it is whole."""
    customer = table(spark, sf_dir, "customer")
    if not whole_dimension:
        customer = customer.where("c_custkey % 50 <> 0")
    return [
        Completeness(("o_orderkey", "o_custkey")),
        Range("o_cents", 0, 45_000_000),
        Pattern("o_orderpriority", "^[1-4]-"),
        Referential("o_custkey", customer, "c_custkey"),
    ]


def faulty_feed(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    text = key.cast("string")
    return feed(spark, sf_dir).withColumns(
        {
            "o_orderkey": F.when(key % 97 == 0, F.concat(F.lit("BAD-"), text)).otherwise(text),
            "o_custkey": F.when(key % 89 != 0, F.col("o_custkey")),
        }
    )


def land_faulty_runs(spark, sf_dir, root: str) -> Landed:
    """Three daily runs over a feed with injected faults."""
    faulty = faulty_feed(spark, sf_dir).withColumn("feed", F.col("o_orderstatus"))
    faulty.write.option("header", True).partitionBy("feed").csv(f"{root}/feed")
    results = []
    for i, (status, run_id) in enumerate(RUN_OF_STATUS.items()):
        spec = _csv_spec(root, f"{root}/feed/feed={status}", ddl(FEED))
        enforcement = replace(spec.schema_enforcement, corrupt_mode="PERMISSIVE")
        spec = replace(spec, schema_enforcement=enforcement)
        run_ts = dt.datetime(2024, 1, 1 + i, 3)
        results.append(ingest(spark, spec, run_id=run_id, run_ts=run_ts, rules=rules(spark, sf_dir)))
    return Landed(spec, tuple(results))


def faulty_runs(spark, sf_dir) -> Landed:
    return prepared(spark, sf_dir, "faulty-runs", lambda root: land_faulty_runs(spark, sf_dir, root))


@query(
    "bronze_append",
    f"""SELECT {RUN_SQL} AS _run_id, o_orderkey, o_custkey, o_cents
        FROM ({FAULTY_SQL}) WHERE codes = ''""",
)
def bronze_append(spark, sf_dir):
    """Three runs accumulate; quarantined rows are not among them."""
    rows = faulty_runs(spark, sf_dir).rows(spark)
    return rows.select("_run_id", "o_orderkey", "o_custkey", "o_cents")


@query(
    "corrupt_failfast",
    """SELECT CAST(o_orderstatus AS VARCHAR) AS feed,
              CASE WHEN bad > 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS status,
              CASE WHEN bad > 0 THEN 0 ELSE n END AS records_written
       FROM (SELECT o_orderstatus, count(*) AS n, count(*) FILTER (o_orderkey % 97 = 0) AS bad
             FROM orders GROUP BY 1)""",
)
def corrupt_failfast(spark, sf_dir):
    """One run per feed in the strictest mode: a corrupt record fails its run, which leaves
    an audit row and no visible rows."""

    def run(root):
        faulty = faulty_feed(spark, sf_dir).withColumn("feed", F.col("o_orderstatus"))
        faulty.write.option("header", True).partitionBy("feed").csv(f"{root}/feed")
        for status in RUN_OF_STATUS:
            spec = _csv_spec(root, f"{root}/feed/feed={status}", ddl(FEED))
            with contextlib.suppress(ConnectorError):
                ingest(spark, spec, run_id=f"run-{status}", run_ts=dt.datetime(2024, 1, 1))
        return spec

    spec = prepared(spark, sf_dir, "failfast-runs", run)
    return audit_table.read_audit(spark, spec.audit.path).select(
        F.substring_index("run_id", "-", -1).alias("feed"), "status", "records_written"
    )


@query(
    "batch_counts",
    f"""SELECT {RUN_SQL} AS run_id, count(*) AS records_read,
               count(*) FILTER (codes = '') AS records_written,
               count(*) FILTER (codes <> '') AS quarantine_count
        FROM ({FAULTY_SQL}) GROUP BY 1""",
)
def batch_counts(spark, sf_dir):
    """Counts observed inside each write job."""
    audit = faulty_runs(spark, sf_dir).audit(spark)
    return audit.select("run_id", "records_read", "records_written", "quarantine_count")


@query(
    "audit_log",
    f"""SELECT run_id, 'orders' AS source_name, 'file' AS source_type,
               '2024-01-0' || substr(run_id, 8, 1) AS started_on, records_read,
               records_written, quarantine_count, 'PARTIAL' AS status,
               CAST(NULL AS VARCHAR) AS error_message, checksum
        FROM (SELECT {RUN_SQL} AS run_id, count(*) AS records_read,
                     count(*) FILTER (codes = '') AS records_written,
                     count(*) FILTER (codes <> '') AS quarantine_count
              FROM ({FAULTY_SQL}) GROUP BY 1)
        JOIN ({sql_checksum(f"(SELECT *, {RUN_SQL} AS run_id FROM ({FAULTY_SQL}) WHERE codes = '')",
                            FAULTY_KINDS, ('run_id',))}) USING (run_id)""",
)
def audit_log(spark, sf_dir):
    """One row per run, sealed with the checksum of its clean rows."""
    audit = faulty_runs(spark, sf_dir).audit(spark)
    return audit.select(
        "run_id",
        "source_name",
        "source_type",
        day("pipeline_start_ts").alias("started_on"),
        "records_read",
        "records_written",
        "quarantine_count",
        "status",
        "error_message",
        "checksum",
    )


@query(
    "lineage_log",
    f"""SELECT {RUN_SQL} AS run_id, 'orders' AS source_id, count(*) AS records_read,
               count(*) FILTER (codes = '') AS records_written,
               'struct<o_orderkey:bigint,o_custkey:bigint,o_cents:bigint,o_orderdate:date,'
               || 'o_orderpriority:string,o_orderstatus:string,_corrupt_record:string>' AS schema_ddl
        FROM ({FAULTY_SQL}) GROUP BY 1""",
)
def lineage_log(spark, sf_dir):
    lineage = audit_table.read_lineage(spark, faulty_runs(spark, sf_dir).spec.audit.lineage_path)
    return lineage.select(
        "run_id", "source_id", "records_read", "records_written", "schema_ddl"
    )


@query(
    "commit_log_state",
    f"""WITH months AS (
          SELECT strftime(o_orderdate, '%Y-%m') AS run_id, count(*) AS records_read,
                 max(o_orderkey) AS top, count(*) FILTER (o_orderkey % 4 = 0) AS held
          FROM orders GROUP BY 1)
        SELECT row_number() OVER (ORDER BY run_id) AS number, run_id, records_read,
               records_read - held AS records_written,
               CASE WHEN held > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status,
               held * 5 > records_read AS alert, CAST(top AS VARCHAR) AS watermark_value,
               last_value(CAST(top AS VARCHAR)) OVER (ORDER BY run_id ROWS BETWEEN UNBOUNDED PRECEDING
                 AND UNBOUNDED FOLLOWING) AS current_watermark
        FROM months""",
)
def commit_log_state(spark, sf_dir):
    """A run for each month of orders, as records of one log: read back from its last
    snapshot and what follows, with the mark that the next run starts from."""

    def run(path):
        months = (
            table(spark, sf_dir, "orders")
            .groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("run_id"))
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.max("o_orderkey").alias("top"),
                F.count_if(F.col("o_orderkey") % 4 == 0).alias("held"),
            )
        )
        at = dt.datetime(2024, 1, 1)
        for m in months.orderBy("run_id").collect():
            event = audit_table.AuditEvent(
                run_id=m.run_id,
                source_name="orders",
                source_type="stream",
                pipeline_start_ts=at,
                pipeline_end_ts=at,
                records_read=m.n,
                records_written=m.n - m.held,
                quarantine_count=m.held,
                status=audit_table.PARTIAL if m.held else audit_table.SUCCESS,
            )
            details = audit_table.RunDetails(
                alert=m.held * 5 > m.n,
                watermark_type="INTEGER",
                watermark_value=str(m.top),
                watermark_storage="marks",
            )
            audit_table.append_audit(spark, path, event, details)

    path = prepared(spark, sf_dir, "month-runs", run)
    mark = audit_table.committed_watermark(spark, path, "orders", "marks")
    return audit_table.read_runs(spark, path, "orders").select(
        "number",
        "run_id",
        "records_read",
        "records_written",
        "status",
        "alert",
        "watermark_value",
        F.lit(mark[1]).alias("current_watermark"),
    )


# A run log as large as the orders table: one run per order.
RUN_LOG_SQL = f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id,
         CASE WHEN o_orderkey % 3 = 0 THEN 'busy' ELSE o_orderpriority END AS source_name,
         CAST(o_orderdate AS TIMESTAMP) AS pipeline_start_ts,
         CAST(o_orderdate AS TIMESTAMP) + to_seconds({sql_cents('o_totalprice')} % 30000)
           AS pipeline_end_ts,
         {sql_cents('o_totalprice')} AS records_read,
         CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE {sql_cents('o_totalprice')}
           - (CASE WHEN o_orderkey % 4 = 0 THEN o_custkey ELSE 0 END) END AS records_written,
         CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 4 = 0 THEN o_custkey ELSE 0 END
           AS quarantine_count,
         CASE WHEN o_orderkey % 11 = 0 THEN 'FAILURE'
              WHEN o_orderkey % 4 = 0 AND o_custkey > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status
  FROM orders"""


def run_log(spark, sf_dir) -> DataFrame:
    """Audit-shaped rows: every 11th order a failed run, every 4th one with quarantined
    rows, a third of all runs from one source."""
    key = F.col("o_orderkey")
    read = cents("o_totalprice")
    failed = key % 11 == 0
    start = F.col("o_orderdate").cast("timestamp")
    zero = F.lit(0).cast("bigint")
    lost = F.when(~failed & (key % 4 == 0), F.col("o_custkey")).otherwise(zero)
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias("run_id"),
        F.when(key % 3 == 0, F.lit("busy"))
        .otherwise(F.col("o_orderpriority"))
        .alias("source_name"),
        start.alias("pipeline_start_ts"),
        F.timestamp_seconds(F.unix_timestamp(start) + read % 30000).alias("pipeline_end_ts"),
        read.alias("records_read"),
        F.when(failed, zero).otherwise(read - lost).alias("records_written"),
        lost.alias("quarantine_count"),
        audit_table.run_status(failed, lost).alias("status"),
    )


@query(
    "audit_status",
    f"""SELECT source_name, status, count(*) AS runs,
               CAST(sum(quarantine_count) AS BIGINT) AS quarantined
        FROM ({RUN_LOG_SQL}) GROUP BY 1, 2""",
)
def audit_status(spark, sf_dir):
    return (
        run_log(spark, sf_dir)
        .groupBy("source_name", "status")
        .agg(
            F.count(F.lit(1)).alias("runs"), F.sum("quarantine_count").alias("quarantined")
        )
    )


# --- validator hook, partitioned writes -------------------------------------------------


@query(
    "validator_hook",
    """SELECT 'identity' AS run_id, count(*) AS records_read, count(*) AS records_written,
              CAST(0 AS BIGINT) AS quarantine_count, CAST(0 AS BIGINT) AS dropped_count,
              'SUCCESS' AS status FROM orders
       UNION ALL
       SELECT 'dropping', count(*), count(*) FILTER (o_custkey % 5 <> 0), 0,
              count(*) FILTER (o_custkey % 5 = 0), 'PARTIAL' FROM orders""",
)
def validator_hook(spark, sf_dir):
    """A DataFrame function between scan and write: the identity, and one dropping rows."""

    def run(root):
        feed(spark, sf_dir).write.option("header", True).csv(f"{root}/feed")
        spec = _csv_spec(root, f"{root}/feed", ddl(FEED))
        hooks = {
            "identity": lambda df: df,
            "dropping": lambda df: df.where(F.col("o_custkey") % 5 != 0),
        }
        for run_id, hook in hooks.items():
            ingest(spark, spec, run_id=run_id, run_ts=dt.datetime(2024, 1, 1), validator=hook)
        return spec

    spec = prepared(spark, sf_dir, "hooked-runs", run)
    return audit_table.read_audit(spark, spec.audit.path).select(
        "run_id",
        "records_read",
        "records_written",
        "quarantine_count",
        "dropped_count",
        "status",
    )


@query(
    "bronze_partition_by",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n,
              CAST(sum(o_orderkey) AS BIGINT) AS key_sum
       FROM orders GROUP BY 1, 2""",
)
def bronze_partition_by(spark, sf_dir):
    """Configured partition columns below the run directory come back as columns."""

    def run(root):
        feed(spark, sf_dir).write.option("header", True).csv(f"{root}/feed")
        columns = ("o_orderstatus", "o_orderpriority")
        spec = _csv_spec(root, f"{root}/feed", ddl(FEED), partition_by=columns)
        result = ingest(spark, spec, run_id="run-0001", run_ts=dt.datetime(2024, 1, 1))
        return Landed(spec, (result,))

    rows = prepared(spark, sf_dir, "partitioned-run", run).rows(spark)
    return rows.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")
    )


# --- checksum and reconciliation ---------------------------------------------------------

LINE_KINDS = {
    "l_orderkey": "plain",
    "l_partkey": "plain",
    "l_suppkey": "plain",
    "l_linenumber": "plain",
    "quantity": "plain",
    "price_cents": "plain",
    "discount_pct": "plain",
    "tax_pct": "plain",
    "l_returnflag": "text",
    "l_linestatus": "text",
    "shipped": "plain",
}
LINE_SQL = f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CAST(l_quantity AS BIGINT) AS quantity, {sql_cents('l_extendedprice')} AS price_cents,
  {sql_cents('l_discount')} AS discount_pct, {sql_cents('l_tax')} AS tax_pct,
  l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS shipped FROM lineitem"""


def lines(spark, sf_dir) -> DataFrame:
    """Whole lineitem with money as whole cents, whose text is the same in every engine."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        cents("l_extendedprice").alias("price_cents"),
        cents("l_discount").alias("discount_pct"),
        cents("l_tax").alias("tax_pct"),
        "l_returnflag",
        "l_linestatus",
        F.col("l_shipdate").cast("date").alias("shipped"),
    )


@query("batch_checksum", sql_checksum(f"({LINE_SQL})", LINE_KINDS))
def batch_checksum_query(spark, sf_dir):
    return batch_checksum(lines(spark, sf_dir))


@query(
    "checksum_by_group",
    sql_checksum(f"({LINE_SQL})", {k: v for k, v in LINE_KINDS.items() if k != "l_returnflag"},
                 ("l_returnflag",)),
)
def checksum_by_group(spark, sf_dir):
    """Three groups, each a third of all rows; every task sends three sums."""
    return checksum_by(lines(spark, sf_dir), ["l_returnflag"])


@query(
    "count_reconcile",
    f"""SELECT {RUN_SQL} AS _run_id, CASE codes WHEN '' THEN 'clean' ELSE 'quarantined' END
               AS _outcome, count(*) AS stored, count(*) AS observed, 'OK' AS verdict
        FROM ({FAULTY_SQL}) GROUP BY 1, 2""",
)
def count_reconcile(spark, sf_dir):
    """Files on disk, raw layer and quarantine, against the counts of the audit rows."""
    landed = faulty_runs(spark, sf_dir)
    raw = spark.read.schema(bronze.bronze_schema(landed.schema)).parquet(
        landed.spec.storage.path
    )
    held = landed.quarantine(spark).withColumn("_outcome", F.lit("quarantined"))
    stored = (
        raw.select("_run_id", "_outcome")
        .unionByName(held.select("_run_id", "_outcome"))
        .groupBy("_run_id", "_outcome")
        .agg(F.count(F.lit(1)).alias("stored"))
    )
    outcome = F.array(
        F.struct(F.lit("clean").alias("_outcome"), F.col("records_written").alias("observed")),
        F.struct(
            F.lit("quarantined").alias("_outcome"), F.col("quarantine_count").alias("observed")
        ),
    )
    observed = landed.audit(spark).select(
        F.col("run_id").alias("_run_id"), F.explode(outcome).alias("o")
    )
    joined = stored.join(observed.select("_run_id", "o.*"), ["_run_id", "_outcome"], "full_outer")
    agrees = F.col("stored").eqNullSafe(F.col("observed"))
    return joined.withColumn("verdict", F.when(agrees, F.lit("OK")).otherwise(F.lit("MISMATCH")))


# --- compaction ----------------------------------------------------------------------------


def _lines_stored(spark, sf_dir) -> Landed:
    """Lineitem in three daily runs of many small files."""

    def run(root):
        spec = None
        results = []
        for i, flag in enumerate(("A", "N", "R")):
            part = lines(spark, sf_dir).where(F.col("l_returnflag") == flag)
            # By key: rows dealt in turn are sorted first, so that a lost task deals them alike.
            part = part.repartition(16, "l_orderkey", "l_linenumber")
            spec = SourceSpec(
                metadata=Metadata("lineitem", "lineitem"),
                connection=Connection("stream", reader=lambda _, part=part: part),
                storage=Storage(f"{root}/bronze"),
                audit=Audit(f"{root}/audit"),
            )
            day_ = dt.datetime(2024, 2, 1 + i // 2, 3 + i)
            results.append(ingest(spark, spec, run_id=f"run-{flag}", run_ts=day_))
        return Landed(spec, tuple(results))

    return prepared(spark, sf_dir, "lines-stored", run)


def compacted_lines(spark, sf_dir) -> tuple[Landed, str]:
    landed = _lines_stored(spark, sf_dir)

    def run(root):
        bronze.compact(
            spark,
            landed.spec.storage.path,
            root,
            landed.audit(spark),
            landed.schema,
            "c-0001",
            source_name=landed.spec.metadata.source_name,
            before="2024-02-02",
        )

    return landed, prepared(spark, sf_dir, "lines-compacted", run)


@query(
    "compaction",
    f"""SELECT 'lineitem' AS source_name, ingestion_date, row_count, checksum,
               ingestion_date < '2024-02-02' AS compacted
        FROM ({sql_checksum(f'''(SELECT *, CASE l_returnflag WHEN 'R' THEN '2024-02-02'
                                  ELSE '2024-02-01' END AS ingestion_date FROM ({LINE_SQL}))''',
                            LINE_KINDS, ('ingestion_date',))})""",
)
def compaction(spark, sf_dir):
    """The closed day comes from the compacted copy, the open one from its run; contents as before."""
    landed, root = compacted_lines(spark, sf_dir)
    rows = landed.rows(spark, compacted_root=root)
    names = [f.name for f in landed.schema.fields]
    keys = ["source_name", "ingestion_date"]
    sealed = checksum_by(rows.select(*names, *keys), keys, names)
    done = bronze.read_compactions(spark, root).select(*keys).distinct()
    return sealed.join(done.withColumn("_done", F.lit(True)), keys, "left").select(
        *keys, "row_count", "checksum", F.coalesce("_done", F.lit(False)).alias("compacted")
    )


@query(
    "compaction_schema_change",
    """SELECT source_name, o_orderkey, o_custkey, note FROM (
         SELECT 'first' AS source_name, o_orderkey, NULL::BIGINT AS o_custkey,
                CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS note FROM orders
         UNION ALL
         SELECT 'second', o_orderkey, o_custkey, NULL FROM orders)""",
)
def compaction_schema_change(spark, sf_dir):
    """Two sources share a raw root; one of them lost a column between its runs. After both
    are compacted nothing is null that was not."""
    orders = table(spark, sf_dir, "orders")

    def run(root):
        shapes = [
            ("first", "a", orders.where("o_orderkey % 2 = 0").selectExpr("o_orderkey", "o_orderpriority AS note")),
            ("first", "b", orders.where("o_orderkey % 2 <> 0").select("o_orderkey")),
            ("second", "a", orders.select("o_orderkey", "o_custkey")),
        ]
        for source, run_id, rows in shapes:
            spec = SourceSpec(
                metadata=Metadata(source, source),
                connection=Connection("stream", reader=lambda _, rows=rows: rows),
                storage=Storage(f"{root}/bronze"),
                audit=Audit(f"{root}/audit"),
            )
            ingest(spark, spec, run_id=run_id, run_ts=dt.datetime(2024, 3, 1))
        for source in ("first", "second"):
            bronze.compact(
                spark,
                f"{root}/bronze",
                f"{root}/compacted",
                audit_table.read_audit(spark, f"{root}/audit"),
                orders.select("o_orderkey").schema,
                f"c-{source}",
                source_name=source,
                before="2024-03-02",
            )

    root = prepared(spark, sf_dir, "shapes-compacted", run)
    whole = ddl("o_orderkey BIGINT, o_custkey BIGINT, note STRING")
    rows = bronze.read_bronze(
        spark,
        f"{root}/bronze",
        audit_table.read_audit(spark, f"{root}/audit"),
        whole,
        compacted_root=f"{root}/compacted",
    )
    return rows.select("source_name", *whole.names)
