"""Times the headline jobs and, for four of them, the plain shape they replace.

``$BENCH_SF_DIR`` names the tables, ``$BENCH_CPUS`` the local threads. Prints one JSON
line. Each figure is the median of ``$BENCH_RUNS`` runs after one warm-up; every run
writes to a fresh folder and builds its plan anew, so nothing is reused between runs.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
import statistics
import time
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sparkingest.config import (
    Audit,
    Connection,
    Ingestion,
    Metadata,
    Quarantine,
    SchemaEnforcement,
    SourceSpec,
    Storage,
)
from sparkingest.functions.fingerprint import batch_checksum
from sparkingest.operators import metrics, silver
from sparkingest.operators.quality import (
    CODES,
    Completeness,
    Pattern,
    Range,
    Referential,
    Timeliness,
    classify,
    is_clean,
)
from sparkingest.operators.watermark import (
    INTEGER,
    Watermark,
    append_watermark,
    latest_watermarks,
)
from sparkingest.plans.catalog import table
from sparkingest.plans.ingest import ingest
from sparkingest.plans.queries_lake import (
    LINE_ORDER,
    cdc_apply,
    gap_detect,
    gold_daily_rollup,
    reconcile,
    silver_dedupe,
)
from sparkingest.plans.queries_raw import lines
from sparkingest.plans.queries_state import log_of_orders
from sparkingest.session import work_path
from sparkingest.sources.files import read_csv, read_json

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
RUN_TS = dt.datetime(2024, 1, 1)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("sparkingest-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job) -> float:
    job()
    seconds = []
    for _ in range(RUNS):
        start = time.monotonic()
        job()
        seconds.append(time.monotonic() - start)
    return round(statistics.median(seconds), 3)


class Jobs:
    """Inputs are landed once as several files, the way feeds arrive."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        spread = lines(spark, SF_DIR).repartition(int(CPUS) * 2)
        self.schema = spread.schema
        self.csv, self.json = work_path(spark, "bench-csv"), work_path(spark, "bench-json")
        self.parquet = work_path(spark, "bench-parquet")
        spread.write.option("header", True).csv(self.csv)
        spread.write.json(self.json)
        spread.write.parquet(self.parquet)

    def feed(self):
        return self.spark.read.schema(self.schema).parquet(self.parquet)

    def spec(self, name: str, **ingestion) -> SourceSpec:
        root = work_path(self.spark, name)
        return SourceSpec(
            metadata=Metadata("lineitem", "lineitem"),
            connection=Connection("file", file_path=self.csv, file_format="csv"),
            storage=Storage(f"{root}/bronze"),
            audit=Audit(f"{root}/audit", f"{root}/lineage"),
            quarantine=Quarantine(f"{root}/held"),
            ingestion=Ingestion(**ingestion) if ingestion else Ingestion(),
            schema_enforcement=SchemaEnforcement(registered=self.schema),
        )

    # --- ingestion ----------------------------------------------------------------

    def ingest_csv(self):
        ingest(self.spark, self.spec("ingest"), run_id="r1", run_ts=RUN_TS)

    def ingest_csv_five_passes(self):
        """Count, collect and hash, count, count and write, each reading the source."""
        spark, root = self.spark, work_path(self.spark, "five")
        df = read_csv(spark, self.csv, self.schema)
        df.count()
        text = "".join(sorted(str(r) for r in df.collect()))
        checksum = hashlib.sha256(text.encode()).hexdigest()
        df.count()
        added = {
            "_ingestion_ts": RUN_TS,
            "_source_name": "lineitem",
            "_run_id": "r1",
            "_checksum": checksum,
            "ingestion_date": "2024-01-01",
            "source_name": "lineitem",
        }
        enriched = df.withColumns({name: F.lit(value) for name, value in added.items()})
        enriched.count()
        enriched.write.partitionBy("ingestion_date", "source_name").parquet(root)

    def incremental(self, share: float):
        """A run that finds ``share`` of the feed beyond its mark."""
        marks = work_path(self.spark, "marks")
        spec = self.spec(
            "incremental",
            mode="incremental",
            incremental_column="l_orderkey",
            watermark_storage=marks,
        )
        orders = table(self.spark, SF_DIR, "orders")
        cut = int(orders.agg(F.max("o_orderkey")).first()[0] * (1 - share))
        append_watermark(
            self.spark, marks, "lineitem", Watermark(INTEGER, integer=cut), RUN_TS, "r0"
        )
        files = Connection("file", file_path=self.parquet, file_format="parquet")
        spec = replace(spec, connection=files)
        ingest(self.spark, spec, run_id="r1", run_ts=RUN_TS)

    # --- checksum -------------------------------------------------------------------

    def checksum(self):
        batch_checksum(self.feed()).collect()

    def checksum_on_driver(self):
        text = "".join(sorted(str(r) for r in self.feed().collect()))
        hashlib.sha256(text.encode()).hexdigest()

    # --- quality --------------------------------------------------------------------

    def rules(self):
        part = table(self.spark, SF_DIR, "part").where("p_partkey % 10 <> 0")
        return [
            Completeness(("l_orderkey", "l_partkey")),
            Range("price_cents", 0, 9_000_000),
            Pattern("l_returnflag", "^[AN]$"),
            Timeliness("shipped", 48_000, dt.datetime(2001, 8, 1)),
            Referential("l_partkey", part, "p_partkey"),
        ]

    def quality_one_pass(self):
        flagged = classify(self.feed(), self.rules())
        out = flagged.withColumn("outcome", is_clean())
        out.write.partitionBy("outcome").parquet(work_path(self.spark, "split"))

    def quality_pass_per_rule(self):
        for i, rule in enumerate(self.rules()):
            flagged = classify(self.feed(), [rule])
            bad = flagged.where(~is_clean())
            bad.write.parquet(work_path(self.spark, f"rule-{i}"))
        clean = classify(self.feed(), self.rules()).where(is_clean()).drop(CODES)
        clean.write.parquet(work_path(self.spark, "clean"))

    # --- refinement ------------------------------------------------------------------

    def merge_two_batches(self):
        path = work_path(self.spark, "silver")
        for flag in ("l_returnflag <> 'R'", "l_returnflag = 'R'"):
            silver.merge(
                self.spark,
                path,
                self.feed().where(flag),
                ["l_orderkey", "l_linenumber"],
                LINE_ORDER,
                F.date_format("shipped", "yyyy"),
            )

    def reconcile_copies(self):
        month = F.date_format("shipped", "yyyy-MM")
        left = self.feed().withColumn("month", month)
        drain(metrics.reconcile(left, left, ["month"], self.schema.names))


def main() -> None:
    spark = session()
    jobs = Jobs(spark)
    registered = (gold_daily_rollup, silver_dedupe, cdc_apply, gap_detect, reconcile)
    queries = {
        "ingest_csv": jobs.ingest_csv,
        "incremental_1_percent": lambda: jobs.incremental(0.01),
        "scan_csv": lambda: drain(read_csv(spark, jobs.csv, jobs.schema)),
        "scan_csv_drop_corrupt": lambda: drain(
            read_csv(spark, jobs.csv, jobs.schema, corrupt="DROPMALFORMED")
        ),
        "scan_json": lambda: drain(read_json(spark, jobs.json, jobs.schema)),
        "batch_checksum": jobs.checksum,
        "quality_split": jobs.quality_one_pass,
        "silver_merge": jobs.merge_two_batches,
        "reconcile_copies": jobs.reconcile_copies,
        "watermark_latest": lambda: drain(
            latest_watermarks(log_of_orders(table(spark, SF_DIR, "orders")))
        ),
    }
    for query in registered:
        queries[query.__name__] = lambda query=query: drain(query(spark, SF_DIR))
    plain = {
        "ingest_csv": jobs.ingest_csv_five_passes,
        "incremental_1_percent": lambda: jobs.incremental(1.0),
        "batch_checksum": jobs.checksum_on_driver,
        "quality_split": jobs.quality_pass_per_rule,
    }
    seconds = {name: timed(job) for name, job in queries.items()}
    replaced = {name: timed(job) for name, job in plain.items()}
    print(
        json.dumps(
            {
                "metric": "sum of medians of the headline jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "plain_shape": replaced,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
