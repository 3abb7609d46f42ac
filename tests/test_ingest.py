from __future__ import annotations

import datetime as dt
import re
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparkingest.config import (
    Audit,
    Connection,
    Ingestion,
    Metadata,
    Monitoring,
    Quarantine,
    SchemaEnforcement,
    SourceSpec,
    Storage,
)
from sparkingest.errors import (
    ConfigurationError,
    ConnectorError,
    QualityViolation,
    StorageWriteError,
    UnexpectedError,
)
from sparkingest.functions.fingerprint import batch_checksum
from sparkingest.operators import audit as audit_table
from sparkingest.operators import bronze, lake
from sparkingest.operators.quality import CODES, Completeness, Range, Referential, classify
from sparkingest.operators.watermark import read_watermark
from sparkingest.plans.ingest import dropped_path, ingest
from sparkingest.plans.recover import recover, released_rows

RUN_TS = dt.datetime(2024, 5, 1, 3)
SCHEMA = "id BIGINT, name STRING, amount DOUBLE"
ROWS = [(i, f"n{i}", 100.0 * i) for i in range(1, 9)]


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def spec(tmp_path, batch):
    return SourceSpec(
        metadata=Metadata("mem-1", "mem"),
        connection=Connection("stream", reader=lambda _: batch),
        storage=Storage(f"{tmp_path}/bronze"),
        audit=Audit(f"{tmp_path}/audit", f"{tmp_path}/lineage"),
        quarantine=Quarantine(f"{tmp_path}/held", alert_threshold=0.1),
        monitoring=Monitoring(60),
    )


def reading(spec, df):
    return replace(spec, connection=Connection("stream", reader=lambda _: df))


def audit(spark, spec):
    return audit_table.read_audit(spark, spec.audit.path)


def stored(spark, spec, schema, **options):
    return bronze.read_bronze(spark, spec.storage.path, audit(spark, spec), schema, **options)


def test_clean_run(spark, spec, batch):
    result = ingest(spark, spec, run_id="r1", run_ts=RUN_TS, verify_stored=True)
    assert (result.status, result.records_read, result.records_written) == ("SUCCESS", 8, 8)
    assert re.fullmatch("[0-9a-f]{64}", result.checksum)
    assert result.checksum == batch_checksum(batch).first()["checksum"]
    rows = stored(spark, spec, batch.schema)
    assert rows.columns == [
        "id", "name", "amount", "_ingestion_ts", "_source_name", "_run_id", "_checksum",
        "ingestion_date", "source_name",
    ]
    meta = rows.select(*rows.columns[3:]).distinct().collect()
    assert [tuple(r) for r in meta] == [
        (RUN_TS, "mem", "r1", result.checksum, "2024-05-01", "mem")
    ]
    event = audit(spark, spec).first()
    assert (event.run_id, event.source_name, event.source_type) == ("r1", "mem", "stream")
    assert event.pipeline_start_ts == RUN_TS <= event.pipeline_end_ts
    assert event.bronze_path == result.path and event.error_message is None
    assert audit_table.read_lineage(spark, spec.audit.lineage_path).count() == 1


@pytest.mark.parametrize("kind", ["literal", "filtered", "no files", "pruned"])
@pytest.mark.parametrize("partition_by", [(), ("name",)])
def test_empty_batches_commit(spark, spec, batch, tmp_path, kind, partition_by):
    if kind == "literal":
        empty = spark.createDataFrame([], SCHEMA)
    elif kind == "filtered":
        empty = batch.where("id > 99")
    elif kind == "pruned":
        empty = batch.where("1 = 0")
    else:
        batch.where("id > 99").write.parquet(f"{tmp_path}/nothing")
        empty = spark.read.schema(batch.schema).option("pathGlobFilter", "none*").parquet(
            f"{tmp_path}/nothing"
        )
    storage = replace(spec.storage, partition_by=partition_by)
    changed = replace(reading(spec, empty), storage=storage)
    result = ingest(spark, changed, run_id="r1", run_ts=RUN_TS, verify_stored=True)
    assert (result.status, result.records_read, result.records_written) == ("SUCCESS", 0, 0)
    assert result.checksum == batch_checksum(empty).first()["checksum"]


def test_appends_accumulate(spark, spec, batch):
    ingest(spark, spec, run_id="r1", run_ts=RUN_TS)
    more = spark.range(10, 15).selectExpr("id", "'x' AS name", "1.0D AS amount")
    ingest(spark, reading(spec, more), run_id="r2", run_ts=RUN_TS)
    assert stored(spark, spec, batch.schema).count() == 13


def test_committed_run_is_immutable(spark, spec, batch):
    ingest(spark, spec, run_id="r1", run_ts=RUN_TS)
    with pytest.raises(StorageWriteError, match="committed"):
        ingest(spark, reading(spec, batch.limit(1)), run_id="r1", run_ts=RUN_TS)
    with pytest.raises(StorageWriteError, match="committed"):
        bronze.stage_run(
            classify(batch, []), spec.storage.path, "mem", "r1", RUN_TS, audit_path=spec.audit.path
        )
    assert stored(spark, spec, batch.schema).count() == 8


def test_crashed_attempts_stay_invisible_and_retries_replace_them(spark, spec, batch):
    """Files without an audit row, from the same day and from the day before."""
    ingest(spark, spec, run_id="r0", run_ts=RUN_TS)
    twice = classify(batch.unionByName(batch), [])
    for at in (RUN_TS, RUN_TS - dt.timedelta(days=1)):
        bronze.stage_run(twice, spec.storage.path, "mem", "r1", at)
    assert stored(spark, spec, batch.schema).count() == 8
    ingest(spark, spec, run_id="r1", run_ts=RUN_TS, verify_stored=True)
    assert stored(spark, spec, batch.schema).count() == 16


def test_quarantine_and_partial_status(spark, spec, batch):
    doubled = batch.unionByName(batch.where("id = 8"))
    result = ingest(
        spark, reading(spec, doubled), run_id="r1", run_ts=RUN_TS, rules=[Range("amount", 0, 600)]
    )
    assert (result.status, result.records_read) == ("PARTIAL", 9)
    assert (result.records_written, result.quarantine_count, result.alert) == (6, 3, True)
    held = bronze.read_quarantine(spark, spec.quarantine.path, batch.schema)
    assert sorted(r.id for r in held.collect()) == [7, 8, 8]
    assert held.select("row_id").distinct().count() == 3
    assert {tuple(r[CODES]) for r in held.collect()} == {("RANGE_VIOLATION",)}
    assert stored(spark, spec, batch.schema).count() == 6


def test_strict_mode_aborts(spark, spec, batch):
    strict = replace(spec, schema_enforcement=SchemaEnforcement(mode="strict"))
    with pytest.raises(QualityViolation, match="3 rows"):
        ingest(spark, strict, run_id="r1", run_ts=RUN_TS, rules=[Range("amount", 0, 500)])
    event = audit(spark, spec).first()
    assert (event.status, event.records_read, event.quarantine_count) == ("FAILURE", 8, 3)
    assert stored(spark, spec, batch.schema).count() == 0


def test_count_mismatch_aborts_before_the_commit(spark, spec, batch):
    with pytest.raises(StorageWriteError, match="mismatch"):
        ingest(spark, spec, run_id="r1", run_ts=RUN_TS, mismatch_threshold=-1)
    assert audit(spark, spec).first().status == "FAILURE"
    assert stored(spark, spec, batch.schema).count() == 0
    assert ingest(spark, spec, run_id="r1", run_ts=RUN_TS).status == "SUCCESS"


def test_changed_files_fail_verification(spark, spec, batch, tmp_path):
    staged = bronze.stage_run(classify(batch, []), spec.storage.path, "mem", "r1", RUN_TS)
    edited = classify(batch.withColumn("amount", F.col("amount") + 1), [])
    other = bronze.stage_run(edited, f"{tmp_path}/other", "mem", "r1", RUN_TS)
    forged = replace(staged, path=other.path)
    assert bronze.reconcile_run(spark, forged, batch.schema) == (8, 0)
    with pytest.raises(StorageWriteError, match="checksum"):
        bronze.reconcile_run(spark, forged, batch.schema, verify_stored=True)


def test_corrupt_source_is_a_connector_error(spark, spec, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,amount\n1,a,1\nBAD,b,2\n")
    schema = spark.createDataFrame([], SCHEMA).schema
    base = replace(
        spec,
        connection=Connection("file", file_path=f"{tmp_path}/a.csv", file_format="csv"),
        schema_enforcement=SchemaEnforcement(registered=schema),
    )
    with pytest.raises(ConnectorError):
        ingest(spark, base, run_id="r1", run_ts=RUN_TS)
    permissive = replace(
        base, schema_enforcement=SchemaEnforcement(schema, corrupt_mode="PERMISSIVE")
    )
    result = ingest(spark, permissive, run_id="r2", run_ts=RUN_TS)
    assert (result.records_written, result.quarantine_count) == (1, 1)
    held = bronze.read_quarantine(spark, spec.quarantine.path, result.schema).first()
    assert (held["_corrupt_record"], held[CODES]) == ("BAD,b,2", ["CORRUPT_RECORD"])
    dropping = replace(
        base, schema_enforcement=SchemaEnforcement(schema, corrupt_mode="DROPMALFORMED")
    )
    assert ingest(spark, dropping, run_id="r3", run_ts=RUN_TS).records_read == 1


def test_other_failures_are_typed_and_audited(spark, spec, tmp_path):
    def broken(_):
        raise RuntimeError("down")

    with pytest.raises(ConnectorError, match="down"):
        ingest(
            spark,
            replace(spec, connection=Connection("stream", reader=broken)),
            run_id="r1",
            run_ts=RUN_TS,
        )
    with pytest.raises(ConfigurationError):
        ingest(
            spark, replace(spec, connection=Connection("stream")), run_id="r2", run_ts=RUN_TS
        )
    with pytest.raises(UnexpectedError):
        ingest(
            spark, spec, run_id="r3", run_ts=RUN_TS, validator=lambda df: df.where("no_such > 1")
        )
    with pytest.raises(ConfigurationError):
        ingest(spark, spec, run_id="../r4", run_ts=RUN_TS)
    events = audit(spark, spec).collect()
    assert {e.status for e in events} == {"FAILURE"} and len(events) == 4
    assert all(e.error_message for e in events)


def test_unwritable_audit_of_a_failure_is_swallowed(spark, spec, tmp_path):
    (tmp_path / "file").write_text("not a folder")
    blocked = replace(spec, audit=Audit(f"{tmp_path}/file/audit"))
    with pytest.raises(StorageWriteError, match="mismatch"):
        ingest(spark, blocked, run_id="r1", run_ts=RUN_TS, mismatch_threshold=-1)


def test_lineage_failure_leaves_the_run_committed(spark, spec, tmp_path, batch):
    (tmp_path / "file").write_text("not a folder")
    blocked = replace(spec, audit=replace(spec.audit, lineage_path=f"{tmp_path}/file/lineage"))
    assert ingest(spark, blocked, run_id="r1", run_ts=RUN_TS).status == "SUCCESS"
    assert stored(spark, spec, batch.schema).count() == 8


def test_validator_losses_are_counted(spark, spec):
    result = ingest(
        spark, spec, run_id="r1", run_ts=RUN_TS, validator=lambda df: df.where("id > 2")
    )
    assert (result.status, result.records_read) == ("PARTIAL", 8)
    assert (result.records_written, result.quarantine_count, result.dropped_count) == (6, 0, 2)


def test_recovery_survives_a_crash_and_repeats(spark, spec, batch, monkeypatch):
    ingest(spark, spec, run_id="r1", run_ts=RUN_TS, rules=[Range("amount", 0, 600)])
    looser = [Range("amount", 0, 700)]

    def full(*_):
        raise OSError("disk full")

    monkeypatch.setattr(audit_table, "append_audit", full)
    with pytest.raises(UnexpectedError):
        recover(spark, spec, batch.schema, run_id="c0", run_ts=RUN_TS, rules=looser)
    monkeypatch.undo()
    assert released_rows(spark, spec).isEmpty()
    assert stored(spark, spec, batch.schema).count() == 6
    first = recover(spark, spec, batch.schema, run_id="c1", run_ts=RUN_TS, rules=looser)
    assert (first.records_read, first.records_written) == (1, 1)
    assert released_rows(spark, spec).count() == 1
    again = recover(spark, spec, batch.schema, run_id="c2", run_ts=RUN_TS, rules=looser)
    assert again.records_read == 0
    rest = recover(spark, spec, batch.schema, run_id="c3", run_ts=RUN_TS, rules=[])
    assert rest.records_read == 1
    assert sorted(r.id for r in stored(spark, spec, batch.schema).collect()) == list(range(1, 9))


def test_validator_may_add_rows(spark, spec):
    result = ingest(
        spark, spec, run_id="r1", run_ts=RUN_TS, validator=lambda df: df.unionByName(df)
    )
    assert (result.status, result.records_read) == ("SUCCESS", 8)
    assert (result.records_written, result.quarantine_count) == (16, 0)


def test_quarantine_of_aborted_runs_is_not_read(spark, spec, batch, monkeypatch):
    def full(*_):
        raise OSError("disk full")

    monkeypatch.setattr(audit_table, "append_audit", full)
    with pytest.raises(UnexpectedError, match="disk full"):
        ingest(spark, spec, run_id="r1", run_ts=RUN_TS, rules=[Range("amount", 0, 600)])
    monkeypatch.undo()
    assert bronze.read_quarantine(spark, spec.quarantine.path, batch.schema).count() == 2
    held = bronze.read_quarantine(
        spark, spec.quarantine.path, batch.schema, audit(spark, spec)
    )
    assert held.isEmpty()
    assert stored(spark, spec, batch.schema).isEmpty()


def test_compaction_as_part_of_a_run(spark, spec, batch):
    storage = replace(spec.storage, compaction_enabled=True)
    daily = replace(spec, storage=storage)
    for i in range(3):
        ingest(spark, daily, run_id=f"r{i}", run_ts=RUN_TS + dt.timedelta(days=i))
    rows = stored(spark, spec, batch.schema, compacted_root=storage.compacted_path)
    assert rows.count() == 24
    done = bronze.read_compactions(spark, storage.compacted_path)
    assert sorted(r.run_id for r in done.collect()) == ["r0", "r1"]


def test_compaction_keeps_the_configured_partitions(spark, spec, batch):
    storage = replace(spec.storage, partition_by=("name",), compaction_enabled=True)
    for i in range(2):
        at = RUN_TS + dt.timedelta(days=i)
        ingest(spark, replace(spec, storage=storage), run_id=f"r{i}", run_ts=at)
    root = storage.compacted_path
    rows = stored(spark, spec, batch.schema, partition_by=("name",), compacted_root=root)
    assert rows.select(*batch.columns).exceptAll(batch.unionByName(batch)).isEmpty()
    assert rows.count() == 16
    assert all("/name=n" in f for f in spark.read.parquet(f"{root}/data").inputFiles())


def test_lag_never_moves_the_mark_back(spark, spec, tmp_path):
    marks = f"{tmp_path}/marks"
    lagging = replace(spec, ingestion=Ingestion("incremental", "id", marks, lag_units=4))
    ingest(spark, lagging, run_id="r1", run_ts=RUN_TS)
    assert read_watermark(spark, marks, "mem-1").integer == 8
    rules = [Range("id", 0, 6)]
    again = ingest(
        spark, lagging, run_id="r2", run_ts=RUN_TS + dt.timedelta(hours=1), rules=rules
    )
    assert (again.records_read, again.records_written) == (4, 2)
    assert read_watermark(spark, marks, "mem-1").integer == 8


def test_incremental_runs_read_quarantined_rows_once(spark, spec, tmp_path):
    """Quarantined rows are stored as well, so the mark moves past them."""
    marks = f"{tmp_path}/marks"
    incremental = replace(spec, ingestion=Ingestion("incremental", "id", marks))
    first = ingest(spark, incremental, run_id="r1", run_ts=RUN_TS, rules=[Range("id", 0, 6)])
    assert (first.records_written, first.quarantine_count) == (6, 2)
    assert read_watermark(spark, marks, "mem-1").integer == 8
    second = ingest(spark, incremental, run_id="r2", run_ts=RUN_TS + dt.timedelta(hours=1))
    assert (second.status, second.records_read) == ("SUCCESS", 0)
    assert read_watermark(spark, marks, "mem-1").integer == 8


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
@pytest.mark.parametrize("data_type", ["TIMESTAMP", "TIMESTAMP_NTZ"])
def test_incremental_by_time_in_any_zone(spark, spec, tmp_path, conf, zone, data_type):
    conf("spark.sql.session.timeZone", zone)
    times = [f"2024-01-0{d} 10:00:00.00000{d}" for d in range(1, 6)]
    rows = spark.createDataFrame([(t,) for t in times], "t STRING")
    rows = rows.select(F.col("t").cast(data_type).alias("t"))
    by_time = replace(spec, ingestion=Ingestion("incremental", "t", f"{tmp_path}/marks"))
    first = reading(by_time, rows.where("t < '2024-01-04'"))
    assert ingest(spark, first, run_id="r1", run_ts=RUN_TS).records_written == 3
    mark = read_watermark(spark, f"{tmp_path}/marks", "mem-1")
    assert mark.ts == dt.datetime(2024, 1, 3, 10, 0, 0, 3)
    later = RUN_TS + dt.timedelta(hours=1)
    second = ingest(spark, reading(by_time, rows), run_id="r2", run_ts=later)
    assert second.records_written == 2


def test_partitioned_storage_with_a_hot_value(spark, spec):
    hot = spark.range(2000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise((F.col("id") % 10).cast("string"))
        .alias("p"),
    )
    parted = replace(reading(spec, hot), storage=Storage(spec.storage.path, ("p",)))
    result = ingest(spark, parted, run_id="r1", run_ts=RUN_TS, verify_stored=True)
    rows = stored(spark, spec, result.schema, partition_by=("p",))
    assert rows.select("id", "p").exceptAll(hot).isEmpty() and rows.count() == 2000
    plan = rows.where("p = 'hot'")._jdf.queryExecution().executedPlan().toString()
    assert "(p#" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_large_reference_works_on_a_stored_extract(spark, spec, conf, batch):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rules = [Completeness(("id",)), Referential("id", spark.range(6), "id")]
    result = ingest(spark, spec, run_id="r1", run_ts=RUN_TS, rules=rules, verify_stored=True)
    assert (result.records_written, result.quarantine_count) == (5, 3)


def test_source_is_evaluated_once(spark, spec, batch):
    seen = spark.sparkContext.accumulator(0)

    def count_rows(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    counted = batch.mapInPandas(count_rows, batch.schema)
    ingest(spark, reading(spec, counted), run_id="r1", run_ts=RUN_TS, rules=[Range("id", 0, 3)])
    assert seen.value == 8


def test_compaction_merges_files_and_keeps_rows(spark, spec, tmp_path):
    parts = spark.range(1000).selectExpr("id", "CAST(id % 7 AS STRING) AS name")
    for i in range(3):
        at = RUN_TS + dt.timedelta(days=i)
        for j in range(2):
            run = parts.where(f"id % 6 = {2 * i + j}").repartition(8)
            ingest(spark, reading(spec, run), run_id=f"r{i}{j}", run_ts=at)
    root, day = f"{tmp_path}/compact", "2024-05-03"
    before = stored(spark, spec, parts.schema)
    expected = batch_checksum(before.select("id", "name", "_run_id", "_checksum")).first()
    def compacted(number):
        return bronze.compact(
            spark, spec.storage.path, root, audit(spark, spec), parts.schema, number,
            source_name=spec.metadata.source_name, before=day,
        )

    check = compacted("c1")
    assert sorted(r.ingestion_date for r in check.collect()) == ["2024-05-01", "2024-05-02"]
    after = stored(spark, spec, parts.schema, compacted_root=root)
    found = batch_checksum(after.select("id", "name", "_run_id", "_checksum")).first()
    assert found == expected and found.row_count == 1000
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SubqueryAdaptiveBroadcast dynamicpruning") >= 2
    assert len(spark.read.parquet(f"{root}/data").inputFiles()) <= 4
    # Garbage in the replaced runs goes unnoticed, because their files are not opened.
    for file in before.inputFiles():
        if "/bronze/" in file and day not in file:
            Path(file.removeprefix("file://")).write_bytes(b"garbage")
    assert batch_checksum(after.select("id", "name", "_run_id", "_checksum")).first() == expected
    late = parts.where("id < 10")
    ingest(spark, reading(spec, late), run_id="late", run_ts=RUN_TS)
    assert stored(spark, spec, parts.schema, compacted_root=root).count() == 1010
    compacted("c2")
    assert stored(spark, spec, parts.schema, compacted_root=root).count() == 1010


def test_expired_quarantine_is_dropped_and_nothing_else(spark, spec, batch):
    rules = [Range("amount", 0, 100)]
    ingest(spark, spec, run_id="old", run_ts=RUN_TS, rules=rules)
    ingest(spark, spec, run_id="new", run_ts=RUN_TS + dt.timedelta(days=60), rules=rules)
    today = (RUN_TS + dt.timedelta(days=91)).date()
    removed = lake.drop_expired_quarantine(
        spark, spec.quarantine.path, audit(spark, spec), 90, today
    )
    assert [p.split("/")[-1] for p in removed] == ["_run_id=old"]
    held = bronze.read_quarantine(spark, spec.quarantine.path, batch.schema)
    assert {r["_run_id"] for r in held.collect()} == {"new"}
    assert lake.drop_expired_quarantine(
        spark, spec.storage.path, audit(spark, spec), 90, today
    ) == []
    assert stored(spark, spec, batch.schema).count() == 2


def test_two_attempts_commit_once(spark, spec):
    event = audit_table.AuditEvent("r1", "mem", "stream", RUN_TS, RUN_TS, checksum="x")
    audit_table.append_audit(spark, spec.audit.path, event)
    with pytest.raises(StorageWriteError, match="committed"):
        audit_table.append_audit(spark, spec.audit.path, event)
    assert audit(spark, spec).count() == 1
    assert audit_table.is_committed(spark, spec.audit.path, "mem", "r1")


def test_quarantined_rows_move_the_mark_and_are_released_once(spark, spec, batch, tmp_path):
    """Bad rows above the mark are read once, and two sources may share run ids."""
    ingestion = Ingestion("incremental", "id", f"{tmp_path}/marks")
    specs = [
        replace(spec, metadata=Metadata(name, name), ingestion=ingestion) for name in ("a", "b")
    ]
    top = batch.agg(F.max("id")).first()[0]
    rules = [Range("id", None, top - 1)]
    for each in specs:
        for n in (1, 2, 3):
            ingest(spark, each, run_id=f"r{n}", run_ts=RUN_TS, rules=rules)
        held = bronze.read_quarantine(spark, spec.quarantine.path, batch.schema, audit(spark, spec))
        assert held.where(F.col("source_name") == each.metadata.source_name).count() == 1
    for each in specs:
        recover(spark, each, batch.schema, run_id="again", run_ts=RUN_TS, rules=[])
        recover(spark, each, batch.schema, run_id="once-more", run_ts=RUN_TS, rules=[])
    rows = bronze.read_bronze(spark, spec.storage.path, audit(spark, spec), batch.schema)
    counts = {(r.source_name, r.id): r["count"] for r in rows.groupBy("source_name", "id").count().collect()}
    assert set(counts.values()) == {1} and len(counts) == 2 * batch.count()
    early = lake.as_of(rows, audit(spark, spec), RUN_TS + dt.timedelta(days=1))
    assert early.count() == rows.count()


def test_one_record_holds_the_run(spark, spec, tmp_path):
    """Mark, lineage, alert and missed deadline are there as soon as the run is."""
    marks = f"{tmp_path}/marks"
    watched = replace(
        spec,
        ingestion=Ingestion("incremental", "id", marks),
        monitoring=Monitoring(sla_threshold_seconds=0),
    )
    result = ingest(spark, watched, run_id="r1", run_ts=RUN_TS, rules=[Range("id", 0, 2)])
    assert result.alert and result.sla_missed
    row = audit_table.read_runs(spark, spec.audit.path, "mem").first()
    assert (row.number, row.run_id, row.status, row.alert, row.sla_missed) == (1, "r1", "PARTIAL", True, True)
    assert (row.watermark_type, row.watermark_value, row.watermark_storage) == ("INTEGER", "8", marks)
    assert row.source_id == "mem-1" and row.schema_ddl.startswith("struct<id:bigint")


def test_mark_holds_without_its_copy(spark, spec, monkeypatch, tmp_path):
    """A crash right after the commit: the next run goes by the record."""
    from sparkingest.plans import ingest as module

    def lost(*_):
        raise OSError("gone")

    incremental = replace(spec, ingestion=Ingestion("incremental", "id", f"{tmp_path}/marks"))
    monkeypatch.setattr(module, "append_watermark", lost)
    assert ingest(spark, incremental, run_id="r1", run_ts=RUN_TS).records_read == 8
    assert read_watermark(spark, f"{tmp_path}/marks", "mem-1") is None
    assert ingest(spark, incremental, run_id="r2", run_ts=RUN_TS).records_read == 0


def test_racing_attempts(spark, spec):
    """Eight runs and eight attempts of one run at once: each commits once."""
    from concurrent.futures import ThreadPoolExecutor

    def attempt(n):
        run_id = f"r{n}" if n < 8 else "same"
        event = audit_table.AuditEvent(run_id, "mem", "stream", RUN_TS, RUN_TS, checksum="x")
        try:
            return audit_table.append_audit(spark, spec.audit.path, event)
        except StorageWriteError:
            return None

    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(attempt, range(16)))
    assert sorted(n for n in numbers if n is not None) == list(range(1, 10))
    runs = [r.run_id for r in audit(spark, spec).collect()]
    assert sorted(runs) == sorted([*(f"r{n}" for n in range(8)), "same"])


def test_long_logs_open_few_files(spark, spec, monkeypatch):
    """Records behind the last snapshot only, for the rows, the mark and a look-up of a run."""
    from sparkingest.operators import commits

    for n in range(1, 36):
        event = audit_table.AuditEvent(f"r{n}", "mem", "stream", RUN_TS, RUN_TS, records_read=n)
        details = audit_table.RunDetails(
            watermark_type="INTEGER", watermark_value=str(n), watermark_storage="m"
        )
        audit_table.append_audit(spark, spec.audit.path, event, details)
    opened = []
    read = commits.read_text
    monkeypatch.setattr(commits, "read_text", lambda s, p: opened.append(p) or read(s, p))
    runs = audit_table.read_audit(spark, spec.audit.path, "mem")
    assert sorted(r.records_read for r in runs.collect()) == list(range(1, 36))
    assert audit_table.is_committed(spark, spec.audit.path, "mem", "r3")
    assert not audit_table.is_committed(spark, spec.audit.path, "mem", "r99")
    assert audit_table.committed_watermark(spark, spec.audit.path, "mem", "m") == ("INTEGER", "35")
    # Four look-ups of a hint, a snapshot and three records each.
    assert len(opened) <= 20 and len(runs.inputFiles()) == 1


def test_validator_rows_are_compared_one_by_one(spark, spec, batch):
    """Four rows go and four come: nothing hides behind the equal count."""
    extra = spark.range(20, 24).selectExpr("id", "'x' AS name", "1.0D AS amount")
    result = ingest(
        spark,
        reading(spec, batch.unionByName(batch.where("id = 1"))),
        run_id="r1",
        run_ts=RUN_TS,
        validator=lambda df: df.where("id > 3").unionByName(extra),
    )
    assert (result.status, result.records_read, result.dropped_count) == ("PARTIAL", 9, 4)
    row = audit_table.read_runs(spark, spec.audit.path, "mem").first()
    assert (row.added_count, row.records_written) == (4, 9)
    lost = spark.read.schema(batch.schema).parquet(dropped_path(spec, "r1"))
    assert sorted(r.id for r in lost.collect()) == [1, 1, 2, 3]


def test_retention_settings_act(spark, spec, batch):
    """Ninety days of quarantine by the source's own setting; the log only reports."""
    kept = replace(spec, quarantine=replace(spec.quarantine, retention_days=90))
    drop = lambda df: df.where("id > 1")
    rules = [Range("amount", 0, 100)]
    ingest(spark, kept, run_id="old", run_ts=RUN_TS, rules=rules, validator=drop)
    ingest(spark, kept, run_id="new", run_ts=RUN_TS + dt.timedelta(days=60), rules=rules)
    today = (RUN_TS + dt.timedelta(days=91)).date()
    removed = lake.expire_quarantine(spark, kept, today)
    assert [p.split("/")[-1] for p in removed] == ["_run_id=old", "_run_id=old"]
    assert lake.expire_quarantine(spark, kept, today) == []
    held = bronze.read_quarantine(spark, kept.quarantine.path, batch.schema)
    assert {r["_run_id"] for r in held.collect()} == {"new"}
    short = replace(kept, audit=replace(kept.audit, retention_days=60))
    assert [r.run_id for r in lake.expired_runs(spark, short, today).collect()] == ["old"]
    assert audit(spark, kept).count() == 2
