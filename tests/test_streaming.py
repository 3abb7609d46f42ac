from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from tests.conftest import rows_of

from sparkingest.config import Audit, Connection, Metadata, Quarantine, SourceSpec, Storage
from sparkingest.operators import audit as audit_table
from sparkingest.operators import bronze
from sparkingest.operators.quality import CODES, Range
from sparkingest.plans.catalog import ddl
from sparkingest.streaming.ingest import (
    dedupe_stream,
    ingest_stream,
    json_messages,
    late_records,
    sessions,
    throughput,
    write_files,
)

SCHEMA = "k STRING, ts TIMESTAMP, v BIGINT"
DRAIN = {"availableNow": True}
START = dt.datetime(2024, 1, 1)


def land(spark, path, rows):
    df = spark.createDataFrame([(k, START + dt.timedelta(minutes=m), v) for k, m, v in rows], SCHEMA)
    df.write.mode("append").json(path)


def stream(spark, path):
    return json_messages(spark, path, ddl(SCHEMA))


def test_each_batch_is_one_audited_run_and_replays_are_skipped(spark, tmp_path):
    inbox = f"{tmp_path}/in"
    spec = SourceSpec(
        metadata=Metadata("s", "s"),
        connection=Connection("stream"),
        storage=Storage(f"{tmp_path}/bronze"),
        audit=Audit(f"{tmp_path}/audit"),
        quarantine=Quarantine(f"{tmp_path}/held"),
    )

    def drain(checkpoint):
        ingest_stream(
            stream(spark, inbox),
            spec,
            "feed",
            f"{tmp_path}/{checkpoint}",
            rules=[Range("v", 0, 10)],
            trigger=DRAIN,
            clock=lambda: START,
        ).awaitTermination()

    land(spark, inbox, [("a", 0, 1), ("b", 1, 99)])
    drain("c1")
    land(spark, inbox, [("c", 2, 3)])
    drain("c1")
    audit = audit_table.read_audit(spark, spec.audit.path)
    assert rows_of(audit.select("run_id", "status", "records_read")) == [
        ("feed-0", "PARTIAL", 2),
        ("feed-1", "SUCCESS", 1),
    ]
    # A lost checkpoint delivers everything again as batch 0, which is committed already.
    drain("c2")
    audit = audit_table.read_audit(spark, spec.audit.path)
    assert audit.count() == 2
    rows = bronze.read_bronze(spark, spec.storage.path, audit, ddl(SCHEMA))
    assert rows_of(rows.select("k")) == [("a",), ("c",)]
    held = bronze.read_quarantine(spark, spec.quarantine.path, ddl(SCHEMA))
    assert rows_of(held.select("k", CODES)) == [("b", ["RANGE_VIOLATION"])]


def accept(spark, tmp_path, *slices, keys=("k",), delay="10 minutes"):
    for rows in slices:
        land(spark, f"{tmp_path}/in", rows)
        write_files(
            dedupe_stream(stream(spark, f"{tmp_path}/in"), keys, "ts", delay),
            f"{tmp_path}/out",
            f"{tmp_path}/checkpoint",
            DRAIN,
        ).awaitTermination()
    raw = spark.read.schema(ddl(SCHEMA)).json(f"{tmp_path}/in")
    accepted = spark.read.schema(ddl(SCHEMA)).parquet(f"{tmp_path}/out")
    return raw, accepted


def test_duplicates_and_late_rows(spark, tmp_path):
    first = [("a", 0, 1), ("a", 0, 1), ("b", 60, 1)] + [("hot", 59, 1)] * 200
    second = [("a", 0, 1), ("b", 60, 1), ("late", 10, 1), ("fine", 55, 1)]
    raw, accepted = accept(spark, tmp_path, first, second, keys=("k", "ts"))
    assert rows_of(accepted.select("k")) == [("a",), ("b",), ("fine",), ("hot",)]
    late = late_records(raw, accepted, ["k", "ts"])
    assert rows_of(late.select("k", CODES)) == [("late", ["LATE_RECORD"])]


def test_copies_are_dropped_and_values_are_kept(spark, tmp_path):
    rows = [(f"k{i % 7}", i % 5, 2**53 + 1) for i in range(100)]
    _, accepted = accept(spark, tmp_path, rows, keys=("k", "ts"))
    assert accepted.count() == 35
    assert {r.n for r in accepted.select(accepted.columns[-1]).toDF("n").collect()} == {2**53 + 1}


def test_throughput_emits_closed_windows(spark, tmp_path):
    land(spark, f"{tmp_path}/in", [("a", 0, 1), ("b", 0, 1), ("c", 1, 1), ("d", 30, 1)])
    write_files(
        throughput(stream(spark, f"{tmp_path}/in"), "ts", "5 minutes"),
        f"{tmp_path}/out",
        f"{tmp_path}/checkpoint",
        DRAIN,
    ).awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    found = out.select(F.minute("window_start"), "events", "events_per_second")
    assert rows_of(found) == [(0, 2, 2 / 60), (1, 1, 1 / 60)]


def test_late_rows_go_to_quarantine_in_their_batch(spark, tmp_path, monkeypatch):
    """The bound is the greatest event time of the batches before; a batch whose commit was
    lost is judged again by the same bound."""
    inbox = f"{tmp_path}/in"
    spec = SourceSpec(
        metadata=Metadata("s", "s"),
        connection=Connection("stream"),
        storage=Storage(f"{tmp_path}/bronze"),
        audit=Audit(f"{tmp_path}/audit"),
        quarantine=Quarantine(f"{tmp_path}/held"),
    )

    def drain():
        ingest_stream(
            stream(spark, inbox),
            spec,
            "feed",
            f"{tmp_path}/checkpoint",
            trigger=DRAIN,
            clock=lambda: START,
            event_time="ts",
            delay=dt.timedelta(minutes=10),
        ).awaitTermination()

    def held():
        audit = audit_table.read_audit(spark, spec.audit.path)
        rows = bronze.read_quarantine(spark, spec.quarantine.path, ddl(SCHEMA), audit)
        return sorted((r.k, r["_run_id"], r[CODES]) for r in rows.collect())

    # Within the first batch nothing is late, however far apart.
    land(spark, inbox, [("a", 0, 1), ("b", 60, 1)])
    drain()
    assert held() == []
    land(spark, inbox, [("c", 49, 1), ("d", 50, 1), ("e", 500, 1)])
    append = audit_table.append_audit
    monkeypatch.setattr(audit_table, "append_audit", lambda *_: 1 / 0)
    with pytest.raises(StreamingQueryException):
        drain()
    monkeypatch.setattr(audit_table, "append_audit", append)
    drain()
    drain()
    assert held() == [("c", "feed-1", ["LATE_RECORD"])]
    # An older batch does not move the bound back.
    land(spark, inbox, [("f", 495, 1)])
    drain()
    land(spark, inbox, [("g", 489, 1), ("h", 491, 1)])
    drain()
    assert held() == [("c", "feed-1", ["LATE_RECORD"]), ("g", "feed-3", ["LATE_RECORD"])]


def test_punctuation_closes_windows_and_sessions(spark, tmp_path):
    message = F.col("v").isNotNull()

    def drain(name, aggregate):
        df = aggregate(stream(spark, f"{tmp_path}/in"))
        write_files(df, f"{tmp_path}/{name}", f"{tmp_path}/{name}-c", DRAIN).awaitTermination()
        return spark.read.parquet(f"{tmp_path}/{name}")

    land(spark, f"{tmp_path}/in", [("a", 0, 1), ("a", 9, 1), ("b", 5, 1), ("a", 30, 1)])
    windows = lambda s: throughput(s, "ts", "1 minute", "10 minutes", message=message)
    parts = lambda s: sessions(s, "ts", "1 minute", "k", "10 minutes", message=message)
    assert drain("w", windows).agg(F.sum("events")).first()[0] == 3
    land(spark, f"{tmp_path}/in", [(None, 600, None)])
    assert sorted(r.events for r in drain("w", windows).collect()) == [1, 3]
    found = sorted((r.k, r.events, r.last_event) for r in drain("s", parts).collect())
    at = lambda m: START + dt.timedelta(minutes=m)
    assert found == [("a", 1, at(30)), ("a", 2, at(9)), ("b", 1, at(5))]
