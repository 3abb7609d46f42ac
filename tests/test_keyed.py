"""Keyed tables: change logs in any order, versions, pruning, compaction, two writers."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from tests.conftest import plan_of, rows_of

from sparkingest.errors import StorageWriteError
from sparkingest.operators import keyed, silver
from sparkingest.session import scratch_table

SCHEMA = "id BIGINT, version INT, month STRING, v STRING, op STRING"
KEYS, VERSIONS = ["id"], ["version"]


def changes(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def apply(spark, path, rows, **more):
    return silver.merge_changes(spark, path, changes(spark, rows), KEYS, VERSIONS, "op", "month", **more)


def expected(rows):
    """Greatest version per key over all batches, deletes taken out."""
    best = {}
    for row in rows:
        if row[0] not in best or row[1] > best[row[0]][1]:
            best[row[0]] = row
    return sorted(((*r[:4],) for r in best.values() if r[4] != "D"), key=repr)


def live(spark, path, **more):
    return rows_of(silver.read_silver(spark, path, **more).drop("part"))


def random_batches(seed, count=4):
    """Versions unique over all batches, so that the greatest one is one row."""
    rng = random.Random(seed)
    version = list(range(count * 20))
    rng.shuffle(version)
    ids = [None, *range(25)]
    return [
        [
            (rng.choice(ids), version.pop(), f"2024-0{rng.randint(1, 3)}", f"b{n}", rng.choice("IUUD"))
            for _ in range(20)
        ]
        for n in range(count)
    ]


@pytest.mark.parametrize("seed", [1])
def test_batches_in_any_order(spark, tmp_path, seed):
    """Every commit reads as the batches up to it, also after compaction and a snapshot."""
    path, seen, states = f"{tmp_path}/t", [], {}
    for n, batch in enumerate(random_batches(seed)):
        seen += batch
        number = apply(spark, path, batch)
        states[number] = expected(seen)
        if n == 2:
            states[keyed.compact(spark, path, replaced_share=0.0)] = expected(seen)
        if n == 3:
            keyed.take_snapshot(spark, path, number)
        assert live(spark, path) == expected(seen)
    for number, rows in states.items():
        assert live(spark, path, version=number) == rows
    log = silver.live_partitions(spark, path)
    assert log.agg(F.sum("row_count")).first()[0] == len({r[0] for r in seen})


def test_snapshot_stands_for_the_log(spark, tmp_path):
    path = f"{tmp_path}/t"
    for n in range(3):
        apply(spark, path, [(i, n, "a", f"v{n}", "U") for i in range(n, 6)])
    before = live(spark, path)
    log = keyed.commit_log(spark, path)
    keyed.take_snapshot(spark, path, 3)
    # A log that is due at every third entry finds it and no record before it.
    short = type(log)(spark, log.path, every=3)
    assert short.base(3)[0] == 3 and short.tail(3, 3) == []
    state = keyed.State(
        3, keyed.state_of(spark, path).schema, ("id",), tuple(f"{path}/{f}" for f in short.base(3)[1]["files"]),
        pointers=tuple(f"{path}/{f}" for f in short.base(3)[1]["pointers"]),
    )
    rows = keyed._live_rows(spark, path, state, state.schema, keyed.live_files(spark, state))
    assert rows_of(rows) == before


def test_deleted_key_stays_deleted(spark, tmp_path):
    path = f"{tmp_path}/t"
    apply(spark, path, [(1, 5, "a", "x", "I"), (2, 5, "a", "y", "I")])
    apply(spark, path, [(1, 9, "a", None, "D")])
    apply(spark, path, [(1, 7, "a", "late", "U"), (2, 3, "a", "late", "U")])
    assert live(spark, path) == [(2, 5, "a", "y")]
    keyed.compact(spark, path, replaced_share=0.0)
    apply(spark, path, [(1, 8, "a", "late", "U")])
    assert live(spark, path) == [(2, 5, "a", "y")]
    keyed.compact(spark, path, small_rows=100, drop_deleted=F.col("version") < 10)
    apply(spark, path, [(1, 8, "a", "late", "U")])
    assert live(spark, path) == [(1, 8, "a", "late"), (2, 5, "a", "y")]


def test_delete_in_a_first_batch_and_empty_batches(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert apply(spark, path, []) == 0
    assert live(spark, f"{path}") == []
    assert apply(spark, path, [(1, 2, "a", "x", "D"), (2, 1, None, "y", None)]) == 1
    assert apply(spark, path, []) == 1 and apply(spark, path, [(1, 1, "a", "x", "U")]) == 1
    assert rows_of(silver.read_silver(spark, path)) == [(2, 1, None, "y", "none")]


def test_batch_is_known_by_its_name(spark, tmp_path):
    path = f"{tmp_path}/t"
    apply(spark, path, [(1, 1, "a", "x", "I")], batch_id="b1")
    assert apply(spark, path, [(1, 2, "a", "y", "U")], batch_id="b2") == 2
    assert apply(spark, path, [(1, 3, "a", "again", "U")], batch_id="b2") == 2
    assert live(spark, path) == [(1, 2, "a", "y")]


def test_awkward_columns(spark, tmp_path):
    """Dots and names of the library's own files in columns; composite null keys."""
    path = f"{tmp_path}/t"
    schema = "`a.b` STRING, `file` BIGINT, `rows` INT, `row` STRING, low INT"
    first = spark.createDataFrame([(None, 1, 1, "x", 0), ("k", None, 1, "y", 0), ("k", 1, 1, "z", 0)], schema)
    second = spark.createDataFrame([(None, 1, 2, "X", 0), ("k", None, 2, "Y", 0)], schema)
    for batch in (first, second):
        keyed.merge(spark, path, batch, ["a.b", "file"], ["rows"], F.lit("p"))
    assert rows_of(keyed.read(spark, path)) == [
        ("k", 1, 1, "z", 0, "p"), ("k", None, 2, "Y", 0, "p"), (None, 1, 2, "X", 0, "p"),
    ]
    with pytest.raises(StorageWriteError, match="_deleted"):
        keyed.merge(spark, path, first.withColumn("_deleted", F.lit(1)), ["a.b"], ["rows"], F.lit("p"))
    with pytest.raises(StorageWriteError, match="has the key"):
        keyed.merge(spark, path, first, ["a.b"], ["rows"], F.lit("p"))


def _hundred_files(spark, path):
    base = spark.range(100_000).select(
        (F.col("id") * 3).alias("id"), F.lit(1).alias("version"), F.lit("v").alias("v"),
        F.floor(F.col("id") / 1000).cast("string").alias("month"),
    )
    keyed.merge(spark, path, base, KEYS, VERSIONS, "month")
    return keyed.state_of(spark, path)


def _searched(spark, state, batch):
    with scratch_table(batch.repartitionByRange("id").sortWithinPartitions("id"), "batch") as stored:
        return keyed.files_to_search(spark, state, stored).count()


def test_few_files_are_opened_for_few_keys(spark, tmp_path):
    path = f"{tmp_path}/t"
    state = _hundred_files(spark, path)
    assert keyed.live_files(spark, state).count() >= 100
    ids = lambda *ranges: spark.createDataFrame([(3 * i,) for a, b in ranges for i in range(a, b)], "id BIGINT")
    # One percent of the keys, together and at both ends, and single ones.
    assert _searched(spark, state, ids((40_000, 41_000))) <= 3
    assert _searched(spark, state, ids((0, 500), (99_500, 100_000))) <= 4
    assert _searched(spark, state, ids((0, 4000), (96_000, 100_000))) <= 10
    assert _searched(spark, state, ids((7, 8), (55_555, 55_556))) == 2
    # Keys within the ranges that no file holds: the bitmaps leave a few of 100 files.
    absent = spark.range(20).select((F.col("id") * 15_000 + 1).alias("id"))
    assert _searched(spark, state, absent) <= 5


def test_one_percent_opens_few_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    _hundred_files(spark, path)
    before = keyed.live_files(spark, keyed.state_of(spark, path)).count()
    batch = spark.range(1000).select(
        ((F.col("id") + 40_500) * 3).alias("id"), F.lit(2).alias("version"), F.lit("w").alias("v"), F.lit("40").alias("month"),
    )
    keyed.merge(spark, path, batch, KEYS, VERSIONS, "month")
    state = keyed.state_of(spark, path)
    held = keyed.replaced_rows(spark, state).select("_dead_file").distinct().count()
    assert held < before / 10
    rows = keyed.read(spark, path)
    assert rows.count() == 100_000 and rows.where("v = 'w'").count() == 1000
    assert keyed.read(spark, path, parts=["40"]).count() == 1500


def test_statistics_sort_no_rows(spark, tmp_path):
    """Bitmaps and bounds of keys of fixed width are kept in hash tables."""
    path = f"{tmp_path}/t"
    apply(spark, path, [(i, 1, "a", "x", "I") for i in range(9)])
    stored = spark.read.parquet(f"{path}/data")
    words = keyed._words(stored.select(keyed._hashed(KEYS).alias("h")))
    bounds = stored.select(*keyed._numbered(KEYS)).agg(*keyed._bounds(KEYS))
    for df in (words, bounds):
        plan = plan_of(df)
        assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_bounds_and_bits_hold_every_key(spark, tmp_path):
    """Composite keys with nulls: no key lies beyond its file's bounds, and bits are the keys'."""
    path = f"{tmp_path}/t"
    rows = [(None if i % 7 == 0 else i % 5, None if i % 3 == 0 else i, 1) for i in range(100)]
    batch = spark.createDataFrame(rows, "a INT, b BIGINT, version INT")
    keyed.merge(spark, path, batch, ["a", "b"], VERSIONS, F.lit("p"))
    files = keyed._listed(spark, keyed.state_of(spark, path))
    live = keyed.read(spark, path).select(F.struct("a", "b").alias("k"), keyed._hashed(["a", "b"]).alias("h"))
    met = live.join(files, (F.col("low") <= F.col("k")) & (F.col("k") <= F.col("high")))
    assert met.select("k").distinct().count() == live.count() == len({r[:2] for r in rows})
    listed = files.select(F.explode("words").alias("w")).select("w.*").groupBy("word").agg(F.bit_or("bits").alias("n"))
    held = {(r.word, i) for r in listed.collect() for i in range(64) if r.n >> i & 1}
    assert {64 * w + i for w, i in held} == {r.h for r in live.collect()}


def test_two_writers(spark, tmp_path):
    path = f"{tmp_path}/t"
    apply(spark, path, [(0, 0, "a", "x", "I")])
    batches = [[(i, n, "a", f"w{n}", "U") for i in range(6)] for n in range(1, 5)]
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda b: apply(spark, path, b), batches))
    assert max(numbers) == keyed.commit_log(spark, path).head()
    assert live(spark, path) == [(i, 4, "a", "w4") for i in range(6)]


def test_merge_meets_a_compaction(spark, tmp_path, monkeypatch):
    """A compaction that commits while a merge works makes the merge look again."""
    path = f"{tmp_path}/t"
    apply(spark, path, [(i, 1, "a", "x", "I") for i in range(5)])
    apply(spark, path, [(i, 2, "a", "y", "U") for i in range(3)])
    write, calls = keyed._write, []

    def interrupted(*args, **kw):
        calls.append(1)
        if len(calls) == 1:
            keyed.compact(spark, path, replaced_share=0.0)
        return write(*args, **kw)

    monkeypatch.setattr(keyed, "_write", interrupted)
    apply(spark, path, [(4, 3, "a", "z", "U")])
    assert live(spark, path) == [(i, 2, "a", "y") for i in range(3)] + [(3, 1, "a", "x"), (4, 3, "a", "z")]


def test_unknown_version(spark, tmp_path):
    path = f"{tmp_path}/t"
    apply(spark, path, [(1, 1, "a", "x", "I")])
    with pytest.raises(StorageWriteError, match="not 2"):
        silver.read_silver(spark, path, version=2)
    assert live(spark, path, version=0) == []
