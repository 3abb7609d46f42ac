from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.conftest import plan_of, rows_of

from sparkingest.operators import keyed, silver

SCHEMA = "id BIGINT, version INT, month STRING, v STRING"
PART = "month"


def brute_force(*batches):
    """Newest version per id; on a tie the earlier batch stays."""
    best = {}
    for batch in batches:
        for row in batch:
            if row[0] not in best or row[1] > best[row[0]][1]:
                best[row[0]] = row
    return sorted(best.values(), key=repr)


def merged(spark, path, df_schema):
    return silver.read_silver(spark, path, df_schema)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_merges_match_brute_force(spark, tmp_path, conf, limit):
    """Random upserts with moving partitions and null keys; versions are unique per id
    within a batch."""
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    rng = random.Random(7)
    path, batches = f"{tmp_path}/silver", []
    for n in range(4):
        picked = rng.choices([None, *range(30)], k=25)
        batch = [
            (i, 10 * rng.randrange(5) + j, f"2024-0{rng.randint(1, 4)}", f"b{n}")
            for j, i in enumerate(picked)
        ]
        batch = list({(r[0], r[1]): r for r in batch}.values())
        batches.append(batch)
        silver.merge(spark, path, frame(spark, batch), ["id"], ["version"], PART)
        live = merged(spark, path, frame(spark, batch).schema)
        assert rows_of(live.drop("part")) == brute_force(*batches)
        assert live.where("part <> month").isEmpty()


def test_emptied_partition_disappears(spark, tmp_path):
    path = f"{tmp_path}/silver"
    schema = frame(spark, []).schema
    silver.merge(spark, path, frame(spark, [(1, 1, "a", "x"), (2, 1, "b", "x")]), ["id"], ["version"], PART)
    silver.merge(spark, path, frame(spark, [(1, 2, "b", "y")]), ["id"], ["version"], PART)
    assert rows_of(merged(spark, path, schema).select("id", "part")) == [(1, "b"), (2, "b")]
    assert rows_of(silver.live_partitions(spark, path)) == [("b", 2)]


def test_nothing_stored_is_rewritten(spark, tmp_path):
    path = f"{tmp_path}/silver"
    first = [(i, 1, f"m{i % 5}", "x") for i in range(50)]
    silver.merge(spark, path, frame(spark, first), ["id"], ["version"], PART)
    version = silver.merge(spark, path, frame(spark, [(3, 2, "m3", "y")]), ["id"], ["version"], PART)
    folder = keyed.commit_log(spark, path).read(version)["data"][0]
    assert rows_of(spark.read.parquet(f"{path}/data/{folder}").select("part", "v")) == [("m3", "y")]


def test_same_batch_twice_changes_nothing(spark, tmp_path):
    path, rows = f"{tmp_path}/silver", [(1, 1, "a", "x"), (2, 1, "b", "x")]
    for _ in range(2):
        silver.merge(spark, path, frame(spark, rows), ["id"], ["version"], PART)
    assert rows_of(merged(spark, path, frame(spark, []).schema).drop("part")) == rows


def test_crashed_merge_is_invisible(spark, tmp_path):
    """Files that no record lists."""
    path = f"{tmp_path}/silver"
    silver.merge(spark, path, frame(spark, [(1, 1, "a", "x")]), ["id"], ["version"], PART)
    frame(spark, [(9, 9, "a", "z")]).withColumn("part", F.col(PART)).write.parquet(f"{path}/data/crashed")
    live = merged(spark, path, frame(spark, []).schema)
    assert rows_of(live.select("id")) == [(1,)]
    silver.merge(spark, path, frame(spark, [(2, 1, "a", "x")]), ["id"], ["version"], PART)
    assert rows_of(merged(spark, path, frame(spark, []).schema).select("id")) == [(1,), (2,)]


def test_null_and_empty_labels_share_a_partition(spark, tmp_path):
    path = f"{tmp_path}/silver"
    rows = [(1, 1, None, "x"), (2, 1, "", "x")]
    silver.merge(spark, path, frame(spark, rows), ["id"], ["version"], PART)
    silver.merge(spark, path, frame(spark, [(1, 2, "a", "y")]), ["id"], ["version"], PART)
    live = merged(spark, path, frame(spark, []).schema)
    assert rows_of(live.select("id", "month", "part")) == [(1, "a", "a"), (2, "", "none")]


def test_latest_per_key_limits_before_the_shuffle(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = plan_of(silver.latest_per_key(lineitem, ["l_orderkey"], ["l_shipdate"]))
    final, rest = plan.split("Exchange hashpartitioning", 1)
    assert "row_number(), 1, Final" in final and "row_number(), 1, Partial" in rest


def test_only_keys_and_versions_of_stored_rows_move(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    path = f"{tmp_path}/silver"
    silver.merge(spark, path, frame(spark, [(i, 1, "a", "x") for i in range(9)]), ["id"], ["version"], PART)
    state = keyed.state_of(spark, path)
    slim = T.StructType([state.schema[n] for n in ("id", "version")])
    stored = keyed._live_rows(spark, path, state, slim, keyed.live_files(spark, state), located=True)
    plan = plan_of(keyed.winners(frame(spark, [(3, 2, "a", "y")]), stored, ["id"], ["version"]))
    assert "SortMergeJoin" in plan and "month" not in plan.split("ReadSchema: ")[-1]


def test_changes_on_a_hot_key(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id INT, v STRING")
    log = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.lit(2) + F.col("id") % 3).cast("int").alias("id"),
        F.concat(F.lit("v"), F.col("id")).alias("v"),
        F.col("id").alias("seq"),
        F.when(F.col("id") == 2998, F.lit("D")).otherwise(F.lit("U")).alias("op"),
    )
    out = silver.apply_changes(base, log, ["id"], ["seq"], "op")
    assert rows_of(out) == [(1, "v2997"), (2, "b"), (4, "v2999")]


def test_conform_flags_what_does_not_cast(spark):
    raw = spark.createDataFrame([("1", "2024-01-01"), ("x", None)], "k STRING, d STRING")
    rows = silver.conform(raw, {"id": ("k", "INT"), "day": ("d", "DATE")}).collect()
    assert [(r.id, str(r.day), r.error_codes) for r in rows] == [
        (1, "2024-01-01", []),
        (None, "None", ["SCHEMA_TYPE_MISMATCH"]),
    ]
