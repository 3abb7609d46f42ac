from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkingest.functions.fingerprint import (
    batch_checksum,
    checksum_by,
    digest_of,
    lane_sums,
    with_leaf_words,
)

SCHEMA = "id BIGINT, name STRING, amount DOUBLE"
ROWS = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(-(2**62), 2**62)),
        st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=8)),
        st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False)),
    ),
    min_size=1,
    max_size=12,
)
QUICK = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def seal(df):
    return tuple(batch_checksum(df).first())


def seals(spark, variants, parts=2):
    """Digest per variant, all in one job."""
    rows = [(i, *row) for i, variant in enumerate(variants) for row in variant]
    df = spark.createDataFrame(rows, "variant INT, " + SCHEMA).repartition(parts)
    return {r.variant: (r.row_count, r.checksum) for r in checksum_by(df, ["variant"]).collect()}


@QUICK
@given(rows=ROWS, data=st.data())
def test_order_and_partitions_do_not_matter(spark, rows, data):
    shuffled = data.draw(st.permutations(rows))
    found = seals(spark, [rows, shuffled], data.draw(st.integers(1, 5)))
    assert found[0] == found[1]


@QUICK
@given(rows=ROWS, data=st.data())
def test_every_change_shows(spark, rows, data):
    i = data.draw(st.integers(0, len(rows) - 1))
    edited = [*rows[:i], (rows[i][0], (rows[i][1] or "") + "x", rows[i][2]), *rows[i + 1 :]]
    variants = [rows, rows + [rows[i]], edited, rows[:i] + rows[i + 1 :] + [(None, "?", None)]]
    assert len(set(seals(spark, variants).values())) == len(variants)


def test_column_borders_are_part_of_the_text(spark):
    columns = "a STRING, b STRING"
    pairs = [("ab", "c"), ("a", "bc"), (None, "abc"), ("N", "abc"), ("", "abc"), ("1:a", "|1:b")]
    seals = {seal(spark.createDataFrame([p], columns)) for p in pairs}
    assert len(seals) == len(pairs)


def test_copies_do_not_cancel(spark):
    one = seal(spark.createDataFrame([(1,)] * 3 + [(2,)], "id INT"))
    other = seal(spark.createDataFrame([(1,)] + [(2,)] * 3, "id INT"))
    assert one != other


def test_column_order_does_not_matter(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id INT, name STRING")
    assert seal(df) == seal(df.select("name", "id"))


def test_form_and_empty_batch(spark):
    count, checksum = seal(spark.createDataFrame([], SCHEMA))
    assert count == 0
    assert re.fullmatch(r"[0-9a-f]{64}", checksum)


def test_all_types_and_groups(spark):
    rows = [
        (1, Decimal("1.50"), dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), b"a", [1], {"k": 1, "j": 2}, (1,)),
        (1, Decimal("2.50"), None, None, None, None, None, None),
    ]
    schema = (
        "g INT, d DECIMAL(12,4), t DATE, ts TIMESTAMP, b BINARY, a ARRAY<INT>, "
        "m MAP<STRING,INT>, s STRUCT<x: INT>"
    )
    df = spark.createDataFrame(rows, schema)
    reordered = [(*rows[0][:6], {"j": 2, "k": 1}, (1,)), rows[1]]
    assert seal(df) == seal(spark.createDataFrame(reordered, schema))
    grouped = checksum_by(df, ["g"]).collect()
    assert [(r.g, r.row_count) for r in grouped] == [(1, 2)]


def test_sums_of_parts_add_up(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    parts = [orders.where(f"o_orderkey % 3 = {i}") for i in range(3)]
    sums = [with_leaf_words(p).agg(*lane_sums()).first().asDict() for p in parts]
    merged = {name: sum(s[name] for s in sums) for name in sums[0]}
    assert digest_of(merged) == batch_checksum(orders).first()["checksum"]


def test_no_row_is_shuffled(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = batch_checksum(lineitem)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1
    assert "hashpartitioning" not in plan
    assert "partial_sum" in plan
