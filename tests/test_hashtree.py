from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.conftest import plan_of

from sparkingest.errors import ConfigurationError
from sparkingest.operators import hashtree

KEYS = ["k.1", "part"]
TABLE = "`k.1` INT, part STRING, v STRING, _range STRING, top STRING"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", None) for r in rows], TABLE)


def expected(source, target):
    a, b = Counter(source), Counter(target)
    out = {}
    for key in {r[:2] for r in [*source, *target]}:
        s = sum(n for r, n in a.items() if r[:2] == key)
        t = sum(n for r, n in b.items() if r[:2] == key)
        only_s = sum(n for r, n in (a - b).items() if r[:2] == key)
        only_t = sum(n for r, n in (b - a).items() if r[:2] == key)
        if only_s or only_t:
            kind = "MISSING_IN_TARGET" if not t else "MISSING_IN_SOURCE" if not s else None
            kind = kind or ("CONTENT_MISMATCH" if s == t else "COUNT_MISMATCH")
            out[key] = (s, t, only_s, only_t, kind)
    return out


def found(df):
    return {tuple(r)[:2]: tuple(r)[2:] for r in df.collect()}


ROW = st.tuples(
    st.one_of(st.none(), st.integers(-3, 3)), st.sampled_from([None, "", "a"]), st.sampled_from([None, "", "x", "y"])
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(source=st.lists(ROW, max_size=15), target=st.lists(ROW, max_size=15))
def test_rows_that_differ_against_multisets(spark, source, target):
    got = hashtree.reconcile_rows(
        table(spark, source), table(spark, target), KEYS, ["v"], levels=2, bits=2
    )
    assert found(got) == expected(source, target)


def test_only_differing_ranges_are_walked(spark):
    rows = [(i, "a", str(i)) for i in range(3000)]
    changed = [(i, "a", "new" if i == 17 else str(i)) for i in range(3000)]
    tree = hashtree.store_tree(hashtree.hash_tree(table(spark, rows), KEYS, ["v"]))
    other = hashtree.store_tree(hashtree.hash_tree(table(spark, changed), KEYS, ["v"]))
    root = tree.where("level = 0").collect()
    assert len(root) == 1 and root[0]["_rows"] == 3000
    per_level = tree.groupBy("level").agg(F.sum("_rows").alias("n")).collect()
    assert {r.level: r.n for r in per_level} == dict.fromkeys(range(5), 3000)
    assert hashtree.differing_ranges(tree, other).count() == 1
    assert hashtree.differing_ranges(tree, tree).count() == 0
    plan = plan_of(tree.where("level = 2 AND top = 3"))
    assert "PartitionFilters: [isnotnull(level" in plan and "DataFilters: []" in plan


def test_equal_tables_do_not_read_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    table(spark, [(1, "a", "x"), (1, "a", "x"), (None, None, None)]).write.parquet(path)
    stored = spark.read.parquet(path)
    tree = hashtree.store_tree(hashtree.hash_tree(stored, KEYS, ["v"]))
    same = hashtree.reconcile_rows(stored, stored, KEYS, ["v"], tree, tree)
    assert same.collect() == []
    assert "FileScan" not in plan_of(same)


def test_a_hot_key_and_empty_tables(spark):
    hot = [(1, "a", str(i)) for i in range(400)] + [(2, "b", "x")] * 3
    gone = hot[1:]
    got = hashtree.reconcile_rows(table(spark, hot), table(spark, gone), KEYS, ["v"])
    assert found(got) == {(1, "a"): (400, 399, 1, 0, "COUNT_MISMATCH")}
    empty = table(spark, [])
    assert hashtree.reconcile_rows(empty, empty, KEYS, ["v"]).collect() == []
    assert len(hashtree.reconcile_rows(empty, table(spark, hot), KEYS, ["v"]).collect()) == 2
    with pytest.raises(ConfigurationError):
        hashtree.hash_tree(empty, KEYS, ["v"], levels=0)
