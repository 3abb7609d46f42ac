"""Shapes of the plans of all registered queries."""

from __future__ import annotations

import re

import pytest
from tests.conftest import plan_of

import __spark_entry__ as entry_module
from sparkingest.errors import ConfigurationError
from sparkingest.session import shared_dir

QUERIES = entry_module.queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_python_no_full_sort(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"\b(BatchEvalPython|ArrowEvalPython|MapInPandas|PythonUDF)", plan)
    assert "rangepartitioning" not in plan


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")


def test_clusters_need_a_shared_folder(spark):
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ConfigurationError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_runs_of_many_files_are_dealt_without_sorting_rows(spark, sf_dir, monkeypatch):
    """Rows dealt in turn are sorted before; by key they are not."""
    from sparkingest.plans import queries_raw

    read = []
    monkeypatch.setattr(queries_raw, "prepared", lambda spark, sf_dir, name, build: build("unused"))
    monkeypatch.setattr(queries_raw, "ingest", lambda spark, spec, **_: read.append(spec))
    queries_raw._lines_stored(spark, sf_dir)
    frames = [spec.connection.reader(spark) for spec in read]
    assert [f.rdd.getNumPartitions() for f in frames] == [16] * 3
    assert not any("RoundRobin" in plan_of(f) for f in frames)
    assert sum(f.count() for f in frames) == queries_raw.lines(spark, sf_dir).count()
