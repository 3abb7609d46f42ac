"""Queries with SQL give what DuckDB gives on the same files."""

from __future__ import annotations

import os

import duckdb
import pytest

from sparkingest.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    df = QUERIES[name](spark, sf_dir)
    result = connection.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted(map(repr, result.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*names).collect()) == expected
