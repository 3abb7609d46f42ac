"""Every query with SQL gives what DuckDB gives on the same files, every other one rows."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from sparkingest.plans.catalog import ORACLES, QUERIES

# Spark type of a result column -> DuckDB type of the same column.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in os.listdir(sf_dir):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{name}'")
    return connection


def _cell(value):
    return "NULL" if value is None else repr(value)


def _table(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    types = {column[0]: str(column[1]) for column in result.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    expected = _table(result.fetchall(), list(types))
    assert _table(df.collect(), df.columns) == expected
    assert expected, "an empty result proves nothing"


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 1500
