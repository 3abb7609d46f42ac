"""Registry of the queries and of the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkingest.functions.fingerprint import LANES
from sparkingest.session import work_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_PREPARED: dict[tuple, object] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepared(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], object]):
    """Input files derived from the given tables, built once per application.

    ``build`` gets a fresh path in the shared folder; what it returns is kept, or the
    path if it returns nothing.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _PREPARED:
        path = work_path(spark, name)
        made = build(path)
        _PREPARED[key] = path if made is None else made
    return _PREPARED[key]


def ddl(text: str) -> StructType:
    return StructType.fromDDL(text)


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def sql_cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def sql_day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def sql_row_text(columns: Mapping[str, str]) -> str:
    """Canonical row text in SQL; ``columns`` maps a name to ``text`` or ``plain``."""
    parts = [
        f"coalesce(CAST(length({name}) AS VARCHAR) || ':' || {name}, 'N')"
        if kind == "text"
        else f"coalesce(CAST({name} AS VARCHAR), 'N')"
        for name, kind in sorted(columns.items())
    ]
    return " || '|' || ".join(parts)


def sql_checksum(relation: str, columns: Mapping[str, str], keys: tuple[str, ...] = ()) -> str:
    """``SELECT keys…, row_count, checksum`` over ``relation``."""
    lanes = ", ".join(
        f"coalesce(sum(CAST('0x' || substr(leaf, {1 + 4 * i}, 4) AS BIGINT)), 0) AS lane_{i}"
        for i in range(len(LANES))
    )
    listed = ", ".join(f"CAST(lane_{i} AS VARCHAR)" for i in range(len(LANES)))
    lead = "".join(f"{key}, " for key in keys)
    grouped = f"GROUP BY {', '.join(keys)}" if keys else ""
    return f"""
      SELECT {lead}n AS row_count,
             sha256(concat_ws('|', CAST(n AS VARCHAR), {listed})) AS checksum
      FROM (SELECT {lead}count(*) AS n, {lanes}
            FROM (SELECT {lead}sha256({sql_row_text(columns)}) AS leaf FROM {relation})
            {grouped})"""
