"""JDBC scans through Spark's own source.

Filters on the returned DataFrame reach the database in its own dialect, so an
incremental predicate is a Column, never SQL text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from sparkingest.errors import ConfigurationError, ConnectorError

# Driver classes and URL forms the databases prescribe.
POSTGRES_DRIVER = "org.postgresql.Driver"
ORACLE_DRIVER = "oracle.jdbc.OracleDriver"
SSL_MODES = ("disable", "require", "verify-ca", "verify-full")


def jdbc_options(
    url: str,
    table: str,
    driver: str,
    *,
    batch_size: int = 10000,
    timeout: int = 3600,
    parallelism: int = 4,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a scan. It is split into ``parallelism`` ranges only if the partition
    column (number, date or timestamp) and both bounds are given. The bounds shape the
    ranges and filter nothing. ``extra`` carries user, password and the like unread."""
    options = {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "fetchsize": str(batch_size),
        "queryTimeout": str(timeout),
    }
    if partition_column is not None and lower_bound is not None and upper_bound is not None:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(parallelism),
        }
    return options | dict(extra or {})


def postgres_options(
    host: str, port: int, database: str, table: str, *, ssl_mode: str = "require", **scan
) -> dict[str, str]:
    _require("postgres", host=host, port=port, database=database)
    if ssl_mode not in SSL_MODES:
        raise ConfigurationError("ssl_mode", f"{ssl_mode!r} is not one of {', '.join(SSL_MODES)}")
    scan["extra"] = {"sslmode": ssl_mode} | dict(scan.get("extra") or {})
    url = f"jdbc:postgresql://{host}:{port}/{database}"
    return jdbc_options(url, table, POSTGRES_DRIVER, **scan)


def oracle_options(
    host: str, port: int, service: str, table: str, *, wallet_path: str | None = None, **scan
) -> dict[str, str]:
    _require("oracle", host=host, port=port, service=service)
    if wallet_path is not None:
        location = f"(SOURCE=(METHOD=FILE)(METHOD_DATA=(DIRECTORY={wallet_path})))"
        scan["extra"] = {"oracle.net.wallet_location": location} | dict(scan.get("extra") or {})
    url = f"jdbc:oracle:thin:@//{host}:{port}/{service}"
    return jdbc_options(url, table, ORACLE_DRIVER, **scan)


def _require(kind: str, **values) -> None:
    absent = [name for name, value in values.items() if value in (None, "")]
    if absent:
        raise ConfigurationError(kind, f"needs {', '.join(absent)}")


def read_jdbc(spark: SparkSession, options: Mapping[str, str], source: str = "jdbc") -> DataFrame:
    try:
        return spark.read.format("jdbc").options(**options).load()
    except Exception as error:
        raise ConnectorError(source, f"read failed: {error}") from error
