"""CSV, JSON and Parquet scans with a registered schema.

``corrupt`` is FAILFAST, DROPMALFORMED or PERMISSIVE. Dropping parses permissively and
filters on ``_corrupt_record``, because Spark's own drop mode lets ``count()`` skip the
parse and count the malformed lines.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkingest.config import CORRUPT_MODES, CsvOptions, JsonOptions, ParquetOptions
from sparkingest.errors import ConfigurationError, ConnectorError
from sparkingest.sources.schema import flatten_structs, project_registered, schema_drift

log = logging.getLogger(__name__)

CORRUPT = "_corrupt_record"


def csv_reader_options(options: CsvOptions) -> dict[str, str]:
    return {
        "delimiter": options.delimiter,
        "quote": options.quote,
        "escape": options.escape,
        "header": str(options.header).lower(),
        "encoding": options.encoding,
        "nullValue": options.null_value,
    }


def _read_text_format(spark, fmt, path, registered, options, corrupt) -> DataFrame:
    if corrupt not in CORRUPT_MODES:
        raise ConfigurationError("corrupt", f"{corrupt!r} is not one of {CORRUPT_MODES}")
    reader = spark.read.format(fmt).options(**options)
    if corrupt == "FAILFAST":
        return _every_field_read(reader.option("mode", "FAILFAST").schema(registered).load(path))
    with_corrupt = T.StructType(
        [f for f in registered.fields if f.name != CORRUPT]
        + [T.StructField(CORRUPT, T.StringType())]
    )
    parsed = (
        reader.option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(with_corrupt)
        .load(path)
    )
    parsed = _every_field_read(parsed)
    if corrupt == "PERMISSIVE":
        return parsed
    columns = [F.col(f"`{f.name}`") for f in registered.fields]
    return parsed.where(F.col(CORRUPT).isNull()).select(*columns)


def _every_field_read(df: DataFrame) -> DataFrame:
    """The same rows behind a filter that reads every column and is always true.

    Column pruning would otherwise leave malformed fields unparsed, and what fails, is
    dropped or is marked corrupt would depend on what a query selects.
    """
    columns = [F.col(f"`{name}`") for name in df.columns]
    return df.where(F.xxhash64(*columns).bitwiseAND(F.lit(0).cast("bigint")) == 0)


def discover_schema(spark: SparkSession, fmt: str, path: str, options: dict) -> T.StructType:
    """Infer a schema only to compare it; reads the files once on the executors."""
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.load(path).schema


def _log_drift(source: str, registered: T.StructType, observed: T.StructType) -> None:
    drift = schema_drift(registered, observed)
    if drift:
        log.warning("[%s] schema drift, registered schema applied: %s", source, drift)


def read_csv(
    spark: SparkSession,
    path: str,
    registered: T.StructType,
    options: CsvOptions = CsvOptions(),
    *,
    corrupt: str = "FAILFAST",
    discover: bool = False,
    source: str = "csv",
) -> DataFrame:
    """Scan CSV with ``registered`` applied; ``discover`` also logs how the files differ."""
    reader_options = csv_reader_options(options)
    if discover:
        _log_drift(source, registered, discover_schema(spark, "csv", path, reader_options))
    return _read_text_format(spark, "csv", path, registered, reader_options, corrupt)


def read_json(
    spark: SparkSession,
    path: str,
    registered: T.StructType,
    options: JsonOptions = JsonOptions(),
    *,
    corrupt: str = "FAILFAST",
    discover: bool = False,
    source: str = "json",
) -> DataFrame:
    """Scan JSON lines, or one JSON array per file with ``multiline``.

    A multi-line file cannot be split: one task reads each file whole, so large feeds
    belong in JSON lines.
    """
    reader_options = {"multiLine": str(options.multiline).lower()}
    if discover:
        _log_drift(source, registered, discover_schema(spark, "json", path, reader_options))
    parsed = _read_text_format(spark, "json", path, registered, reader_options, corrupt)
    return flatten_structs(parsed, options.flatten_depth)


def date_range(df: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    """Inclusive days. The bounds are cast, not the column, so that Catalyst prunes
    partitions; the last day of a timestamp column lasts until the next midnight."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(column) < F.date_add(F.lit(end).cast("date"), 1))
    return df


def read_parquet(
    spark: SparkSession,
    path: str,
    registered: T.StructType | None = None,
    options: ParquetOptions = ParquetOptions(),
    *,
    strict: bool = False,
    fill_missing: bool = False,
    source: str = "parquet",
) -> DataFrame:
    """Scan Parquet with its own schema; footers of different files are not merged, so a
    drifting file shows. A registered schema prunes the columns and logs the drift."""
    reader = spark.read.option("mergeSchema", "false")
    df = reader.parquet(path)
    if strict and registered is not None:
        # Partition columns are directories; only those that are registered count.
        inside = reader.option("recursiveFileLookup", "true").parquet(path).columns
        known = {name.lower() for name in [*inside, *registered.names, options.date_column]}
        df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() in known])
    df = date_range(df, options.date_column, options.start_date, options.end_date)
    if registered is None:
        return df
    if strict:
        partition = options.date_column
        if partition not in inside and partition not in registered.names and partition in df.columns:
            df = df.drop(partition)
    else:
        _log_drift(source, registered, df.schema)
    return project_registered(df, registered, fill_missing=fill_missing, strict=strict)


def extract_file(spark: SparkSession, spec) -> DataFrame:
    """The file scan a ``SourceSpec`` describes."""
    connection, enforcement = spec.connection, spec.schema_enforcement
    source = spec.metadata.source_id
    common = {
        "corrupt": enforcement.corrupt_mode,
        "discover": enforcement.schema_mode == "discovered-and-log",
        "source": source,
    }
    try:
        if connection.file_format == "csv":
            return read_csv(
                spark, connection.file_path, enforcement.registered, connection.csv, **common
            )
        if connection.file_format == "json":
            return read_json(
                spark, connection.file_path, enforcement.registered, connection.json, **common
            )
        return read_parquet(
            spark,
            connection.file_path,
            enforcement.registered,
            connection.parquet,
            strict=enforcement.mode == "strict",
            source=source,
        )
    except ConnectorError:
        raise
    except Exception as error:
        raise ConnectorError(source, f"read failed: {error}") from error
