"""Extraction watermarks: how far each source has been read.

The checkpoint is an append-only log; its newest row per source is the state, so an
advance never rewrites anything and a lost executor cannot leave half an update.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkingest.errors import ConnectorError
from sparkingest.session import one_row, path_exists, timestamp_literal

# Type tags of the checkpoint table.
TIMESTAMP = "TIMESTAMP"
INTEGER = "INTEGER"

CHECKPOINT_SCHEMA = (
    "source_id STRING, watermark_type STRING, watermark_ts TIMESTAMP, "
    "watermark_int BIGINT, updated_at TIMESTAMP, run_id STRING"
)


@dataclass(frozen=True)
class Watermark:
    kind: str
    ts: dt.datetime | None = None
    integer: int | None = None

    @property
    def value(self):
        return self.ts if self.kind == TIMESTAMP else self.integer


def newer_than(
    column: str,
    data_type: T.DataType,
    mark: Watermark,
    *,
    lag_seconds: int = 0,
    lag_units: int = 0,
) -> Column:
    """``column > mark``, strictly. A lag reaches back behind the mark for rows that
    committed late or under a skewed clock; the overlap is removed on the merge key.

    The mark is cast, never the column, so the filter reaches Parquet and JDBC scans.
    """
    if mark.kind == TIMESTAMP:
        bound = timestamp_literal(mark.ts - dt.timedelta(seconds=lag_seconds))
    else:
        bound = F.lit(mark.integer - lag_units)
    return F.col(column) > bound.cast(data_type)


def incremental_scan(
    source: DataFrame,
    column: str,
    mark: Watermark | None,
    *,
    lag_seconds: int = 0,
    lag_units: int = 0,
) -> DataFrame:
    """The whole source without a mark, the rows beyond it otherwise."""
    if mark is None:
        return source
    data_type = source.schema[column].dataType
    predicate = newer_than(
        column, data_type, mark, lag_seconds=lag_seconds, lag_units=lag_units
    )
    return source.where(predicate)


def watermark_kind(data_type: T.DataType, source: str = "watermark") -> str:
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(data_type, integral):
        return INTEGER
    if isinstance(data_type, T.DecimalType) and data_type.scale == 0 and data_type.precision <= 18:
        return INTEGER
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return TIMESTAMP
    raise ConnectorError(source, f"unsupported watermark column type: {data_type.simpleString()}")


# Text form of a timestamp in Spark and in Python.
TEXT_FORM = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def parse_timestamp(text: str) -> dt.datetime:
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S.%f")


def watermark_value(df: DataFrame, column: str, source: str = "watermark") -> Column:
    """``max(column)`` in the checkpoint's type, ready for ``agg`` or ``observe``."""
    kind = watermark_kind(df.schema[column].dataType, source)
    return F.max(F.col(column).cast("bigint" if kind == INTEGER else "timestamp"))


def next_watermark(
    df: DataFrame, column: str, source_id: str, updated_at: Column, run_id: str
) -> DataFrame:
    """The checkpoint row of a batch; no row when the batch is empty or all null."""
    kind = watermark_kind(df.schema[column].dataType, source_id)
    top = df.agg(watermark_value(df, column, source_id).alias("top")).where("top IS NOT NULL")
    nothing = F.lit(None)
    return top.select(
        F.lit(source_id).alias("source_id"),
        F.lit(kind).alias("watermark_type"),
        (F.col("top") if kind == TIMESTAMP else nothing.cast("timestamp")).alias("watermark_ts"),
        (F.col("top") if kind == INTEGER else nothing.cast("bigint")).alias("watermark_int"),
        updated_at.cast("timestamp").alias("updated_at"),
        F.lit(run_id).alias("run_id"),
    )


def append_watermark(
    spark: SparkSession,
    path: str,
    source_id: str,
    mark: Watermark,
    updated_at: dt.datetime,
    run_id: str,
) -> None:
    row = (source_id, mark.kind, mark.ts, mark.integer, updated_at, run_id)
    one_row(spark, CHECKPOINT_SCHEMA, row).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], CHECKPOINT_SCHEMA)
    return spark.read.schema(CHECKPOINT_SCHEMA).parquet(path)


def latest_watermarks(log: DataFrame) -> DataFrame:
    """Newest row per source; equal times go by run id. The aggregate reduces each
    source before the shuffle, so a source with most of the log is no hot spot."""
    state = ["watermark_type", "watermark_ts", "watermark_int", "updated_at", "run_id"]
    newest = F.max_by(F.struct(*state), F.struct("updated_at", "run_id")).alias("s")
    return log.groupBy("source_id").agg(newest).select("source_id", *[f"s.{c}" for c in state])


def decode_watermarks(log: DataFrame) -> DataFrame:
    """Add ``value`` as text and ``error``; an unreadable row keeps its reason."""
    tag, ts, integer = F.col("watermark_type"), F.col("watermark_ts"), F.col("watermark_int")
    error = (
        F.when(
            (tag == TIMESTAMP) & ts.isNull(),
            F.lit("a time mark without its time"),
        )
        .when(
            (tag == INTEGER) & integer.isNull(),
            F.lit("a number mark without its number"),
        )
        .when(
            tag.isNull() | ~tag.isin(TIMESTAMP, INTEGER),
            F.concat(F.lit("no such kind of mark: "), F.coalesce(tag, F.lit("null"))),
        )
    )
    value = F.when(tag == TIMESTAMP, F.date_format(ts, TEXT_FORM)).when(
        tag == INTEGER, integer.cast("string")
    )
    return log.withColumns({"value": value, "error": error})


def read_watermark(spark: SparkSession, path: str, source_id: str) -> Watermark | None:
    """One source's state: at most one row reaches the driver."""
    mine = read_log(spark, path).where(F.col("source_id") == source_id)
    rows = decode_watermarks(latest_watermarks(mine)).collect()
    if not rows:
        return None
    row = rows[0]
    if row["error"]:
        raise ConnectorError(source_id, row["error"])
    if row["watermark_type"] == TIMESTAMP:
        return Watermark(TIMESTAMP, ts=parse_timestamp(row["value"]))
    return Watermark(INTEGER, integer=row["watermark_int"])
