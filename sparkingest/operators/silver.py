"""Refined layer: conform, deduplicate, merge on key, change-data apply.

A Silver table is a table of ``keyed``: merges and change batches are commits, readers see all
of a commit or nothing, and any commit can be read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkingest.operators import keyed
from sparkingest.operators.keyed import latest_per_key
from sparkingest.operators.quality import CODES, SCHEMA_TYPE_MISMATCH


def conform(df: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``{standard name: (source column, type)}`` with safe casts; a value that does not
    cast becomes null and puts SCHEMA_TYPE_MISMATCH into ``error_codes``."""
    casts, bad = [], F.lit(False)
    for name, (source, data_type) in columns.items():
        value = F.col(source).try_cast(data_type)
        casts.append(value.alias(name))
        bad = bad | (F.col(source).isNotNull() & value.isNull())
    codes = F.when(bad, F.array(F.lit(SCHEMA_TYPE_MISMATCH))).otherwise(
        F.array().cast("array<string>")
    )
    return df.select(*casts, codes.alias(CODES))


def merge(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    versions: Sequence[str],
    part: Column | str,
) -> int:
    """Upsert a batch; see ``keyed.merge``."""
    return keyed.merge(spark, path, incoming, keys, versions, part)


def merge_changes(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: Sequence[str],
    versions: Sequence[str],
    operation: str,
    part: Column | str,
    *,
    delete: str = "D",
    batch_id: str | None = None,
) -> int:
    """Apply a change log to a stored table: of each key the greatest version decides, whether
    it comes in this batch, an earlier or a later one, and a delete is remembered.

    A change without an operation is an upsert. The operation itself is not stored.
    """
    deleted = F.col(f"`{operation}`").eqNullSafe(F.lit(delete))
    return keyed.merge(
        spark, path, changes, keys, versions, part, deleted=deleted, transient=[operation], batch_id=batch_id
    )


def read_silver(
    spark: SparkSession,
    path: str,
    data: T.StructType | None = None,
    *,
    version: int | None = None,
    parts: Sequence[str] | None = None,
) -> DataFrame:
    """Live rows and their ``part``, as of the newest commit or of an earlier one."""
    return keyed.read(spark, path, data, number=version, parts=parts)


def live_partitions(spark: SparkSession, path: str) -> DataFrame:
    """``part, row_count`` of every label that holds rows."""
    return keyed.live_counts(spark, path)


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of a table, as its newest commit recorded them."""
    return keyed.state_of(spark, path).schema


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    versions: Sequence[str],
    operation: str,
    delete: str = "D",
) -> DataFrame:
    """Table after a change log: newest change per key, deletes as tombstones.

    Where ``base`` has the version columns, a change takes effect only if it is newer than
    the row it meets. A plain table keeps no tombstones: for change logs in several batches
    that may overtake each other use ``merge_changes``.
    """
    newest = latest_per_key(changes, keys, versions)
    slim = newest.select(
        *[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)],
        F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias("_row"),
        F.struct(*[F.col(f"`{c}`") for c in versions]).alias("_version"),
        (F.col(f"`{operation}`") == delete).alias("_gone"),
    )
    rows = base.select(F.struct("*").alias("_base"))
    same = None
    for i, k in enumerate(keys):
        equal = F.col(f"_base.`{k}`").eqNullSafe(F.col(f"_key{i}"))
        same = equal if same is None else same & equal
    met = rows.join(slim, same, "full_outer")
    changed = F.col("_row").isNotNull()
    if set(versions) <= set(base.columns):
        stored = F.struct(*[F.col(f"_base.`{c}`") for c in versions])
        changed = changed & (F.col("_base").isNull() | (F.col("_version") > stored))
    kept = met.where(~(changed & F.coalesce("_gone", F.lit(False))))
    row = F.when(changed, F.col("_row")).otherwise(F.col("_base"))
    return kept.select(row.alias("_row")).select("_row.*")
