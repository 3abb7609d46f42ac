"""Registered schemas against what a source holds: diff, projection, flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkingest.errors import ConnectorError

DRIFT_SCHEMA = "field STRING, kind STRING, registered STRING, observed STRING"


def schema_drift(registered: T.StructType, observed: T.StructType) -> list[tuple]:
    """``(field, kind, registered, observed)`` rows, names compared without case.

    Order: missing, then extra, then type mismatches, each in schema order.
    """
    seen = {f.name.lower(): f for f in observed.fields}
    known = {f.name.lower(): f for f in registered.fields}
    missing, extra, mismatched = [], [], []
    for key, want in known.items():
        have = seen.get(key)
        if have is None:
            missing.append((want.name, "missing", want.dataType.simpleString(), None))
        elif have.dataType != want.dataType:
            mismatched.append(
                (
                    want.name,
                    "type mismatch",
                    want.dataType.simpleString(),
                    have.dataType.simpleString(),
                )
            )
    for key, have in seen.items():
        if key not in known:
            extra.append((have.name, "extra", None, have.dataType.simpleString()))
    return missing + extra + mismatched


def drift_frame(spark: SparkSession, registered: T.StructType, observed: T.StructType) -> DataFrame:
    return spark.createDataFrame(schema_drift(registered, observed), DRIFT_SCHEMA)


def project_registered(
    df: DataFrame,
    registered: T.StructType,
    *,
    fill_missing: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Registered columns in registered order with the types the source has.

    Columns the source lacks are skipped, or added as typed nulls with
    ``fill_missing``. ``strict`` refuses any difference instead.
    """
    if strict:
        drift = schema_drift(registered, df.schema)
        if drift:
            raise ConnectorError("schema", f"differs from the registered schema: {drift}")
    present = {name.lower(): name for name in df.columns}
    columns = []
    for field in registered.fields:
        if field.name.lower() in present:
            columns.append(F.col(f"`{present[field.name.lower()]}`").alias(field.name))
        elif fill_missing:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*columns)


def flatten_structs(df: DataFrame, depth: int = 1) -> DataFrame:
    """Expand struct columns to ``parent_child``, ``depth`` levels deep."""
    for _ in range(depth):
        if not any(isinstance(f.dataType, T.StructType) for f in df.schema.fields):
            break
        columns, names = [], []
        for field in df.schema.fields:
            if isinstance(field.dataType, T.StructType):
                for child in field.dataType.fields:
                    names.append(f"{field.name}_{child.name}")
                    columns.append(F.col(f"`{field.name}`.`{child.name}`").alias(names[-1]))
            else:
                names.append(field.name)
                columns.append(F.col(f"`{field.name}`"))
        clashes = sorted({n for n in names if [m.lower() for m in names].count(n.lower()) > 1})
        if clashes:
            raise ConnectorError("flatten", f"columns would collide: {', '.join(clashes)}")
        df = df.select(*columns)
    return df
