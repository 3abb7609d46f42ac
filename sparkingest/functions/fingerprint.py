"""Order-independent batch checksum without moving rows.

Every row becomes one canonical text and one SHA-256 leaf. The leaf is cut into
sixteen 16-bit lanes and each lane is *summed* over the batch (an additive multiset
hash), so the aggregate needs no sort and no row shuffle: each task hands over
seventeen BIGINTs. A lane overflows only beyond 2^47 rows. The digest is SHA-256 over
the row count and the lane sums: 64 lower-case hex characters that change when a cell
changes or a row is dropped, added or repeated, whatever the row order.

Because lanes add, they can be observed inside the write job, grouped by any key
to localise a difference, and summed over runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LANES = [f"_lane_{i:02d}" for i in range(16)]
_WORDS = [f"_word_{i}" for i in range(4)]
ROWS = "_rows"


def canonical_value(field: T.StructField) -> Column:
    """Unambiguous text of one column; null is ``N``, free text carries its length."""
    value = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        text = F.concat(F.length(value).cast("string"), F.lit(":"), value)
    elif isinstance(kind, T.TimestampType):
        text = F.unix_micros(value).cast("string")
    elif isinstance(kind, T.BinaryType):
        text = F.hex(value)
    elif isinstance(kind, T.MapType):
        entries = F.to_json(F.array_sort(F.map_entries(value)))
        text = F.concat(F.length(entries).cast("string"), F.lit(":"), entries)
    elif isinstance(kind, (T.StructType, T.ArrayType, T.VariantType)):
        nested = F.to_json(F.struct(value.alias("v")))
        text = F.concat(F.length(nested).cast("string"), F.lit(":"), nested)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("N"))


def row_text(schema: T.StructType) -> Column:
    """Canonical text of a row; columns go by name, so their order does not matter."""
    fields = sorted(schema.fields, key=lambda f: f.name)
    return F.concat_ws("|", *[canonical_value(f) for f in fields])


def with_leaf_words(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Add the row's SHA-256 leaf as four BIGINT words, computed once per row."""
    wanted = set(columns) if columns is not None else set(df.columns)
    schema = T.StructType([f for f in df.schema.fields if f.name in wanted])
    hashed = df.withColumn("_leaf", F.sha2(row_text(schema), 256))
    words = {
        word: F.conv(F.substring("_leaf", 1 + 16 * i, 16), 16, -10).cast("bigint")
        for i, word in enumerate(_WORDS)
    }
    return hashed.withColumns(words).drop("_leaf")


def leaf_words() -> list[str]:
    return list(_WORDS)


def drop_leaf_words(df: DataFrame) -> DataFrame:
    return df.drop(*_WORDS)


def lane_sums(only: Column | None = None) -> list[Column]:
    """The seventeen sums of a batch, optionally over the rows where ``only`` holds."""
    sums = []
    for i, lane in enumerate(LANES):
        word, shift = _WORDS[i // 4], 48 - 16 * (i % 4)
        part = F.shiftrightunsigned(word, shift).bitwiseAND(F.lit(65535).cast("bigint"))
        kept = part if only is None else F.when(only, part).otherwise(F.lit(0).cast("bigint"))
        sums.append(F.coalesce(F.sum(kept), F.lit(0).cast("bigint")).alias(lane))
    counted = F.count(F.lit(1)) if only is None else F.count_if(only)
    return [counted.alias(ROWS), *sums]


def digest_column() -> Column:
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in [ROWS, *LANES]]), 256)


def digest_of(sums: Mapping[str, int]) -> str:
    """The same digest from one row of sums already at the driver."""
    text = "|".join(str(sums[c] or 0) for c in [ROWS, *LANES])
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def checksum_by(df: DataFrame, keys: Iterable[str], columns: Iterable[str] | None = None):
    """One ``(keys…, row_count, checksum)`` row per group; map-side sums absorb hot keys."""
    keys = list(keys)
    columns = [c for c in df.columns if c not in keys] if columns is None else columns
    sums = with_leaf_words(df, columns).groupBy(*keys).agg(*lane_sums())
    return sums.select(*keys, F.col(ROWS).alias("row_count"), digest_column().alias("checksum"))


def batch_checksum(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row ``(row_count, checksum)`` for the whole batch."""
    return checksum_by(df, [], df.columns if columns is None else columns)
