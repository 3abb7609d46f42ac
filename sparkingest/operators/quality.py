"""Quality rules as Column expressions, classification, quarantine and recovery.

All rules of a source are evaluated in one pass into ``error_codes``; a row is clean
when the array is empty. Null passes every rule but completeness.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkingest.session import timestamp_literal

# Error codes.
SCHEMA_TYPE_MISMATCH = "SCHEMA_TYPE_MISMATCH"
NULL_IN_REQUIRED_COLUMN = "NULL_IN_REQUIRED_COLUMN"
RANGE_VIOLATION = "RANGE_VIOLATION"
PATTERN_MISMATCH = "PATTERN_MISMATCH"
ORPHAN_REFERENCE = "ORPHAN_REFERENCE"
STALE_RECORD = "STALE_RECORD"
CORRUPT_RECORD = "CORRUPT_RECORD"
LATE_RECORD = "LATE_RECORD"

CODES = "error_codes"
ORPHANS = "_orphan"


def _violated(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


@dataclass(frozen=True)
class Completeness:
    """Columns that must be filled; ``threshold`` is the least non-null rate of the batch."""

    columns: tuple[str, ...]
    threshold: float = 1.0
    code: str = NULL_IN_REQUIRED_COLUMN

    def violation(self) -> Column:
        nulls = [F.col(c).isNull() for c in self.columns]
        condition = nulls[0]
        for other in nulls[1:]:
            condition = condition | other
        return condition


@dataclass(frozen=True)
class Range:
    """``minimum <= column <= maximum``; either bound may be left out."""

    column: str
    minimum: float | int | None = None
    maximum: float | int | None = None
    code: str = RANGE_VIOLATION

    def violation(self) -> Column:
        outside = F.lit(False)
        if self.minimum is not None:
            outside = outside | (F.col(self.column) < F.lit(self.minimum))
        if self.maximum is not None:
            outside = outside | (F.col(self.column) > F.lit(self.maximum))
        return _violated(outside)


@dataclass(frozen=True)
class Pattern:
    """The whole text must match ``regex`` where the expression anchors it."""

    column: str
    regex: str
    code: str = PATTERN_MISMATCH

    def violation(self) -> Column:
        return _violated(~F.col(self.column).rlike(self.regex))


@dataclass(frozen=True)
class Timeliness:
    """Not older than ``max_staleness_hours`` at ``as_of``, which the caller fixes."""

    column: str
    max_staleness_hours: int
    as_of: dt.datetime
    code: str = STALE_RECORD

    def violation(self) -> Column:
        oldest = self.as_of - dt.timedelta(hours=self.max_staleness_hours)
        return _violated(F.col(self.column) < timestamp_literal(oldest))


@dataclass(frozen=True)
class TypeConformance:
    """Text that must read as ``data_type``."""

    column: str
    data_type: str
    code: str = SCHEMA_TYPE_MISMATCH

    def violation(self) -> Column:
        value = F.col(self.column)
        return value.isNotNull() & value.try_cast(self.data_type).isNull()


@dataclass(frozen=True)
class CorruptRecord:
    """The parser could not read the record."""

    column: str = "_corrupt_record"
    code: str = CORRUPT_RECORD

    def violation(self) -> Column:
        return F.col(self.column).isNotNull()


@dataclass(frozen=True)
class Referential:
    """Every non-null ``column`` must occur in ``reference.reference_column``."""

    column: str
    reference: DataFrame = field(repr=False, compare=False)
    reference_column: str = ""
    code: str = ORPHAN_REFERENCE


Rule = Completeness | Range | Pattern | Timeliness | TypeConformance | CorruptRecord | Referential


def _reference_keys(rule: Referential) -> DataFrame:
    key = F.col(rule.reference_column or rule.column).alias("_ref_key")
    return rule.reference.select(key).where("_ref_key IS NOT NULL").distinct()


def flag_orphans(df: DataFrame, rule: Referential, flag: str = ORPHANS) -> DataFrame:
    """Add a boolean ``flag``: a left join on the distinct reference keys, one pass.

    How the keys travel, and how a key with very many rows is split, is left to the planner
    and AQE, which see the sizes at run time.
    """
    matched = _reference_keys(rule).withColumn("_found", F.lit(True))
    value = F.col(rule.column)
    joined = df.join(matched, value == F.col("_ref_key"), "left")
    orphan = value.isNotNull() & F.col("_found").isNull()
    return joined.withColumn(flag, orphan).drop("_ref_key", "_found")


def has_batch_rule(rules: Iterable[Rule]) -> bool:
    """True when a rule is decided on the whole batch before rows are classified."""
    return any(isinstance(r, Completeness) and r.threshold < 1.0 for r in rules)


def settle_batch_rules(df: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """Rules for the rows of this batch: a completeness rule whose columns all reach its
    threshold lets their nulls pass, one that is missed flags every null.

    One aggregation over the columns of such rules; the driver gets one row.
    """
    mine = [r for r in rules if isinstance(r, Completeness) and r.threshold < 1.0]
    if not mine:
        return list(rules)
    columns = sorted({c for r in mine for c in r.columns})
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.col(c)).alias(f"filled_{i}") for i, c in enumerate(columns)],
    ).first()
    total = counts["total"]
    rate = {c: counts[f"filled_{i}"] / total if total else 1.0 for i, c in enumerate(columns)}
    met = [r for r in mine if all(rate[c] >= r.threshold for c in r.columns)]
    return [r for r in rules if not any(r is m for m in met)]


def classify(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``error_codes``: one entry per broken rule, in rule order, without repeats."""
    codes, flags = [], []
    for rule in rules:
        if isinstance(rule, Referential):
            flag = f"{ORPHANS}_{len(flags)}"
            df = flag_orphans(df, rule, flag)
            flags.append(flag)
            broken = F.col(flag)
        else:
            broken = rule.violation()
        codes.append(F.when(broken, F.lit(rule.code)))
    if not codes:
        return df.withColumn(CODES, F.array().cast("array<string>"))
    found = F.array_distinct(F.array_compact(F.array(*codes)))
    return df.withColumn(CODES, found).drop(*flags)


def is_clean() -> Column:
    return F.size(CODES) == 0


def completeness_metrics(df: DataFrame, rule: Completeness) -> DataFrame:
    """One row per column: rows, filled rows, rate (null for an empty batch), passed."""
    wide = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.col(c)).alias(f"_filled_{i}") for i, c in enumerate(rule.columns)],
    )
    per_column = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_filled_{i}").alias("filled"))
            for i, c in enumerate(rule.columns)
        ]
    )
    rate = F.try_divide(F.col("filled").cast("double"), F.col("total").cast("double"))
    long = wide.select("total", F.explode(per_column).alias("m")).select(
        "m.column_name", "total", "m.filled"
    )
    return long.withColumn("rate", rate).withColumn(
        "passed", F.coalesce(F.col("rate") >= F.lit(float(rule.threshold)), F.lit(True))
    )


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(clean, quarantined)``; together they hold every row once."""
    return flagged.where(is_clean()).drop(CODES), flagged.where(~is_clean())


def quarantine_rate(flagged: DataFrame, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """Rows, quarantined rows, their rate and whether it exceeds the alert threshold."""
    counts = flagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(~is_clean()).alias("quarantined")
    )
    rate = F.try_divide(F.col("quarantined").cast("double"), F.col("total").cast("double"))
    return counts.withColumn("rate", rate).withColumn(
        "alert", F.coalesce(F.col("rate") > F.lit(float(threshold)), F.lit(False))
    )


def revalidate(
    quarantined: DataFrame, rules: Sequence[Rule], released: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Run ``rules`` again over quarantined rows not released before.

    Returns the rows that pass now and those that still fail, with their new codes.
    ``released`` holds the ``row_id`` of earlier releases.
    """
    if released is not None:
        quarantined = quarantined.join(released.select("row_id").distinct(), "row_id", "left_anti")
    flagged = classify(quarantined.drop(CODES), rules)
    return flagged.where(is_clean()), flagged.where(~is_clean())
