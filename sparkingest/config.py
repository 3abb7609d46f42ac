"""Source descriptions. Jobs take these dataclasses; conditional requirements are
checked when they are constructed."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sparkingest.errors import ConfigurationError

# The accepted words of each setting.
CONNECTION_TYPES = ("jdbc", "file", "stream")
FILE_FORMATS = ("csv", "json", "parquet")
INGESTION_MODES = ("full", "incremental")
ENFORCEMENT_MODES = ("strict", "permissive")
SCHEMA_MODES = ("strict", "discovered-and-log")
CORRUPT_MODES = ("FAILFAST", "DROPMALFORMED", "PERMISSIVE")

_PATH_SAFE = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def _one_of(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ConfigurationError(name, f"{value!r} is not one of {', '.join(allowed)}")


def check_path_safe(name: str, value: str) -> str:
    """Source names and run ids become directory names, so they are kept plain."""
    if not _PATH_SAFE.fullmatch(value):
        raise ConfigurationError(name, f"{value!r} may hold only letters, digits, '.', '_', '-'")
    return value


@dataclass(frozen=True)
class Metadata:
    source_id: str
    source_name: str

    def __post_init__(self):
        check_path_safe("metadata.source_name", self.source_name)


@dataclass(frozen=True)
class CsvOptions:
    delimiter: str = ","
    quote: str = '"'
    escape: str = "\\"
    header: bool = True
    encoding: str = "UTF-8"
    null_value: str = ""


@dataclass(frozen=True)
class JsonOptions:
    multiline: bool = False
    flatten_depth: int = 0


@dataclass(frozen=True)
class ParquetOptions:
    date_column: str = "date"
    start_date: str | None = None
    end_date: str | None = None


@dataclass(frozen=True)
class Connection:
    """``reader`` serves sources Spark has no format for: any function that returns a
    DataFrame. ``jdbc_options`` is an opaque mapping built by ``sources.jdbc`` and may
    hold credentials, so it never appears in ``repr`` or logs."""

    connection_type: str
    file_path: str | None = None
    file_format: str | None = None
    csv: CsvOptions = CsvOptions()
    json: JsonOptions = JsonOptions()
    parquet: ParquetOptions = ParquetOptions()
    jdbc_options: Mapping[str, str] | None = field(default=None, repr=False)
    reader: Callable[[SparkSession], DataFrame] | None = field(default=None, repr=False)

    def __post_init__(self):
        _one_of("connection.connection_type", self.connection_type, CONNECTION_TYPES)
        if self.connection_type == "file" and self.reader is None:
            if not self.file_path:
                raise ConfigurationError("connection.file_path", "is required for file sources")
            _one_of("connection.file_format", self.file_format or "", FILE_FORMATS)
        if self.connection_type == "jdbc" and self.reader is None and not self.jdbc_options:
            raise ConfigurationError("connection.jdbc_options", "is required for jdbc sources")


@dataclass(frozen=True)
class Ingestion:
    mode: str = "full"
    incremental_column: str | None = None
    watermark_storage: str | None = None
    lag_seconds: int = 0
    lag_units: int = 0

    def __post_init__(self):
        _one_of("ingestion.mode", self.mode, INGESTION_MODES)
        if self.mode == "incremental":
            if not self.incremental_column:
                raise ConfigurationError("ingestion.incremental_column", "is required")
            if not self.watermark_storage:
                raise ConfigurationError("ingestion.watermark_storage", "is required")


@dataclass(frozen=True)
class SchemaEnforcement:
    """``mode`` says what a rule violation does to the run, ``schema_mode`` how the file
    is read, ``corrupt_mode`` what happens to records that do not parse."""

    registered: StructType | None = None
    mode: str = "permissive"
    schema_mode: str = "strict"
    corrupt_mode: str = "FAILFAST"

    def __post_init__(self):
        _one_of("schema_enforcement.mode", self.mode, ENFORCEMENT_MODES)
        _one_of("schema_enforcement.schema_mode", self.schema_mode, SCHEMA_MODES)
        _one_of("schema_enforcement.corrupt_mode", self.corrupt_mode, CORRUPT_MODES)


@dataclass(frozen=True)
class Quarantine:
    path: str | None = None
    retention_days: int = 90
    alert_threshold: float | None = None


@dataclass(frozen=True)
class Storage:
    path: str
    partition_by: tuple[str, ...] = ()
    compaction_enabled: bool = False

    @property
    def compacted_path(self) -> str:
        return f"{self.path.rstrip('/')}_compacted"


@dataclass(frozen=True)
class Monitoring:
    sla_threshold_seconds: int | None = None


@dataclass(frozen=True)
class Audit:
    path: str
    lineage_path: str | None = None
    retention_days: int = 2555


@dataclass(frozen=True)
class SourceSpec:
    metadata: Metadata
    connection: Connection
    storage: Storage
    audit: Audit
    ingestion: Ingestion = Ingestion()
    schema_enforcement: SchemaEnforcement = SchemaEnforcement()
    quarantine: Quarantine = Quarantine()
    monitoring: Monitoring = Monitoring()

    def __post_init__(self):
        needs_schema = (
            self.connection.connection_type == "file"
            and self.connection.reader is None
            and self.connection.file_format in ("csv", "json")
        )
        if needs_schema and self.schema_enforcement.registered is None:
            raise ConfigurationError(
                "schema_enforcement.registered",
                "csv and json sources need a registered schema; schemas are never inferred",
            )
        quarantine = self.quarantine.path
        if quarantine is not None:
            bronze = self.storage.path.rstrip("/") + "/"
            other = quarantine.rstrip("/") + "/"
            if other.startswith(bronze) or bronze.startswith(other):
                raise ConfigurationError("quarantine.path", "must lie outside the storage path")
