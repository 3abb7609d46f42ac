"""Typed failures of an ingestion run."""

from __future__ import annotations


class IngestionError(Exception):
    """Base class; ``str(error)`` is what the audit row stores."""


class ConfigurationError(IngestionError):
    def __init__(self, field: str, message: str):
        super().__init__(f"{field}: {message}")
        self.field = field
        self.message = message


class ConnectorError(IngestionError):
    def __init__(self, source: str, cause: str):
        super().__init__(f"{source}: {cause}")
        self.source = source
        self.cause = cause


class StorageWriteError(IngestionError):
    def __init__(self, path: str, cause: str):
        super().__init__(f"{path}: {cause}")
        self.path = path
        self.cause = cause


class QualityViolation(IngestionError):
    """Raised in strict mode when at least one row breaks a rule."""

    def __init__(self, source: str, flagged: int):
        super().__init__(f"{source}: {flagged} rows break a rule in strict mode")
        self.source = source
        self.flagged = flagged


class UnexpectedError(IngestionError):
    pass
