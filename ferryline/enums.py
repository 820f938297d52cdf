"""Names accepted in configuration (fixed values)."""

from __future__ import annotations

from enum import Enum


class Mode(str, Enum):
    FULL_REFRESH = "full-refresh"
    INCREMENTAL = "incremental"
    TRUNCATE = "truncate"
    SNAPSHOT = "snapshot"
    BACKFILL = "backfill"


class MergeStrategy(str, Enum):
    UPDATE_INSERT = "update_insert"
    DELETE_INSERT = "delete_insert"
    INSERT = "insert"
    UPDATE = "update"


class Format(str, Enum):
    CSV = "csv"
    JSON = "json"
    JSONLINES = "jsonlines"
    XML = "xml"
    XLSX = "xlsx"
    PARQUET = "parquet"
    ARROW = "arrow"
    AVRO = "avro"
    SAS = "sas7bdat"
    RAW = "raw"


class Compression(str, Enum):
    AUTO = "auto"
    NONE = "none"
    ZIP = "zip"
    GZIP = "gzip"
    SNAPPY = "snappy"
    ZSTD = "zstd"


def plain(value):
    """The configuration text of an enum member; other values unchanged."""
    return value.value if isinstance(value, Enum) else value
