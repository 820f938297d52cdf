"""Run configuration: options, streams, sources and targets.

Every class here is a plain dataclass. ``from_dict`` accepts the keys a YAML or
JSON document uses and copies what it is given, so nothing is shared between
two configurations built from the same dictionary; ``to_dict`` writes only the
keys that were set.
"""

from __future__ import annotations

import copy
import dataclasses
import datetime
import json
import os
from dataclasses import dataclass, field
from enum import Enum
from typing import Any

import yaml

from .enums import Compression, Format, MergeStrategy, Mode


def to_plain(value: Any) -> Any:
    """Configuration value -> dict/list/scalar ready for JSON or YAML."""
    if hasattr(value, "to_dict"):
        return value.to_dict()
    if isinstance(value, Enum):
        return value.value
    if isinstance(value, dict):
        return {k: to_plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [to_plain(v) for v in value]
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def as_list(value: Any) -> list[str]:
    """A list, a comma separated string or nothing -> list of names."""
    if value is None:
        return []
    if isinstance(value, str):
        return [part.strip() for part in value.split(",") if part.strip()]
    return list(value)


def as_mapping(value: Any) -> Any:
    """JSON/YAML text is parsed once; dicts and lists are copied."""
    if isinstance(value, str):
        return yaml.safe_load(value)
    return copy.deepcopy(value)


def load_document(path: str, spark=None) -> dict:
    """A YAML or JSON configuration file, local to the driver or on the
    cluster's file system."""
    if os.path.exists(path) or spark is None:
        with open(path, encoding="utf-8") as handle:
            document = yaml.safe_load(handle)
    else:
        from .fs import ClusterFiles

        document = yaml.safe_load(ClusterFiles(spark).read_text(path))
    if not isinstance(document, dict):
        raise ValueError(f"expected a mapping at the top level of {path}")
    return document


class Config:
    """Shared dict round trip of the dataclasses below."""

    # attribute name -> key in the document, where the two differ
    document_keys: dict[str, str] = {}

    @classmethod
    def from_dict(cls, data):
        if data is None:
            return cls()
        if isinstance(data, cls):
            return copy.deepcopy(data)
        renames = {v: k for k, v in cls.document_keys.items()}
        known = {f.name for f in dataclasses.fields(cls)}
        values = {renames.get(k, k): copy.deepcopy(v) for k, v in dict(data).items()}
        unknown = sorted(set(values) - known)
        if unknown:
            raise ValueError(f"{cls.__name__}: unknown keys {unknown}")
        return cls(**values)

    def to_dict(self) -> dict:
        out = {}
        for spec in dataclasses.fields(self):
            value = getattr(self, spec.name)
            if value is not None:
                out[self.document_keys.get(spec.name, spec.name)] = to_plain(value)
        return out

    def overlay(self, other):
        """A copy of ``self`` where every key set in ``other`` wins."""
        merged = copy.deepcopy(self)
        for spec in dataclasses.fields(other):
            value = getattr(other, spec.name)
            if value is None:
                continue
            mine = getattr(merged, spec.name)
            if isinstance(mine, Config) and isinstance(value, Config):
                value = mine.overlay(value)
            setattr(merged, spec.name, copy.deepcopy(value))
        return merged


@dataclass
class SourceOptions(Config):
    trim_space: bool | None = None
    empty_as_null: bool | None = None
    header: bool | None = None
    flatten: bool | None = None
    fields_per_rec: int | None = None
    chunk_size: str | int | None = None
    compression: Compression | str | None = None
    format: Format | str | None = None
    null_if: str | None = None
    datetime_format: str | None = None
    skip_blank_lines: bool | None = None
    delimiter: str | None = None
    max_decimals: int | None = None
    jmespath: str | None = None
    sheet: str | None = None
    range: str | None = None
    limit: int | None = None
    offset: int | None = None
    columns: dict | None = None
    transforms: Any = None


@dataclass
class TargetOptions(Config):
    header: bool | None = None
    compression: Compression | str | None = None
    concurrency: int | None = None
    batch_limit: int | None = None
    datetime_format: str | None = None
    delimiter: str | None = None
    file_max_rows: int | None = None
    file_max_bytes: int | None = None
    format: Format | str | None = None
    max_decimals: int | None = None
    use_bulk: bool | None = None
    ignore_existing: bool | None = None
    delete_missing: bool | None = None
    merge_strategy: MergeStrategy | str | None = None
    column_casing: str | None = None
    column_typing: dict | None = None
    add_new_columns: bool | None = None
    adjust_column_type: bool | None = None
    table_keys: dict | None = None
    table_ddl: str | None = None
    table_tmp: str | None = None
    pre_sql: str | None = None
    post_sql: str | None = None


@dataclass
class Source(Config):
    conn: str | None = None
    stream: str | None = None
    primary_key: Any = None
    update_key: str | None = None
    limit: int | None = None
    options: SourceOptions | dict | None = None

    def __post_init__(self):
        self.options = SourceOptions.from_dict(self.options)


@dataclass
class Target(Config):
    conn: str | None = None
    object: str | None = None
    options: TargetOptions | dict | None = None

    def __post_init__(self):
        self.options = TargetOptions.from_dict(self.options)


@dataclass
class ReplicationStream(Config):
    """One stream of a replication; unset fields fall back to the defaults."""

    id: str | None = None
    description: str | None = None
    mode: Mode | str | None = None
    object: str | None = None
    select: Any = None
    files: list | None = None
    where: str | None = None
    primary_key: Any = None
    update_key: str | None = None
    sql: str | None = None
    tags: list | None = None
    source_options: SourceOptions | dict | None = None
    target_options: TargetOptions | dict | None = None
    schedule: str | None = None
    disabled: bool | None = None
    transforms: Any = None
    columns: Any = None
    hooks: Any = None

    def __post_init__(self):
        from .plans.steps import HookMap

        if self.source_options is not None:
            self.source_options = SourceOptions.from_dict(self.source_options)
        if self.target_options is not None:
            self.target_options = TargetOptions.from_dict(self.target_options)
        if self.hooks is not None:
            self.hooks = HookMap.from_dict(self.hooks)

    def enable(self):
        self.disabled = False

    def disable(self):
        self.disabled = True


def to_json(config: Any) -> str:
    return json.dumps(to_plain(config))
