"""The load modes: what is read from the source, and how it enters the target."""

from __future__ import annotations

import datetime
import re
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import as_list
from ..enums import MergeStrategy, Mode, plain
from ..errors import TransferError
from ..operators import shape
from ..operators.merge import dedupe_latest, merge, new_rows, require_unique_keys
from ..operators.schema import conform, evolved_schema
from ..session import one_row
from .targets import stage, staged_for_now

HIGH_WATER = "high_water"
SNAPSHOT_AT = "snapshot_at"


@dataclass
class LoadSpec:
    mode: Any = Mode.FULL_REFRESH
    primary_key: Any = None
    update_key: str | None = None
    range: str | None = None
    strategy: Any = None
    delete_missing: bool = False
    ignore_existing: bool = False
    add_new_columns: bool = False
    adjust_column_type: bool = False
    chunk_size: Any = None
    staging: str | None = None
    # The source is a whole stored columnar table: reading it again is as good
    # as reading a staged copy.
    source_is_stored: bool = False
    loaded_at: datetime.datetime | None = None
    before_merge: Any = None
    after_merge: Any = None


@dataclass
class LoadReport:
    mode: str
    status: str = "success"
    rows_in: int | None = None
    rows_out: int | None = None
    detail: dict = field(default_factory=dict)
    left_out: int = 0  # rows without an update key, which an append does not take again


def mark_text(value, kind: T.DataType):
    """A high-water mark as text that reads back the same in any session: instants
    carry their zone offset."""
    if isinstance(kind, T.TimestampType):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return value.cast("string")


class _Counted:
    """A DataFrame that reports its row count (and a maximum) once written, from
    the same job: the plan is never run a second time to count it."""

    def __init__(self, df: DataFrame, maximum: str | None = None):
        self.observation = Observation()
        metrics = [F.count(F.lit(1)).alias("rows")]
        self.has_max = maximum is not None and maximum in df.columns
        if self.has_max:
            kind = df.schema[maximum].dataType
            metrics.append(mark_text(F.max(shape.column(maximum)), kind).alias("high"))
        self.df = df.observe(self.observation, *metrics)

    @property
    def rows(self) -> int:
        return int(self.observation.get["rows"])

    @property
    def high(self) -> str | None:
        return self.observation.get["high"] if self.has_max else None


def load(source: DataFrame, target, spec: LoadSpec) -> LoadReport:
    """Run one load. ``source`` is lazy; filters added here reach its scan."""
    mode = Mode(plain(spec.mode) or Mode.FULL_REFRESH.value)
    if spec.ignore_existing and target.exists():
        return LoadReport(mode.value, "skipped", 0, 0)
    run = {
        Mode.FULL_REFRESH: full_refresh,
        Mode.TRUNCATE: truncate,
        Mode.SNAPSHOT: snapshot,
        Mode.INCREMENTAL: incremental,
        Mode.BACKFILL: backfill,
    }[mode]
    with staged_for_now(target.spark):  # copies go with the load, done or failed
        if spec.staging and mode in (Mode.FULL_REFRESH, Mode.TRUNCATE, Mode.SNAPSHOT):
            source = stage(source, "extract", spec.staging)  # the others stage what they merge
        return run(source, target, spec)


def _write(target, df: DataFrame, action: str, spec: LoadSpec, mode: Mode) -> LoadReport:
    """Replace or append, with the new high-water mark in the published state."""
    if not target.counts_rows:
        getattr(target, action)(df)
        return LoadReport(mode.value)
    if not spec.update_key or not hasattr(target, "versions"):
        counted = _Counted(df)
        getattr(target, action)(counted.df)
        return LoadReport(mode.value, rows_in=counted.rows, rows_out=counted.rows)
    counted = _Counted(df, spec.update_key)
    old = target.state().get(HIGH_WATER) if action == "append" else None

    def state():
        high = _higher(df, spec.update_key, old, counted.high)
        return {} if high is None else {HIGH_WATER: high}

    getattr(target, action)(counted.df, state)
    return LoadReport(mode.value, rows_in=counted.rows, rows_out=counted.rows)


def full_refresh(source: DataFrame, target, spec: LoadSpec) -> LoadReport:
    """Replace the target; with a ``chunk_size``, range by range of the update key or
    of a primary key of one column."""
    keys = as_list(spec.primary_key)
    key = spec.update_key or (keys[0] if len(keys) == 1 else None)
    if spec.chunk_size and key and target.counts_rows:
        return chunked_load(source, target, key, spec.chunk_size)
    return _write(target, source, "replace", spec, Mode.FULL_REFRESH)


def truncate(source: DataFrame, target, spec: LoadSpec) -> LoadReport:
    """Empty the target and load into its existing definition."""
    if not target.exists():
        return _write(target, source, "replace", spec, Mode.TRUNCATE)
    have = target.read().schema
    schema = evolved_schema(have, source.schema, spec.add_new_columns, spec.adjust_column_type)
    rows = conform(source, schema, spec.add_new_columns)
    keeps_definition = schema == have or [
        (f.name, f.dataType) for f in schema] == [(f.name, f.dataType) for f in have]
    if keeps_definition and hasattr(target, "overwrite_rows"):
        if not target.counts_rows:
            target.overwrite_rows(rows)
            return LoadReport(Mode.TRUNCATE.value)
        counted = _Counted(rows)
        target.overwrite_rows(counted.df)
        return LoadReport(Mode.TRUNCATE.value, rows_in=counted.rows, rows_out=counted.rows)
    return _write(target, rows, "replace", spec, Mode.TRUNCATE)


def snapshot(source: DataFrame, target, spec: LoadSpec) -> LoadReport:
    """Add the whole source, stamped with the run time. A stamp that the table already
    holds, from the last run or an earlier one, adds nothing."""
    at = str(spec.loaded_at or datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None))
    if target.exists() and (target.state().get(SNAPSHOT_AT) == at or _holds_stamp(target, at)):
        return LoadReport(Mode.SNAPSHOT.value, "skipped", 0, 0)
    rows = shape.with_loaded_at(source, at)
    if target.exists():
        have = target.read().schema
        schema = evolved_schema(have, rows.schema, spec.add_new_columns)
        rows = conform(rows, schema, spec.add_new_columns)
    if not target.counts_rows:
        target.append(rows)
        return LoadReport(Mode.SNAPSHOT.value)
    counted = _Counted(rows)
    target.append(counted.df, {SNAPSHOT_AT: at})
    return LoadReport(Mode.SNAPSHOT.value, rows_in=counted.rows, rows_out=counted.rows)


def _holds_stamp(target, at: str) -> bool:
    """Whether rows of an earlier snapshot have this stamp: a filter on one column,
    which row groups of other stamps answer from their statistics."""
    held = target.read()
    if "_loaded_at" not in held.columns:
        return False
    stamp = F.lit(at).cast(held.schema["_loaded_at"].dataType)
    return bool(held.select("_loaded_at").where(F.col("_loaded_at") == stamp).take(1))


def high_water(target, update_key: str, kind) -> Any:
    """The target's largest ``update_key`` as a literal column: from the state
    published with the data, else from one single-column aggregate."""
    text = target.state().get(HIGH_WATER)
    if text is None:
        held = target.read()
        text = held.agg(mark_text(F.max(shape.column(update_key)),
                                  held.schema[update_key].dataType).alias("h")).first()["h"]
    return None if text is None else F.lit(text).cast(kind)


def _higher(df: DataFrame, update_key: str, one: str | None, two: str | None) -> str | None:
    if one is None or two is None:
        return one if two is None else two
    kind = df.schema[update_key].dataType
    highest = F.greatest(F.lit(one).cast(kind), F.lit(two).cast(kind))
    return one_row(df.sparkSession).select(mark_text(highest, kind).alias("h")).first()["h"]


def incremental(source: DataFrame, target, spec: LoadSpec) -> LoadReport:
    keys = as_list(spec.primary_key)
    if not keys and not spec.update_key:
        raise TransferError("incremental mode needs a primary_key, an update_key or both")
    if spec.delete_missing and spec.update_key:
        raise TransferError("delete_missing needs the full source; it cannot be combined with "
                            "an update_key filter")
    rows = source
    if spec.update_key and target.exists():
        mark = high_water(target, spec.update_key, source.schema[spec.update_key].dataType)
        if mark is not None:
            key = shape.column(spec.update_key)
            # Rows without an update key are never above the mark. A merge by key
            # takes them every time; an append would repeat them, so it only tells
            # their number.
            rows = source.where((key > mark) | key.isNull())
    if keys:
        return _merge_load(rows, target, spec, keys, Mode.INCREMENTAL)
    if not target.exists():
        return _write(target, rows, "replace", spec, Mode.INCREMENTAL)
    have = target.read().schema
    schema = evolved_schema(have, rows.schema, spec.add_new_columns)
    rows = conform(rows, schema, spec.add_new_columns)
    counted = _Counted(rows, spec.update_key)
    staged = stage(counted.df, "extract", spec.staging)
    placed = staged.where(shape.column(spec.update_key).isNotNull())
    taken = placed.count()
    report = LoadReport(Mode.INCREMENTAL.value, rows_in=taken, rows_out=taken,
                        left_out=counted.rows - taken)
    if taken == 0:
        return report
    high = _higher(staged, spec.update_key, target.state().get(HIGH_WATER), counted.high)
    target.append(placed, {HIGH_WATER: high})
    return report


def backfill(source: DataFrame, target, spec: LoadSpec) -> LoadReport:
    keys = as_list(spec.primary_key)
    if not spec.range or not spec.update_key or not keys:
        raise TransferError("backfill mode needs a range, an update_key and a primary_key")
    if spec.delete_missing:
        raise TransferError("delete_missing needs the full source; it cannot be combined with "
                            "a backfill range")
    if not spec.chunk_size:
        rows = shape.range_filter(source, spec.update_key, spec.range)
        return _merge_load(rows, target, spec, keys, Mode.BACKFILL)
    # Every chunk is an extract of its own; all of them are merged at once.
    kind, parts, rows_in = source.schema[spec.update_key].dataType, [], 0
    for lower, upper, last in chunk_bounds(source, spec):
        key = shape.column(spec.update_key)
        below = key <= F.lit(upper).cast(kind) if last else key < F.lit(upper).cast(kind)
        rows = shape.range_filter(source, spec.update_key, spec.range)
        counted = _Counted(rows.where((key >= F.lit(lower).cast(kind)) & below))
        parts.append(stage(counted.df, "extract", spec.staging))
        rows_in += counted.rows
    staged = reduce(DataFrame.union, parts)
    top = staged.agg(mark_text(F.max(shape.column(spec.update_key)), kind).alias("h")).first()["h"]
    report = _merge_load(staged, target, spec, keys, Mode.BACKFILL, (staged, rows_in, top))
    report.detail["chunks"] = len(parts)
    return report


def chunked_load(source: DataFrame, target, key: str, chunk_size) -> LoadReport:
    """Full load in ranges of ``key``: each chunk is its own filtered extract
    and commit, so an interrupted load has lost one chunk at most. Rows without
    a key form the last chunk."""
    ends = source.agg(F.min(shape.column(key)).cast("string").alias("a"),
                      F.max(shape.column(key)).cast("string").alias("b")).first()
    total = LoadReport(Mode.FULL_REFRESH.value, rows_in=0, rows_out=0, detail={"chunks": 0})
    parts = [source.where(shape.column(key).isNull())]
    if ends["a"] is not None:
        kind = source.schema[key].dataType
        spec = LoadSpec(update_key=key, range=f"{ends['a']}..{ends['b']}", chunk_size=chunk_size)
        for lower, upper, last in chunk_bounds(source, spec):
            value, top = shape.column(key), F.lit(upper).cast(kind)
            inside = (value >= F.lit(lower).cast(kind)) & (value <= top if last else value < top)
            parts.insert(-1, source.where(inside))
    for i, part in enumerate(parts):
        counted = _Counted(part)
        (target.replace if i == 0 else target.append)(counted.df)
        total.rows_in += counted.rows
        total.detail["chunks"] += 1
    total.rows_out = total.rows_in
    return total


CHUNK = re.compile(r"^(\d+)\s*([a-z]*)$")
# Unit letters of a time chunk and the interval unit each names.
CHUNK_UNITS = {"h": "hours", "d": "days", "w": "weeks", "m": "months", "y": "years"}


def chunk_bounds(source: DataFrame, spec: LoadSpec) -> list[tuple]:
    """Ranges of ``chunk_size`` covering ``range``: a count of key units, or a
    time span such as ``6h``, ``7d`` or ``1m``."""
    start, end = shape.range_bounds(spec.range)
    found = CHUNK.match(str(spec.chunk_size).strip().lower())
    if not found:
        raise ValueError(f"cannot read chunk_size {spec.chunk_size!r}")
    size, unit = int(found[1]), found[2]
    if size == 0:
        raise ValueError("chunk_size must be positive")
    spark = source.sparkSession
    kind = source.schema[spec.update_key].dataType.simpleString()
    if unit:
        if unit not in CHUNK_UNITS:
            raise ValueError(f"unknown chunk_size unit {unit!r}")
        step = f"INTERVAL {size} {CHUNK_UNITS[unit]}"
        as_key = "timestamp_ntz" if kind != "date" else "date"
        if as_key == "timestamp_ntz" and shape.DATE_ONLY.match(end):
            end = f"{end} 23:59:59.999999"
    else:
        step, as_key = str(size), kind
    starts = spark.sql(
        f"SELECT transform(sequence(CAST(:a AS {as_key}), CAST(:b AS {as_key}), {step}), "
        "x -> CAST(x AS STRING)) AS marks", args={"a": start, "b": end}).first()["marks"]
    marks = list(starts) + [end]
    return [(marks[i], marks[i + 1], i == len(marks) - 2) for i in range(len(marks) - 1)]


def _merge_load(rows: DataFrame, target, spec: LoadSpec, keys, mode: Mode,
                extracted: tuple[DataFrame, int, str | None] | None = None) -> LoadReport:
    """Extract to a staged copy, then merge that copy into the target.

    The origin is read once. The copy's size is known to the join planner, and
    the row count and maximum come from the job that wrote it.
    """
    strategy = MergeStrategy(plain(spec.strategy) or MergeStrategy.UPDATE_INSERT.value)
    staged, rows_in, top = extracted or _extract(rows, spec)
    if not spec.update_key and strategy in (MergeStrategy.UPDATE_INSERT, MergeStrategy.UPDATE):
        require_unique_keys(staged, keys)
    report = LoadReport(mode.value, rows_in=rows_in, rows_out=0)
    if rows_in == 0 and target.exists() and not spec.delete_missing:
        return report  # nothing to apply: publish no new version
    state = {}
    if spec.update_key:
        old = target.state().get(HIGH_WATER)
        high = _higher(staged, spec.update_key, old, top)
        state = {} if high is None else {HIGH_WATER: high}
    if spec.before_merge:
        spec.before_merge()
    report.rows_out = _apply(staged, target, spec, keys, strategy, state)
    if spec.after_merge:
        spec.after_merge()
    return report


def _extract(rows: DataFrame, spec: LoadSpec) -> tuple[DataFrame, int, str | None]:
    """The rows to merge, their number and their largest ``update_key``.

    A filtered extract is staged even when its source is stored: only the copy
    tells the planner how small it is, and a merge source known to be small
    leaves the target unshuffled.
    """
    if spec.source_is_stored and not spec.update_key and not spec.staging:
        return rows, rows.count(), None
    counted = _Counted(rows, spec.update_key)
    staged = stage(counted.df, "extract", spec.staging)
    return staged, counted.rows, counted.high


def _first_load(staged: DataFrame, target, spec: LoadSpec, keys, strategy, state) -> int | None:
    if strategy is MergeStrategy.UPDATE:
        staged = staged.limit(0)
    elif strategy is not MergeStrategy.DELETE_INSERT:
        staged = dedupe_latest(staged, keys, spec.update_key)
    counted = _Counted(staged)
    target.replace(counted.df if target.counts_rows else staged, state)
    return counted.rows if target.counts_rows else None


def _apply(staged: DataFrame, target, spec: LoadSpec, keys, strategy, state) -> int | None:
    if not target.exists():
        return _first_load(staged, target, spec, keys, strategy, state)
    have = target.read().schema
    schema = evolved_schema(have, staged.schema, spec.add_new_columns, spec.adjust_column_type)
    widened = any(schema[f.name].dataType != f.dataType for f in have)
    grown = len(schema) > len(have)
    extra = [c for c in staged.columns if c not in schema.names]
    if extra:
        raise ValueError(f"columns not in the target: {extra} (set add_new_columns)")
    incoming = conform(staged, T.StructType([f for f in schema if f.name in staged.columns]))

    if strategy is MergeStrategy.INSERT and not spec.delete_missing and not widened:
        # Nothing existing changes: add the new rows, rewrite nothing.
        fresh = conform(new_rows(target.read(), dedupe_latest(incoming, keys, spec.update_key),
                                 keys), schema)
        if not hasattr(target, "versions"):
            fresh = stage(fresh, "insert")
        counted = _Counted(fresh)
        target.append(counted.df if target.counts_rows else fresh, state or None)
        return counted.rows if target.counts_rows else None

    if hasattr(target, "merge_by_statements") and not (widened or grown):
        rows = incoming if strategy is MergeStrategy.DELETE_INSERT else dedupe_latest(
            incoming, keys, spec.update_key)
        target.merge_by_statements(rows, keys, strategy.value, spec.delete_missing)
        return None

    seen = []

    def merged(target_rows: DataFrame) -> DataFrame:
        rows = conform(target_rows, schema) if widened or grown else target_rows
        result = merge(rows, incoming, keys, strategy, update_key=spec.update_key,
                       delete_missing=spec.delete_missing, check_unique=False,
                       co_located=getattr(target, "bucket_by", None) == list(keys))
        if not target.counts_rows:
            return result
        seen.append(_Counted(result))
        return seen[-1].df

    target.merge_in(incoming, keys, merged, state, keep_state=not state,
                    whole=spec.delete_missing or widened)
    return seen[-1].rows if seen else 0
