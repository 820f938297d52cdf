"""Key-based merges of a source into a target, as DataFrame -> DataFrame plans.

Plan notes
* The key side of every anti/semi join is narrowed to its key columns and made
  distinct first, so repeated source keys collapse before the shuffle.
* The target is always the left side of a join AQE can split (``keyed_join``),
  so a target key that holds a large share of the rows does not land in one task.
* Sides are never hinted: Catalyst broadcasts one only under its own size
  threshold and AQE re-plans from measured sizes beyond it.
* Rows with a null key match nothing. They bypass the joins, so however many
  there are they are never hashed to one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import as_list
from ..enums import MergeStrategy, plain
from .joins import keyed_join
from .shape import column, quoted

_HIT = "__in_source"


def any_null(keys) -> Column:
    return F.expr(" OR ".join(f"{quoted(k)} IS NULL" for k in keys))


def split_null_keys(df: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """Rows that can match, and rows that cannot. The null test reaches the
    scan, where Parquet null counts skip row groups without such rows."""
    return df.where(~any_null(keys)), df.where(any_null(keys))


def key_rows(df: DataFrame, keys) -> DataFrame:
    return df.where(~any_null(keys)).select(*[quoted(k) for k in keys]).distinct()


def dedupe_latest(df: DataFrame, keys, update_key: str | None = None) -> DataFrame:
    """One row per key: the highest ``update_key``, ties broken by the remaining
    columns in order. Rows with a null key are all kept.

    ``row_number() = 1`` plans as a partial group limit before the shuffle, so
    each task sends at most one row per key and a hot key stays cheap.
    """
    keys = as_list(keys)
    order = [update_key] if update_key else []
    order += [f.name for f in df.schema.fields if f.name not in keys + order
              and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    if not order:
        keyed, loose = split_null_keys(df, keys)
        return keyed.distinct().unionByName(loose)
    newest = W.partitionBy(*[quoted(k) for k in keys]).orderBy(
        *[column(c).desc_nulls_last() for c in order])
    keyed, loose = split_null_keys(df, keys)
    rank = "__rank"
    latest = keyed.withColumn(rank, F.row_number().over(newest)).where(F.col(rank) == 1).drop(rank)
    return latest.unionByName(loose)


def require_unique_keys(df: DataFrame, keys) -> None:
    """Raise when a non-null key occurs twice (a key-columns-only aggregate)."""
    doubles = (df.where(~any_null(keys)).groupBy(*[quoted(k) for k in keys]).count()
               .where("count > 1").agg(F.count(F.lit(1)).alias("n")).first()["n"])
    if doubles:
        raise ValueError(f"{doubles} source keys occur more than once and no update_key is set")


def new_rows(target: DataFrame, source: DataFrame, keys, source_keys=None,
             co_located: bool = False) -> DataFrame:
    """Source rows whose key the target lacks, null keys included.

    The target's keys are first cut down to the source's, so of the target only
    keys that can match are carried further, and none at all of its other columns.
    """
    wanted = key_rows(source, keys) if source_keys is None else source_keys
    present = target.select(*[quoted(k) for k in keys]).join(wanted, keys, "left_semi")
    if co_located:  # bucketed sides keep their tasks, so null keys stay apart
        keyed, loose = split_null_keys(source, keys)
        fresh = keyed_join(keyed, present.distinct(), keys, "left_anti", True)
        return in_order(fresh, source).unionByName(loose)
    return in_order(keyed_join(source, present.distinct(), keys, "left_anti"), source)


def in_order(df: DataFrame, like: DataFrame) -> DataFrame:
    """Joins on named keys move the keys first; restore the column order."""
    return df.select(*[quoted(c) for c in like.columns])


def unmatched(target: DataFrame, source_keys: DataFrame, keys, co_located=False) -> DataFrame:
    if co_located:
        keyed, loose = split_null_keys(target, keys)
        kept = keyed_join(keyed, source_keys, keys, "left_anti", True)
        return in_order(kept, target).unionByName(loose)
    return in_order(keyed_join(target, source_keys, keys, "left_anti"), target)


def update_rows(target: DataFrame, source: DataFrame, keys, co_located: bool = False) -> DataFrame:
    """Existing rows updated in place; no new rows. Where the source has the key
    its columns win, even when null; columns it lacks keep the target's value.
    """
    keyed, loose = split_null_keys(target, keys) if co_located else (target, None)
    changed = {c: f"__src_{i}" for i, c in enumerate(source.columns) if c not in keys}
    incoming = source.where(~any_null(keys)).selectExpr(
        *[quoted(k) for k in keys], *[f"{quoted(c)} AS {a}" for c, a in changed.items()],
        f"true AS {_HIT}")
    joined = keyed_join(keyed, incoming, keys, "left_outer", co_located)
    updated = joined.selectExpr(*[
        f"CASE WHEN {_HIT} THEN {changed[c]} ELSE {quoted(c)} END AS {quoted(c)}"
        if c in changed else quoted(c) for c in target.columns])
    return updated if loose is None else updated.unionByName(loose)


def _fill(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, those missing from ``df`` as nulls."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        quoted(f.name) if have.get(f.name) == f.dataType else
        (column(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in like.schema.fields])


def update_insert(target: DataFrame, source: DataFrame, keys, source_keys: DataFrame,
                  co_located: bool = False) -> DataFrame:
    if set(target.columns) <= set(source.columns):
        # The source carries whole rows, so replacing is updating: the target is
        # only filtered by key.
        kept = unmatched(target, source_keys, keys, co_located)
        return kept.unionByName(in_order(source, target))
    inserts = _fill(new_rows(target, source, keys, source_keys, co_located), target)
    return update_rows(target, source, keys, co_located).unionByName(inserts)


def replaced(target: DataFrame, source: DataFrame, keys, co_located: bool = False) -> DataFrame:
    """Every source row, with the columns it lacks from the target row of its key:
    an update and insert that also deletes what the source does not have."""
    lacking = [c for c in target.columns if c not in source.columns]
    if not lacking:
        return in_order(source, target)
    held = target.where(~any_null(keys)).select(*[quoted(c) for c in [*keys, *lacking]])
    return _fill(keyed_join(source, held, keys, "left_outer", co_located), target)


def merge(target: DataFrame, source: DataFrame, primary_key, strategy="update_insert",
          update_key: str | None = None, delete_missing: bool = False,
          check_unique: bool = True, co_located: bool = False) -> DataFrame:
    """The target after merging ``source`` into it.

    ``update_insert``  update matching rows column by column, insert new rows
    ``delete_insert``  delete matching rows, then insert every source row
    ``insert``         insert new keys only
    ``update``         update existing keys only

    ``delete_missing`` first drops target rows whose key the (full) source does
    not have. Source rows sharing a key are reduced to the latest by
    ``update_key``; without one they are an error, except that
    ``delete_insert`` inserts them all and ``insert`` takes one.
    ``check_unique=False`` says uniqueness is known; ``co_located`` that both
    sides are bucketed on the key.
    """
    keys = as_list(primary_key)
    if not keys:
        raise ValueError("a merge needs a primary_key")
    absent = [k for k in keys if k not in source.columns or k not in target.columns]
    if absent:
        raise ValueError(f"primary_key columns are missing: {absent}")
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"source columns are not in the target: {unknown}")
    strategy = MergeStrategy(plain(strategy))
    source_keys = key_rows(source, keys)

    if strategy is MergeStrategy.DELETE_INSERT:
        rows = _fill(source, target)
        if delete_missing:
            return rows
        return unmatched(target, source_keys, keys, co_located).unionByName(rows)
    if strategy is MergeStrategy.INSERT or update_key:
        source = dedupe_latest(source, keys, update_key)
    elif check_unique:
        require_unique_keys(source, keys)
    if delete_missing:
        if strategy is MergeStrategy.UPDATE_INSERT:
            return replaced(target, source, keys, co_located)
        known = keyed_join(target.where(~any_null(keys)), source_keys, keys, "left_semi",
                           co_located)
        target = in_order(known, target)
    if strategy is MergeStrategy.INSERT:
        fresh = new_rows(target, source, keys, source_keys, co_located)
        return target.unionByName(_fill(fresh, target))
    if strategy is MergeStrategy.UPDATE:
        return update_rows(target, source, keys, co_located)
    return update_insert(target, source, keys, source_keys, co_located)


def dedupe_records(df: DataFrame, primary_key) -> DataFrame:
    """Exact removal of repeated records: one row per key, chosen by value order
    so that the result does not depend on arrival order."""
    return dedupe_latest(df, primary_key)
