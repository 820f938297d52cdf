"""Equality joins that stay splittable when a key is hot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import common_type
from .shape import column, quoted

_SPREAD = "__key_hash"


def key_hash(df: DataFrame, keys, other: DataFrame) -> Column:
    """Hash of the key columns, equal on both sides whatever their number types."""
    return F.xxhash64(*[
        column(k).cast(common_type(df.schema[k].dataType, other.schema[k].dataType))
        for k in keys])


def null_spread(df: DataFrame, keys) -> Column:
    """Hash of what else a row holds: sends rows with a null key to many tasks.
    They match nothing, so it need not agree with anything."""
    others = [quoted(f.name) for f in df.schema.fields
              if f.name not in keys and not _holds_map(f.dataType)]
    return F.xxhash64(*[F.col(c) for c in others]) if others else F.lit(0).cast("long")


def _holds_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()


def keyed_join(left: DataFrame, right: DataFrame, keys, how: str,
               co_located: bool = False) -> DataFrame:
    """Join on the named ``keys`` to a right side reduced to one row per key.

    Reducing the right side leaves it partitioned by the keys, and Spark would
    join it without a further shuffle; AQE, however, splits a hot left partition
    only between two plain shuffles. Joining on the keys and their hash makes
    Spark shuffle the reduced side once more (it is the small one), after which
    a left key holding a large share of all rows is spread over many tasks. A
    right side under the broadcast threshold is still broadcast. Left rows with a
    null key, which match nothing, are spread by their other columns.

    ``co_located`` keeps the plain join, for tables bucketed on the keys.
    """
    keys = list(keys)
    if co_located:
        return left.join(right, keys, how)
    nulls = [column(k).isNull() for k in keys if left.schema[k].nullable]
    spread = key_hash(left, keys, right)
    if nulls and how in ("left_outer", "left", "left_anti"):
        spread = F.when(reduce(lambda a, b: a | b, nulls), null_spread(left, keys)).otherwise(spread)
    tagged = left.withColumn(_SPREAD, spread)
    other = right.withColumn(_SPREAD, key_hash(right, keys, left))
    return tagged.join(other, keys + [_SPREAD], how).drop(_SPREAD)
