"""What the text operators share: their registry, staging and row keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL it must agree with where SQL can say it."""
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Lineage ends at files every executor can read, so a lost executor costs a
    re-read; the files also tell the planner how large the table is.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str | Column) -> Column:
    """The whole text; null reads as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def digest_pair(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes: a 128-bit key that is cheap to shuffle."""
    return [F.xxhash64(*columns).alias("__k1"),
            F.xxhash64(F.lit("second"), *columns).alias("__k2")]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, _CAPITALS, _SMALL)))
