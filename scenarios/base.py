"""Registry and shared inputs of the scenarios."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def scenario(name: str, sql: str | None = None):
    """Register a query under ``name`` with its equivalent SQL."""
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build
    return add


def path(sf_dir: str, table: str) -> str:
    return f"{sf_dir.rstrip('/')}/{table}.parquet"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(path(sf_dir, table))


# -- the merge scenario: a table loaded up to 2000 meets changes since 1999 --------

LOADED = "o_orderdate < TIMESTAMP_NTZ '2000-01-01 00:00:00'"
CHANGED = "o_orderdate >= TIMESTAMP_NTZ '1999-01-01 00:00:00'"


def loaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target side: orders loaded so far."""
    return read(spark, sf_dir, "orders").where(LOADED)


def changed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source side: every order since 1999, one year of it already loaded."""
    return read(spark, sf_dir, "orders").where(CHANGED).withColumn("o_orderstatus", F.lit("X"))


def create_database(spark: SparkSession, label: str) -> str:
    """A fresh catalog database stored in the shared scratch folder."""
    from ferryline.session import scratch_path

    location = scratch_path(spark, label)
    name = location.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")
    return name
