"""Sources that change from file to file, and targets that are hard to match."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferryline import LoadSpec, TargetOptions, VersionedDataset, load
from ferryline.operators.infer import infer_types
from ferryline.operators.merge import merge
from ferryline.session import scratch_path
from ferryline.sinks.files import write_files
from ferryline.sources.files import read_files
from ferryline.streaming import loads

from .base import changed_orders, loaded_orders, read, scenario


def two_layouts(spark, sf_dir, fmt):
    """Orders to 1999 without a priority, later ones with their columns turned round."""
    folder = scratch_path(spark, f"mixed-{fmt}")
    orders = read(spark, sf_dir, "orders")
    early = "o_orderdate < TIMESTAMP_NTZ '2000-01-01 00:00:00'"
    write_files(orders.where(early).drop("o_orderpriority"), f"{folder}/early", fmt, TargetOptions())
    write_files(orders.where(f"NOT {early}").select(*reversed(orders.columns)), f"{folder}/late",
                fmt, TargetOptions())
    return [f"{folder}/early", f"{folder}/late"]


MIXED = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders"""


@scenario("scan_csv_mixed_headers", MIXED)
def scan_csv_mixed_headers(spark, sf_dir):
    """Each header names its own files' columns."""
    return read_files(spark, two_layouts(spark, sf_dir, "csv"), {"format": "csv"})


@scenario("scan_arrow_evolving", MIXED)
def scan_arrow_evolving(spark, sf_dir):
    """A column that only later files have is kept."""
    return read_files(spark, two_layouts(spark, sf_dir, "arrow"), {"format": "arrow"})


@scenario("scan_json_mixed", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def scan_json_mixed(spark, sf_dir):
    """Files of an array beside files of a record per line."""
    folder = scratch_path(spark, "mixed-json")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for fmt, rest in (("json", 0), ("jsonlines", 1)):
        write_files(orders.where(F.col("o_orderkey") % 2 == rest), f"{folder}/{fmt}", fmt,
                    TargetOptions())
    return read_files(spark, [f"{folder}/json", f"{folder}/jsonlines"], {"format": "json"})


@scenario("infer_exact_numbers", """
SELECT 'plus' AS column_name, CASE WHEN bool_or(starts_with('+' || c_custkey, '+'))
       THEN 'string' ELSE 'bigint' END AS inferred_type FROM customer
UNION ALL SELECT 'long_fraction', CASE WHEN max(length(c_custkey || '2345678901234567')) > 15
                                       THEN 'string' ELSE 'double' END FROM customer
UNION ALL SELECT 'long_whole', CASE WHEN max(length(CAST(c_custkey + 1000000000000000 AS VARCHAR))) > 15
                                    THEN 'bigint' ELSE 'double' END FROM customer
UNION ALL SELECT 'fraction', CASE WHEN max(length(CAST(c_custkey AS VARCHAR))) < 15
                                  THEN 'double' ELSE 'string' END FROM customer""")
def infer_exact_numbers(spark, sf_dir):
    """No type is found that would lose a sign or a digit."""
    return infer_types(read(spark, sf_dir, "customer").selectExpr(
        "concat('+', c_custkey) AS plus", "concat(c_custkey, '.2345678901234567') AS long_fraction",
        "string(c_custkey + 1000000000000000) AS long_whole", "concat(c_custkey, '.5') AS fraction"))


PARTITION = {  # Spark and DuckDB text of partition values that are easily misread
    "share": ("cast(o_custkey % 3 as double) / 8 + 1e10", "CAST(o_custkey % 3 AS DOUBLE) / 8 + 1e10"),
    "mark": ("if(o_custkey % 4 = 0, null, concat('it''s a=b/', o_custkey % 4))",
             "CASE WHEN o_custkey % 4 <> 0 THEN 'it''s a=b/' || (o_custkey % 4) END"),
}


@scenario("merge_partition_types", f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'X' ELSE o_orderstatus END
         AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       {PARTITION["share"][1]} AS share, {PARTITION["mark"][1]} AS mark FROM orders""")
def merge_partition_types(spark, sf_dir):
    """Touched partitions are found by value: fractions, nulls and quotes alike."""
    def with_parts(df):
        return df.selectExpr("*", *[f"{sql[0]} AS {name}" for name, sql in PARTITION.items()])

    target = VersionedDataset(spark, scratch_path(spark, "parts"), partition_by=list(PARTITION))
    target.replace(with_parts(loaded_orders(spark, sf_dir)))
    source = with_parts(changed_orders(spark, sf_dir))
    target.merge_in(source, ["o_orderkey"], lambda rows: merge(
        rows, source, ["o_orderkey"], "update_insert"))
    return target.read()


@scenario("stream_two_sources", "SELECT * FROM orders")
def stream_two_sources(spark, sf_dir):
    """Two streams, each with its own checkpoint, into one target."""
    folder, orders = scratch_path(spark, "streams"), read(spark, sf_dir, "orders")
    target = VersionedDataset(spark, f"{folder}/target")
    for rest in (0, 1):
        orders.where(F.col("o_orderkey") % 2 == rest).write.parquet(f"{folder}/in{rest}")
        stream = loads.file_stream(spark, f"{folder}/in{rest}", orders.schema)
        loads.upsert_stream(stream, target, "o_orderkey", f"{folder}/checkpoint{rest}")
    return target.read()


@scenario("mode_incremental_null_key", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END AS o_orderdate,
       CASE WHEN o_orderkey % 5 = 0 THEN 'again' ELSE 'first' END AS load FROM orders""")
def mode_incremental_null_key(spark, sf_dir):
    """Rows without an update key are merged by their key in every load."""
    target = VersionedDataset(spark, scratch_path(spark, "null-key"))
    spec = LoadSpec(mode="incremental", primary_key="o_orderkey", update_key="o_orderdate")
    for label in ("first", "again"):
        load(read(spark, sf_dir, "orders").selectExpr(
            "o_orderkey", "if(o_orderkey % 5 = 0, null, o_orderdate) AS o_orderdate",
            f"'{label}' AS load"), target, spec)
    return target.read()
