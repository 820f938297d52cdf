"""Merge strategies, key handling and load modes."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ferryline import LoadSpec, VersionedDataset, load
from ferryline.operators.merge import dedupe_latest, dedupe_records, merge
from ferryline.operators.shape import range_filter
from ferryline.session import scratch_path

from .base import changed_orders, loaded_orders, read, scenario

KEY = "o_orderkey"

SCENE = """
WITH target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
     source AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice, o_orderdate,
                       o_orderpriority
                FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
"""
REPLACED = SCENE + """
SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source)
UNION ALL SELECT * FROM source
"""


@scenario("merge_update_insert", SCENE + """
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_custkey ELSE NULL END AS cleared_custkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       t.o_totalprice, t.o_orderdate, t.o_orderpriority
FROM target t FULL OUTER JOIN source s ON t.o_orderkey = s.o_orderkey
""")
def merge_update_insert(spark, sf_dir):
    """The source carries some columns only, one of them null: null wins, and
    the columns it lacks keep the target's value."""
    target = loaded_orders(spark, sf_dir).withColumnRenamed("o_custkey", "cleared_custkey")
    source = changed_orders(spark, sf_dir).select(
        KEY, F.lit(None).cast("bigint").alias("cleared_custkey"), "o_orderstatus")
    return merge(target, source, KEY, "update_insert")


@scenario("merge_delete_insert", REPLACED)
def merge_delete_insert(spark, sf_dir):
    return merge(loaded_orders(spark, sf_dir), changed_orders(spark, sf_dir), KEY, "delete_insert")


@scenario("merge_insert", SCENE + """
SELECT * FROM target
UNION ALL SELECT * FROM source WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target)
""")
def merge_insert(spark, sf_dir):
    return merge(loaded_orders(spark, sf_dir), changed_orders(spark, sf_dir), KEY, "insert")


@scenario("merge_update", SCENE + """
SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source)
UNION ALL SELECT * FROM source WHERE o_orderkey IN (SELECT o_orderkey FROM target)
""")
def merge_update(spark, sf_dir):
    return merge(loaded_orders(spark, sf_dir), changed_orders(spark, sf_dir), KEY, "update")


@scenario("merge_delete_missing", SCENE + """
SELECT s.o_orderkey, coalesce(t.o_custkey, NULL) AS o_custkey, s.o_orderstatus, t.o_totalprice,
       t.o_orderdate, t.o_orderpriority
FROM source s LEFT JOIN target t ON t.o_orderkey = s.o_orderkey
""")
def merge_delete_missing(spark, sf_dir):
    source = changed_orders(spark, sf_dir).select(KEY, "o_orderstatus")
    return merge(loaded_orders(spark, sf_dir), source, KEY, "update_insert", delete_missing=True)


@scenario("ignore_existing", "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'")
def ignore_existing(spark, sf_dir):
    """The target exists, so the second load is skipped."""
    target = VersionedDataset(spark, scratch_path(spark, "ignore"))
    load(loaded_orders(spark, sf_dir), target, LoadSpec())
    load(changed_orders(spark, sf_dir), target, LoadSpec(ignore_existing=True))
    return target.read()


@scenario("merge_composite_key", """
SELECT conv_id, turn,
       CASE WHEN turn >= 2 THEN 'edited' ELSE role END AS role, text
FROM conversations WHERE turn < 4
UNION ALL SELECT conv_id, turn, 'edited' AS role, text FROM conversations WHERE turn >= 4
""")
def merge_composite_key(spark, sf_dir):
    """Two-column key given as a comma separated string."""
    turns = read(spark, sf_dir, "conversations")
    source = turns.where("turn >= 2").withColumn("role", F.lit("edited"))
    return merge(turns.where("turn < 4"), source, "conv_id, turn", "update_insert")


LATEST = """
SELECT {columns} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn
  FROM lineitem) WHERE rn = 1
"""
LINE = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
        "l_tax, l_returnflag, l_linestatus, l_shipdate")
REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus"]


@scenario("dedupe_latest", LATEST.format(columns=LINE, order=", ".join(
    f"{c} DESC NULLS LAST" for c in ["l_shipdate", *REST])))
def dedupe_by_update_key(spark, sf_dir):
    return dedupe_latest(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
                         "l_shipdate")


@scenario("records_dedupe", LATEST.format(columns=LINE, order=", ".join(
    f"{c} DESC NULLS LAST" for c in [*REST, "l_shipdate"])))
def records_dedupe(spark, sf_dir):
    return dedupe_records(read(spark, sf_dir, "lineitem"), "l_orderkey,l_linenumber")


# -- load modes ---------------------------------------------------------------------


def orders_dataset(spark, sf_dir, label, update_key="o_orderdate"):
    """A dataset partitioned by year, loaded with the orders before 2000."""
    target = VersionedDataset(spark, scratch_path(spark, label), ["o_year"])
    load(with_year(loaded_orders(spark, sf_dir)), target, LoadSpec(update_key=update_key))
    return target


def with_year(df):
    return df.withColumn("o_year", F.year("o_orderdate"))


YEAR = "CAST(year(o_orderdate) AS INTEGER) AS o_year"


@scenario("mode_full_refresh", f"""
SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       {YEAR}
FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""")
def mode_full_refresh(spark, sf_dir):
    target = orders_dataset(spark, sf_dir, "full")
    load(with_year(changed_orders(spark, sf_dir)), target, LoadSpec(mode="full-refresh"))
    return target.read()


@scenario("mode_truncate", f"""
SELECT o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, 'X' AS o_orderstatus, o_totalprice,
       o_orderdate, o_orderpriority, {YEAR}
FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""")
def mode_truncate(spark, sf_dir):
    """The target keeps its definition: the column the source lacks is null."""
    target = orders_dataset(spark, sf_dir, "truncate")
    load(with_year(changed_orders(spark, sf_dir)).drop("o_custkey"), target,
         LoadSpec(mode="truncate"))
    return target.read()


@scenario("mode_incremental_pk_uk", f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate > (SELECT max(o_orderdate) FROM orders
                                WHERE o_orderdate < TIMESTAMP '2000-01-01')
            THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority, {YEAR}
FROM orders""")
def mode_incremental_pk_uk(spark, sf_dir):
    """Only rows above the target's high-water mark are taken; the second run
    finds nothing new."""
    target = orders_dataset(spark, sf_dir, "inc")
    spec = LoadSpec(mode="incremental", primary_key=KEY, update_key="o_orderdate")
    source = with_year(changed_orders(spark, sf_dir))
    load(source, target, spec)
    load(source, target, spec)
    return target.read()


@scenario("mode_incremental_pk", f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'X' ELSE o_orderstatus END
         AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority, {YEAR}
FROM orders""")
def mode_incremental_pk(spark, sf_dir):
    target = orders_dataset(spark, sf_dir, "incpk")
    load(with_year(changed_orders(spark, sf_dir)), target,
         LoadSpec(mode="incremental", primary_key=KEY))
    return target.read()


@scenario("mode_incremental_uk", """
SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def mode_incremental_uk(spark, sf_dir):
    """Append-only: rows above the mark are added, nothing is rewritten."""
    events = read(spark, sf_dir, "events")
    target = VersionedDataset(spark, scratch_path(spark, "incuk"))
    spec = LoadSpec(mode="incremental", update_key="ts")
    load(events.where("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'"), target, spec)
    load(events, target, spec)
    return target.read()


SNAP_1 = datetime.datetime(2024, 5, 1)
SNAP_2 = datetime.datetime(2024, 5, 2)


@scenario("mode_snapshot", """
SELECT c_custkey, c_acctbal, TIMESTAMP '2024-05-01 00:00:00' AS _loaded_at FROM customer
UNION ALL
SELECT c_custkey, c_acctbal, TIMESTAMP '2024-05-02 00:00:00' AS _loaded_at FROM customer""")
def mode_snapshot(spark, sf_dir):
    """Two snapshots; running the second one again adds nothing."""
    source = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    target = VersionedDataset(spark, scratch_path(spark, "snapshot"))
    for at in (SNAP_1, SNAP_2, SNAP_2):
        load(source, target, LoadSpec(mode="snapshot", loaded_at=at))
    return target.read()


BACKFILLED = f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate >= TIMESTAMP '1999-03-01' THEN 'X' ELSE o_orderstatus END
         AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority, {YEAR}
FROM orders WHERE o_orderdate < TIMESTAMP '2000-07-01'"""


def backfill(spark, sf_dir, chunk_size=None):
    target = orders_dataset(spark, sf_dir, "backfill")
    load(with_year(changed_orders(spark, sf_dir)), target, LoadSpec(
        mode="backfill", primary_key=KEY, update_key="o_orderdate",
        range="1999-03-01..2000-06-30", chunk_size=chunk_size))
    return target.read()


@scenario("mode_backfill", BACKFILLED)
def mode_backfill(spark, sf_dir):
    return backfill(spark, sf_dir)


@scenario("mode_backfill_chunked", BACKFILLED)
def mode_backfill_chunked(spark, sf_dir):
    """The same range in quarters gives the same table."""
    return backfill(spark, sf_dir, "3m")


@scenario("backfill_range", """
SELECT * FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def backfill_range(spark, sf_dir):
    return range_filter(read(spark, sf_dir, "orders"), "o_orderdate", "1997-01-01..1997-12-31")
