"""Queries, result rendering, replications, steps and streaming runs."""

from __future__ import annotations

import yaml
from pyspark.sql import functions as F

from ferryline import Connection, HookMap, Pipeline, Replication, Transfer, VersionedDataset
from ferryline.fs import ClusterFiles
from ferryline.functions.render import csv_lines, render_csv, render_json
from ferryline.operators.shape import cast_columns
from ferryline.plans.steps import (
    StepCheck, StepGroup, StepQuery, StepReplication, StepRunner, copy_dataset, fan_out,
    list_files, loop_values, run_checks)
from ferryline.session import scratch_path
from ferryline.sinks.files import write_files
from ferryline.streaming import loads

from .base import create_database, changed_orders, loaded_orders, path, read, scenario

# -- queries and rendering -------------------------------------------------------------


@scenario("exec_sql", """
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS total
FROM orders GROUP BY o_orderpriority""")
def exec_sql(spark, sf_dir):
    """Query results under the JSON contract: the decimal total is text."""
    read(spark, sf_dir, "orders").createOrReplaceTempView("orders_rows")
    return render_json(Connection("SPARK", spark).query("""
        SELECT o_orderpriority, count(*) AS n_orders,
               sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
        FROM orders_rows GROUP BY o_orderpriority"""))


def typed_orders(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumns({
        "order_day": F.to_date("o_orderdate"), "is_open": F.col("o_orderstatus") == "O"})
    return cast_columns(orders, {"o_totalprice": "decimal(12,2)"}).select(
        "o_orderkey", "o_totalprice", "o_orderdate", "order_day", "is_open", "o_orderpriority")


@scenario("render_json_types", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS o_orderdate,
       strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS order_day,
       CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END AS is_open, o_orderpriority
FROM orders""")
def render_json_types(spark, sf_dir):
    return render_json(typed_orders(spark, sf_dir))


@scenario("render_csv_types", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S +00') AS o_orderdate,
       strftime(o_orderdate, '%Y-%m-%d') AS order_day,
       CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END AS is_open, o_orderpriority
FROM orders""")
def render_csv_types(spark, sf_dir):
    return render_csv(typed_orders(spark, sf_dir))


@scenario("csv_quoting", """
SELECT doc_id || ',' ||
       CASE WHEN regexp_matches(text, '[,"\\n\\r\\\\]')
            THEN '"' || replace(text, '"', '""') || '"' ELSE text END || ',' || lang AS line
FROM documents""")
def csv_quoting(spark, sf_dir):
    """Values holding the delimiter, quotes or line breaks are quoted."""
    return csv_lines(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


@scenario("sql_params", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice > 250000 AND o_orderpriority = '1-URGENT'""")
def sql_params(spark, sf_dir):
    """Variables are bound as parameters, never pasted into the text."""
    read(spark, sf_dir, "orders").createOrReplaceTempView("orders_rows")
    return Transfer(src_conn="SPARK", spark=spark,
                    env={"least": 250000, "priority": "1-URGENT"}, src_stream="""
                        SELECT o_orderkey, o_totalprice FROM orders_rows
                        WHERE o_totalprice > :least AND o_orderpriority = :priority""").dataframe()


# -- replications ----------------------------------------------------------------------


def replication(spark, sf_dir, **changes):
    """Four streams; one disabled, one with its own mode."""
    target = scratch_path(spark, "rep")
    base = {
        "source": "LOCAL", "target": "LOCAL", "spark": spark,
        "defaults": {"mode": "full-refresh", "object": target + "/{stream_table}.parquet"},
        "streams": {
            path(sf_dir, "customer"): {"tags": ["core"]},
            path(sf_dir, "orders"): {"mode": "incremental", "primary_key": "o_orderkey",
                                     "update_key": "o_orderdate", "tags": ["core"]},
            path(sf_dir, "part"): {"where": "p_size > 25", "select": ["p_partkey", "p_size"]},
            path(sf_dir, "lineitem"): {"disabled": True},
        },
    }
    return Replication(**{**base, **changes}), target


def report_rows(report):
    name = F.regexp_replace(F.element_at(F.split("stream", "/"), -1), "\\.parquet$", "")
    return report.select(name.alias("stream"), "mode", "status", "rows_in", "rows_out")


REPORT = """
SELECT 'customer' AS stream, 'full-refresh' AS mode, 'success' AS status,
       CAST(count(*) AS BIGINT) AS rows_in, CAST(count(*) AS BIGINT) AS rows_out FROM customer
UNION ALL SELECT 'orders', 'incremental', 'success', CAST(count(*) AS BIGINT),
       CAST(count(*) AS BIGINT) FROM orders
UNION ALL SELECT 'part', 'full-refresh', 'success', CAST(count(*) AS BIGINT),
       CAST(count(*) AS BIGINT) FROM part WHERE p_size > 25"""


@scenario("replication_report", REPORT)
def replication_report(spark, sf_dir):
    run, _ = replication(spark, sf_dir)
    return report_rows(run.run())


@scenario("replication_defaults", """
SELECT p_partkey, p_size FROM part WHERE p_size > 25""")
def replication_defaults(spark, sf_dir):
    """The stream's own select and where, the object and mode of the defaults."""
    run, target = replication(spark, sf_dir)
    run.run(streams=[path(sf_dir, "part")])
    return spark.read.parquet(f"{target}/part.parquet")


@scenario("replication_subset", REPORT.split("UNION ALL SELECT 'part'")[0])
def replication_subset(spark, sf_dir):
    """Streams chosen by tag."""
    run, _ = replication(spark, sf_dir)
    return report_rows(run.run(tags=["core"]))


@scenario("object_template", """
SELECT 'main_nation' AS object, CAST(count(*) AS BIGINT) AS n_rows FROM nation
UNION ALL SELECT 'main_region', CAST(count(*) AS BIGINT) FROM region""")
def object_template(spark, sf_dir):
    """``{stream_schema}_{stream_table}`` names the target tables."""
    source, target = create_database(spark, "src"), create_database(spark, "tgt")
    for table in ("nation", "region"):
        read(spark, sf_dir, table).write.saveAsTable(f"{source}.{table}")
    report = Replication(source="SPARK", target="SPARK", spark=spark,
                         defaults={"object": target + ".{stream_schema}_{stream_table}"},
                         streams={f"{source}.nation": {}, f"{source}.region": {}}).run()
    short = F.expr(f"replace(split_part(object, '.', 2), '{source}', 'main')")
    return report.select(short.alias("object"), F.col("rows_out").alias("n_rows"))


# -- steps -----------------------------------------------------------------------------


@scenario("step_query_into", """
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n_customers FROM customer
WHERE c_acctbal > 500 GROUP BY c_mktsegment""")
def step_query_into(spark, sf_dir):
    read(spark, sf_dir, "customer").createOrReplaceTempView("customer_rows")
    runner = StepRunner(spark, {"least": 500})
    runner.run(StepQuery("SPARK", "SELECT c_mktsegment, count(*) AS n_customers FROM customer_rows "
                                  "WHERE c_acctbal > :least GROUP BY c_mktsegment",
                         into="segment_counts"))
    return spark.table("segment_counts")


@scenario("step_check", """
SELECT 'has_rows' AS check_name, count(*) > 0 AS passed FROM orders
UNION ALL SELECT 'key_not_null', count(*) = count(o_orderkey) FROM orders
UNION ALL SELECT 'key_unique', count(*) = count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'known_status', bool_and(o_orderstatus IN ('F', 'O', 'P')) FROM orders
UNION ALL SELECT 'cheap_orders_only', bool_and(o_totalprice < 1000) FROM orders""")
def step_check(spark, sf_dir):
    """Every check of a table from one scan."""
    return run_checks(read(spark, sf_dir, "orders"), {
        "has_rows": "count(*) > 0",
        "key_not_null": "count(*) = count(o_orderkey)",
        "key_unique": "count(*) = count(distinct o_orderkey)",
        "known_status": "bool_and(o_orderstatus in ('F', 'O', 'P'))",
        "cheap_orders_only": "bool_and(o_totalprice < 1000)",
    })


@scenario("step_list_files", """
SELECT CAST(count(DISTINCT o_orderstatus) AS BIGINT) AS n_folders, TRUE AS all_have_bytes
FROM orders""")
def step_list_files(spark, sf_dir):
    """Files of a partitioned dataset, found below its folders."""
    folder = scratch_path(spark, "files")
    write_files(read(spark, sf_dir, "orders"), folder, "parquet", partition_by=["o_orderstatus"])
    files = list_files(spark, folder, recursive=True, only="*.parquet")
    parent = F.element_at(F.split("path", "/"), -2)
    return files.agg(F.count_distinct(parent).alias("n_folders"),
                     F.bool_and(F.col("length") > 0).alias("all_have_bytes"))


@scenario("step_copy_dataset", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer""")
def step_copy_dataset(spark, sf_dir):
    """parquet -> csv -> parquet by two copy steps."""
    folder = scratch_path(spark, "copy")
    copy_dataset(spark, path(sf_dir, "customer"), f"{folder}/customer.csv")
    copy_dataset(spark, f"{folder}/customer.csv", f"{folder}/again.parquet")
    return spark.read.parquet(f"{folder}/again.parquet")


@scenario("step_replication", """
SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
  AND o_orderdate < TIMESTAMP '1999-01-01'""")
def step_replication(spark, sf_dir):
    """A replication file run as a step, with mode and range overridden."""
    folder = scratch_path(spark, "stepped")
    target = f"{folder}/orders.parquet"
    document = {"source": "LOCAL", "target": "LOCAL", "streams": {
        path(sf_dir, "orders"): {"object": target, "primary_key": ["o_orderkey"],
                                 "update_key": "o_orderdate"}}}
    ClusterFiles(spark).create_text(f"{folder}/run.yaml", yaml.safe_dump(document))
    StepRunner(spark).run(StepReplication("run.yaml", working_dir=folder, mode="backfill",
                                          range_param="1998-01-01..1998-12-31"))
    return VersionedDataset(spark, target).read()


@scenario("step_group_fanout", """
SELECT r_regionkey AS loop_value, CAST(count(*) AS BIGINT) AS n_nations
FROM region LEFT JOIN nation ON n_regionkey = r_regionkey WHERE r_regionkey BETWEEN 1 AND 3
GROUP BY r_regionkey""")
def step_group_fanout(spark, sf_dir):
    """One table step per value of ``1..3``, stacked with the value."""
    nations = read(spark, sf_dir, "nation")
    return fan_out(loop_values({"range": "1..3"}), lambda value: nations.where(
        F.col("n_regionkey") == value).agg(F.count(F.lit(1)).alias("n_nations")))


@scenario("hooks_order", """
SELECT 'start' AS moment, CAST(0 AS BIGINT) AS n_rows
UNION ALL SELECT 'pre', 0
UNION ALL SELECT 'pre_merge', 0
UNION ALL SELECT 'post_merge', CAST(count(*) AS BIGINT) FROM supplier
UNION ALL SELECT 'post', CAST(count(*) AS BIGINT) FROM supplier
UNION ALL SELECT 'end', CAST(count(*) AS BIGINT) FROM supplier""")
def hooks_order(spark, sf_dir):
    """Each hook records how many rows the target holds when it runs."""
    database = create_database(spark, "hooks")
    spark.sql(f"CREATE TABLE {database}.seen (moment STRING, n_rows BIGINT) USING parquet")
    empty = read(spark, sf_dir, "supplier").where("s_suppkey < 0")
    empty.write.saveAsTable(f"{database}.supplier")

    def record(moment):
        return [StepQuery("SPARK", f"INSERT INTO {database}.seen SELECT '{moment}', count(*) "
                                   f"FROM {database}.supplier")]

    stream_hooks = HookMap(pre=record("pre"), post=record("post"), pre_merge=record("pre_merge"),
                           post_merge=record("post_merge"))
    Replication(source="LOCAL", target="SPARK", spark=spark,
                hooks=HookMap(start=record("start"), end=record("end")),
                streams={path(sf_dir, "supplier"): {
                    "object": f"{database}.supplier", "mode": "incremental",
                    "primary_key": "s_suppkey", "hooks": stream_hooks}}).run()
    return spark.table(f"{database}.seen")


@scenario("steps_report", """
SELECT 1 AS step, 'fill' AS id, 'query' AS type, 'success' AS status
UNION ALL SELECT 2, 'enough', 'check', CASE WHEN count(*) > 10 THEN 'success' ELSE 'error' END
  FROM customer
UNION ALL SELECT 3, 'all_rich', 'check', CASE WHEN min(c_acctbal) > 0 THEN 'success' ELSE 'error' END
  FROM customer
UNION ALL SELECT 4, 'group', 'group', 'success'
UNION ALL SELECT 5, 'each', 'query', 'success'
UNION ALL SELECT 6, 'each', 'query', 'success'
UNION ALL SELECT 7, 'only_if_rich', 'query',
       CASE WHEN min(c_acctbal) > 0 THEN 'success' ELSE 'skipped' END FROM customer""")
def steps_report(spark, sf_dir):
    """Ordered steps: a tolerated failure, a loop and a condition."""
    read(spark, sf_dir, "customer").createOrReplaceTempView("customer_rows")
    each = StepQuery("SPARK", "SELECT * FROM customer_rows WHERE c_nationkey = :loop_value",
                     into="one_nation", id="each")
    return Pipeline(spark=spark, steps=[
        StepQuery("SPARK", "SELECT count(*) AS n, min(c_acctbal) AS least FROM customer_rows",
                  into="facts", id="fill"),
        StepCheck("n > :least_rows", vars={"least_rows": 10, "table": "facts"}, id="enough"),
        StepCheck("least > 0", vars={"table": "facts"}, on_failure="warn", id="all_rich"),
        StepGroup([each], loop=[1, 2], id="group"),
        StepQuery("SPARK", "SELECT 1", id="only_if_rich", if_condition="steps.all_rich.success"),
    ]).run().select("step", "id", "type", "status")


# -- streaming -------------------------------------------------------------------------


@scenario("stream_new_files", "SELECT * FROM events")
def stream_new_files(spark, sf_dir):
    """Two bounded runs; the second takes only the file added in between."""
    folder = scratch_path(spark, "stream")
    events = read(spark, sf_dir, "events")
    inbox, target, checkpoint = (f"{folder}/{n}" for n in ("inbox", "target", "checkpoint"))
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (events.where(early), events.where(~early)):
        part.write.mode("append").parquet(inbox)
        loads.load_new_files(loads.file_stream(spark, inbox, events.schema), target, checkpoint)
    return spark.read.parquet(target)


@scenario("stream_upsert", """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'X' ELSE o_orderstatus END
         AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders""")
def stream_upsert(spark, sf_dir):
    folder = scratch_path(spark, "upsert")
    target = VersionedDataset(spark, f"{folder}/target")
    schema = read(spark, sf_dir, "orders").schema
    for part in (loaded_orders(spark, sf_dir), changed_orders(spark, sf_dir)):
        part.write.mode("append").parquet(f"{folder}/inbox")
        stream = loads.file_stream(spark, f"{folder}/inbox", schema)
        loads.upsert_stream(stream, target, "o_orderkey", f"{folder}/checkpoint")
    return target.read()


@scenario("stream_dedupe", "SELECT * FROM orders")
def stream_dedupe(spark, sf_dir):
    """Orders delivered twice are kept once."""
    folder = scratch_path(spark, "dedupe")
    orders = read(spark, sf_dir, "orders")
    orders.unionByName(orders).write.parquet(f"{folder}/inbox")
    stream = loads.file_stream(spark, f"{folder}/inbox", orders.schema)
    unique = loads.dedupe_stream(stream, "o_orderkey", "o_orderdate", "3650 days")
    loads.load_new_files(unique, f"{folder}/target", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/target")
