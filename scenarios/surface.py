"""In-memory input, rows handed back to Python, and options of loads and runs."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from ferryline import Connection, Pipeline, Replication, Transfer
from ferryline.session import scratch_path

from .base import path, read, scenario

CUSTOMER = "SELECT * FROM customer"
NATION = """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name,
                   CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation"""


def loaded(spark, label, **arguments):
    """What a transfer leaves at its target."""
    target = f"{scratch_path(spark, label)}.parquet"
    Transfer(tgt_object=target, spark=spark, **arguments).run()
    return Transfer(src_stream=target, spark=spark).dataframe()


@scenario("input_rows", NATION)
def input_rows(spark, sf_dir):
    """A list of dicts and a generator give the same table."""
    rows = [r.asDict() for r in read(spark, sf_dir, "nation").collect()]
    return loaded(spark, "rows", input=rows[:10]).union(
        loaded(spark, "more", input=(r for r in rows[10:])))


@scenario("input_frames", """
SELECT c_custkey, c_name, c_acctbal FROM customer""")
def input_frames(spark, sf_dir):
    """Arrow and pandas tables as input."""
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    table = customers.where("c_custkey % 2 = 0").toArrow()
    frame = customers.where("c_custkey % 2 = 1").toPandas()
    return loaded(spark, "arrow", input=table).union(loaded(spark, "pandas", input=frame))


@scenario("select_unknown", """
SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name FROM nation""")
def select_unknown(spark, sf_dir):
    """Names that in-memory input lacks are left out of a select."""
    rows = [r.asDict() for r in read(spark, sf_dir, "nation").collect()]
    return loaded(spark, "some", input=rows, select="n_nationkey, n_name, no_such_column")


@scenario("stream_rows", NATION)
def stream_rows(spark, sf_dir):
    """Rows as dicts, one partition at a time."""
    rows = list(Transfer(src_stream=path(sf_dir, "nation"), spark=spark).stream())
    return spark.createDataFrame(rows, "n_nationkey long, n_name string, n_regionkey long")


@scenario("stream_batches", CUSTOMER)
def stream_batches(spark, sf_dir):
    """Arrow batches with their types."""
    with Transfer(src_stream=path(sf_dir, "customer"), spark=spark).stream_arrow(500) as reader:
        return spark.createDataFrame(pa.Table.from_batches(reader, reader.schema))


@scenario("exec_frames", """
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n, 'dataframe' AS kind FROM customer GROUP BY ALL
UNION ALL SELECT c_mktsegment, CAST(count(*) AS BIGINT), 'arrow' FROM customer GROUP BY ALL""")
def exec_frames(spark, sf_dir):
    """One query as pandas and as Arrow."""
    read(spark, sf_dir, "customer").createOrReplaceTempView("surface_customer")
    sql = "SELECT c_mktsegment, count(*) AS n FROM surface_customer GROUP BY c_mktsegment"
    kinds = {kind: Connection("SPARK", spark).exec(sql, kind, limit=0)
             for kind in ("dataframe", "arrow")}
    first, second = (spark.createDataFrame(found).withColumn("kind", F.lit(kind))
                     for kind, found in kinds.items())
    return first.unionByName(second)


@scenario("sink_concurrency", """
SELECT 3 AS n_files, CAST(count(*) AS BIGINT) AS n_rows FROM customer""")
def sink_concurrency(spark, sf_dir):
    """As many files as tasks were asked for."""
    target = f"{scratch_path(spark, 'parts')}.csv"
    Transfer(src_stream=path(sf_dir, "customer"), tgt_object=target, spark=spark,
             tgt_options={"concurrency": 3}).run()
    rows = Transfer(src_stream=target, spark=spark).dataframe().withColumn(
        "file", F.col("_metadata.file_path"))
    return rows.agg(F.count_distinct("file").cast("int").alias("n_files"),
                    F.count(F.lit(1)).alias("n_rows"))


@scenario("table_tmp_load", CUSTOMER)
def table_tmp_load(spark, sf_dir):
    """A load through a staging place of its own, which keeps the rows."""
    place = scratch_path(spark, "staging")
    loaded(spark, "staged", src_stream=path(sf_dir, "customer"), tgt_options={"table_tmp": place})
    return spark.read.parquet(place)


@scenario("replication_edits", """
SELECT 'nation' AS stream, 'truncate' AS mode, CAST(count(*) AS BIGINT) AS rows_in FROM nation
UNION ALL SELECT 'region', 'truncate', CAST(count(*) AS BIGINT) FROM region""")
def replication_edits(spark, sf_dir):
    """Streams added, disabled and enabled, and the default mode changed."""
    target = scratch_path(spark, "edits")
    run = Replication(spark=spark, concurrency=2, streams={path(sf_dir, "nation"): {},
                                                           path(sf_dir, "customer"): {}},
                      defaults={"object": target + "/{stream_table}.parquet"})
    run.add_streams({path(sf_dir, "region"): {"disabled": True}})
    run.disable_streams([path(sf_dir, "customer")])
    run.enable_streams([path(sf_dir, "region")])
    run.set_default_mode("truncate")
    name = F.element_at(F.split("stream", "/"), -1)
    return run.run().select(F.replace(name, F.lit(".parquet"), F.lit("")).alias("stream"), "mode",
                            "rows_in")


@scenario("steps_conditions", """
SELECT CASE WHEN count(*) > 0 THEN 'error,skipped,success' END AS statuses FROM nation""")
def steps_conditions(spark, sf_dir):
    """A failing step that may fail, a step whose condition does not hold, and one
    whose condition asks for the first one's status."""
    read(spark, sf_dir, "nation").createOrReplaceTempView("surface_nation")
    report = Pipeline(spark=spark, steps=[
        {"type": "query", "id": "first", "connection": "SPARK", "on_failure": "warn",
         "query": "SELECT no_such_column FROM surface_nation"},
        {"type": "query", "id": "second", "connection": "SPARK", "if": "steps.first.success",
         "query": "SELECT n_name FROM surface_nation", "into": "never"},
        {"type": "query", "id": "third", "connection": "SPARK",
         "if": "steps.first.status = 'error'", "query": "SELECT n_name FROM surface_nation",
         "into": "names"}]).run()
    return report.agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("step", "status"))), lambda x: x["status"]), ",").alias("statuses"))
