"""Page cut-offs on nested record paths, and the record limit after deduplication."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.plans import extract
from ferryline.plans.apispec import Records
from ferryline.plans.targets import stage

ID = T.StructType([T.StructField("id", T.LongType())])


def test_short_page_on_a_nested_path(spark):
    def body(*groups):
        return json.dumps({"data": [{"items": [{"id": i} for i in g]} for g in groups]})

    pages = [body([1, 2], [3]), body([4], [5, 6]), body([7]), body([8, 9, 10])]
    frame = spark.createDataFrame([("e", k, 200, b) for k, b in enumerate(pages)]
                                  + [("broken", 0, 200, "{"), ("broken", 1, 200, pages[0])],
                                  "endpoint string, page int, status int, body string")
    for schema in (None, ID):
        kept = extract.stop_at_short_page(frame, "data[].items[]", 3, schema)
        assert sorted((r["endpoint"], r["page"]) for r in kept.collect()) == [
            ("broken", 0), ("e", 0), ("e", 1), ("e", 2)]


def test_limit_counts_distinct_records(spark):
    rows = [("e", 0, 0, 1, "a"), ("e", 0, 1, 1, "a"), ("e", 0, 2, 2, "b"), ("e", 1, 0, 3, "c"),
            ("e", 1, 1, 1, "a")]
    frame = spark.createDataFrame(
        rows, "endpoint string, page int, pos int, recordId long, name string")
    found = extract.shape_records(frame, Records(
        primary_key=["record_id"], casing="snake", select=["record_id", "upper(name) as name"],
        limit=2))
    assert found.columns == ["record_id", "name"]
    assert {tuple(r) for r in found.collect()} == {(1, "A"), (2, "B")}


def test_pages_of_one_endpoint_stay_in_many_tasks(spark):
    """Whether nothing, something or all is cut, one endpoint's pages are not
    brought together in one task to be cut."""
    pages = stage(spark.range(4000).repartition(8).select(
        F.lit("e").alias("endpoint"), F.col("id").alias("page"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 20).alias("body")), "pages")
    kept_conf = {"spark.sql.autoBroadcastJoinThreshold": "100000",
                 "spark.sql.files.maxPartitionBytes": "100000"}
    before = {k: spark.conf.get(k) for k in kept_conf}
    try:
        for k, v in kept_conf.items():
            spark.conf.set(k, v)
        for at, most, n in (("page < 0", False, 4000), ("page = 3000", True, 3001),
                            ("page >= 0", False, 0)):
            kept = extract.cut_pages(pages, F.expr(at), inclusive=most).withColumn(
                "task", F.spark_partition_id())
            found = kept.agg(F.count("page"), F.max("page"), F.count_distinct("task")).first()
            assert found[0] == n and found[1] == (n - 1 if n else None)
            tasks = kept.rdd.glom().map(len).collect() if n else []
            assert not n or max(tasks) < n
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
