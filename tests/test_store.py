"""The versioned dataset: races, partition values, streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ferryline.errors import TransferError
from ferryline.operators.merge import merge
from ferryline.plans.targets import CatalogTable, VersionedDataset
from ferryline.streaming.loads import file_stream, upsert_stream

from conftest import rows


def upsert(target, batch, key="k"):
    target.merge_in(batch, [key], lambda held: merge(held, batch, [key], "update_insert"))


def test_a_commit_in_the_middle_of_a_merge_is_not_lost(spark, scratch):
    target = VersionedDataset(spark, scratch)
    target.replace(spark.createDataFrame([(1, "a")], "k long, v string"))
    other = VersionedDataset(spark, scratch)
    batch = spark.createDataFrame([(1, "b")], "k long, v string")

    def slow(held):
        other.append(spark.createDataFrame([(2, "c")], "k long, v string"))
        return merge(held, batch, ["k"], "update_insert")

    with pytest.raises(TransferError, match="version 2"):
        target.merge_in(batch, ["k"], slow)
    assert rows(VersionedDataset(spark, scratch).read()) == [(1, "a"), (2, "c")]
    upsert(VersionedDataset(spark, scratch), batch)
    assert rows(VersionedDataset(spark, scratch).read()) == [(1, "b"), (2, "c")]


def test_appends_side_by_side_both_count(spark, scratch):
    target = VersionedDataset(spark, scratch)
    target.replace(spark.createDataFrame([(1,)], "k long"), {"mark": "1", "stream_batch:q": 4})
    real, first = target._write_folder, [True]

    def late(df, version):
        if first.pop() if first else False:
            VersionedDataset(spark, scratch).append(spark.createDataFrame([(2,)], "k long"))
        return real(df, version)

    target._write_folder = late
    target.append(spark.createDataFrame([(3,)], "k long"), {"mark": "3"})
    assert rows(VersionedDataset(spark, scratch).read()) == [(1,), (2,), (3,)]
    assert target.state() == {"mark": "3", "stream_batch:q": 4}
    target.replace(spark.createDataFrame([(9,)], "k long"))
    assert target.state() == {"stream_batch:q": 4}


@pytest.mark.parametrize("kind, old, new", [
    ("date", dt.date(2024, 1, 5), dt.date(2024, 1, 6)),
    ("timestamp_ntz", dt.datetime(2024, 1, 5, 1, 2, 3, 500000), dt.datetime(2024, 1, 5)),
    ("double", 1e10, 0.1), ("float", 2.5, 1e-5), ("string", "it's a=b/c%", None),
    ("string", None, "x"), ("boolean", True, False), ("decimal(9,3)", None, None)])
def test_partitions_are_found_by_value(spark, scratch, kind, old, new):
    schema = f"k long, p {kind}, v string"
    target = VersionedDataset(spark, scratch, partition_by=["p"])
    target.replace(spark.createDataFrame([(1, old, "a"), (2, old, "b")], schema))
    upsert(target, spark.createDataFrame([(1, new, "c")], schema))
    upsert(target, spark.createDataFrame([(2, old, "d")], schema))
    found = {r["k"]: (r["p"], r["v"]) for r in target.read().collect()}
    held = spark.createDataFrame([(1, new, "c"), (2, old, "d")], schema).collect()
    assert target.read().count() == 2
    assert found == {r["k"]: (r["p"], r["v"]) for r in held}


@pytest.mark.parametrize("old", [None, "it's", "a=b"])
def test_table_partitions_do_not_keep_moved_rows(spark, old):
    spark.sql("DROP TABLE IF EXISTS moved_rows")
    spark.createDataFrame([(1, "a", old), (2, "b", "z")], "k long, v string, p string") \
        .write.partitionBy("p").saveAsTable("moved_rows")
    batch = spark.createDataFrame([(1, "c", "z")], "k long, v string, p string")
    upsert(CatalogTable(spark, "moved_rows"), batch)
    assert sorted(tuple(r) for r in spark.table("moved_rows").collect()) == [
        (1, "c", "z"), (2, "b", "z")]
    spark.sql("DROP TABLE moved_rows")


def test_every_stream_counts_its_own_batches(spark, scratch):
    schema = "k long, v string"
    target = VersionedDataset(spark, f"{scratch}/target")
    for name, k in (("one", 1), ("two", 2)):
        spark.createDataFrame([(k, name)], schema).write.parquet(f"{scratch}/{name}")
    for name, checkpoint in (("one", "c1"), ("two", "c2"), ("one", "c3")):
        stream = file_stream(spark, f"{scratch}/{name}", spark.createDataFrame([], schema).schema)
        upsert_stream(stream, target, "k", f"{scratch}/{checkpoint}")
    assert rows(target.read()) == [(1, "one"), (2, "two")]
    assert len([k for k in target.state() if k.startswith("stream_batch:")]) == 3
