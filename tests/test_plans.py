"""The physical plans the operators must have to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from ferryline import CatalogTable, LoadSpec, TargetOptions, VersionedDataset, load
from ferryline.operators.merge import dedupe_latest, merge
from ferryline.operators.shape import range_filter
from ferryline.plans.modes import high_water
from scenarios.base import changed_orders, create_database, loaded_orders, read


def short(target) -> list[str]:
    """Folders of the newest commit, without the suffix of their version."""
    return [re.sub(r"^(_version=\d+)-\w+", r"\1", f) for f in target.latest()["folders"]]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Joins beyond the broadcast size, with a low bar for skew."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_scan_gets_filter_and_columns(spark, sf_dir):
    found = plan(range_filter(read(spark, sf_dir, "orders"), "o_orderdate",
                              "1997-01-01..1997-12-31").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in found
    assert "LessThan(o_orderdate,1998-01-01" in found
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in found


def test_high_water_mark_reaches_the_scan(spark, sf_dir, scratch):
    target = VersionedDataset(spark, scratch)
    load(loaded_orders(spark, sf_dir), target, LoadSpec(update_key="o_orderdate"))
    orders = read(spark, sf_dir, "orders")
    mark = high_water(target, "o_orderdate", orders.schema["o_orderdate"].dataType)
    found = plan(orders.where(F.col("o_orderdate") > mark))
    assert "GreaterThan(o_orderdate,1999-12-" in found


def test_dedupe_limits_each_key_before_the_shuffle(spark, sf_dir):
    found = plan(dedupe_latest(read(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_shipdate"))
    assert "WindowGroupLimit" in found and "Partial" in found
    assert found.index("Final") < found.index("Exchange") < found.index("Partial")


def test_small_source_never_shuffles_the_target(spark, sf_dir):
    found = plan(merge(loaded_orders(spark, sf_dir), changed_orders(spark, sf_dir), "o_orderkey",
                       check_unique=False))
    assert "BroadcastHashJoin" in found and "SortMergeJoin" not in found


@pytest.mark.parametrize("strategy", ["update_insert", "delete_insert", "update"])
def test_hot_target_key_is_split(spark, sf_dir, no_broadcast, strategy):
    """A third of the target rows share one key."""
    lines = read(spark, sf_dir, "lineitem").withColumn(
        "l_orderkey", F.expr("if(l_partkey % 3 = 0, 7L, l_orderkey)")).repartition(8)
    source = read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS l_orderkey", "'X' AS l_returnflag")
    result = merge(lines, source, "l_orderkey", strategy, check_unique=False)
    total = result.agg(F.sum(F.hash(*result.columns)))
    total.collect()
    final = plan(total).split("Initial Plan")[0]
    assert "skew=true" in final
    assert "Cartesian" not in final and "NestedLoop" not in final


def test_merge_rewrites_touched_partitions_only(spark, sf_dir, scratch):
    target = VersionedDataset(spark, scratch, ["o_year"])
    year = F.year("o_orderdate")
    load(read(spark, sf_dir, "orders").withColumn("o_year", year), target, LoadSpec())
    source = changed_orders(spark, sf_dir).where("o_orderdate < timestamp_ntz'2000-01-01'")
    load(source.withColumn("o_year", year), target, LoadSpec(
        mode="incremental", primary_key="o_orderkey"))
    folders = short(target)
    assert [f for f in folders if f.startswith("_version=2")] == ["_version=2/o_year=1999"]
    assert len(folders) == len({f.split("/")[1] for f in folders})


def test_rows_moving_between_partitions(spark, scratch):
    target = VersionedDataset(spark, scratch, ["p"])
    load(spark.createDataFrame([(1, "a", "old"), (2, "b", "old"), (3, "c", "old")],
                               "k int, p string, v string"), target, LoadSpec())
    load(spark.createDataFrame([(1, "b", "new"), (4, "d", "new")], "k int, p string, v string"),
         target, LoadSpec(mode="incremental", primary_key="k"))
    found = sorted(tuple(r) for r in target.read().select("k", "p", "v").collect())
    assert found == [(1, "b", "new"), (2, "b", "old"), (3, "c", "old"), (4, "d", "new")]
    assert "_version=1/p=c" in short(target)


def test_partitioned_writes_are_rebalanced(spark, sf_dir, scratch):
    orders = read(spark, sf_dir, "orders").repartition(8)
    load(orders, VersionedDataset(spark, scratch, ["o_orderstatus"]), LoadSpec())
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet").load(scratch)
    assert files.count() <= 4 * 3


def test_table_merge_rewrites_touched_partitions_only(spark, sf_dir):
    name = f"{create_database(spark, 'parts')}.t"
    target = CatalogTable(spark, name, TargetOptions(table_keys={"partition": ["p"]}))
    load(spark.createDataFrame([(1, "old", "a"), (2, "old", "b"), (3, "old", "c")],
                               "k int, v string, p string"), target, LoadSpec())

    def files(part):
        return {r[0] for r in spark.table(name).where(f"p = '{part}'").select(
            "_metadata.file_name").distinct().collect()}

    before = files("c")
    load(spark.createDataFrame([(1, "new", "b"), (4, "new", "d")], "k int, v string, p string"),
         target, LoadSpec(mode="incremental", primary_key="k"))
    found = sorted(tuple(r) for r in target.read().select("k", "v", "p").collect())
    assert found == [(1, "new", "b"), (2, "old", "b"), (3, "old", "c"), (4, "new", "d")]
    assert files("c") == before
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["p=b", "p=c", "p=d"]


def test_key_holding_the_partition_needs_no_target_scan(spark, scratch):
    target = VersionedDataset(spark, scratch, ["p"])
    load(spark.createDataFrame([(1, "a", "old"), (1, "b", "old")], "k int, p string, v string"),
         target, LoadSpec())
    load(spark.createDataFrame([(1, "a", "new")], "k int, p string, v string"), target,
         LoadSpec(mode="incremental", primary_key="k,p"))
    assert short(target) == ["_version=1/p=b", "_version=2/p=a"]


def test_partition_names_are_escaped(spark, scratch):
    target = VersionedDataset(spark, scratch, ["p"])
    load(spark.createDataFrame([(1, "a/b: c", "old"), (2, None, "old")],
                               "k int, p string, v string"), target, LoadSpec())
    load(spark.createDataFrame([(1, "a/b: c", "new"), (3, None, "new")],
                               "k int, p string, v string"),
         target, LoadSpec(mode="incremental", primary_key="k"))
    found = sorted((r["k"], r["p"], r["v"]) for r in target.read().collect())
    assert found == [(1, "a/b: c", "new"), (2, None, "old"), (3, None, "new")]


def test_hashed_folders_bound_a_merge_by_its_keys(spark, sf_dir, scratch):
    """No natural partition: the key's hash names the folders to rewrite."""
    orders = read(spark, sf_dir, "orders")
    target = VersionedDataset(spark, scratch, bucket_by=["o_orderkey"], buckets=16)
    load(orders, target, LoadSpec())
    assert target.read().columns == orders.columns and target.read().count() == orders.count()
    source = orders.where("o_orderkey in (3, 4)").withColumn("o_orderstatus", F.lit("X"))
    source = source.withColumn("o_orderkey", F.col("o_orderkey").cast("int"))
    again = VersionedDataset(spark, scratch)  # the layout is part of the commit
    load(source, again, LoadSpec(mode="incremental", primary_key="o_orderkey"))
    rewritten = [f for f in short(again) if f.startswith("_version=2/")]
    assert 1 <= len(rewritten) <= 2 and len(short(again)) == 16
    assert again.read().count() == orders.count()
    assert {r[0] for r in again.read().where("o_orderstatus = 'X'").select("o_orderkey").collect()
            } == {3, 4}


def test_whole_stored_sources_are_not_copied(spark, sf_dir, scratch, monkeypatch):
    from ferryline import Transfer
    from ferryline.plans import modes

    staged, real = [], modes.stage
    monkeypatch.setattr(modes, "stage", lambda *a: staged.append(a) or real(*a))
    run = {"src_stream": f"{sf_dir}/orders.parquet", "tgt_object": scratch + ".parquet",
           "mode": "incremental", "primary_key": "o_orderkey", "spark": spark}
    assert Transfer(**run).run().rows_out == Transfer(**run).run().rows_in
    assert staged == []
    Transfer(**run, where="o_orderkey < 10").run()
    assert len(staged) == 1


@pytest.mark.parametrize("options, most", [
    ({}, 5), ({"strategy": "delete_insert"}, 3), ({"strategy": "update"}, 2),
    ({"delete_missing": True}, 2)])
def test_merges_scan_each_side_few_times(spark, sf_dir, options, most):
    target = loaded_orders(spark, sf_dir).withColumn("note", F.lit("kept"))
    found = plan(merge(target, changed_orders(spark, sf_dir), "o_orderkey", check_unique=False,
                       **options))
    assert found.split("Initial Plan")[0].count("FileScan") <= most


@pytest.mark.parametrize("strategy", ["update_insert", "delete_insert", "update"])
def test_null_keys_are_spread(spark, sf_dir, no_broadcast, strategy):
    lines = read(spark, sf_dir, "lineitem").withColumn(
        "l_orderkey", F.expr("if(l_partkey % 2 = 0, null, l_orderkey)"))
    source = read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS l_orderkey", "'X' AS l_returnflag")
    result = merge(lines, source, "l_orderkey", strategy, check_unique=False)
    nulls = lines.where("l_orderkey IS NULL").count()
    parts = result.where("l_orderkey IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == nulls
