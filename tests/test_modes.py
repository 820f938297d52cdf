"""Load modes, versions and their errors."""

import pytest
from pyspark.sql import functions as F

from ferryline import (
    CatalogTable, FileTarget, LoadSpec, TargetOptions, TransferError, VersionedDataset, load)
from ferryline.plans.modes import chunk_bounds
from ferryline.plans.targets import stage
from scenarios.base import create_database
from tests.conftest import rows

def kv(df):
    return sorted((r["k"], r["v"]) for r in df.collect())


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k bigint, v string, d string").withColumn(
        "d", F.to_date("d"))


@pytest.fixture()
def dataset(spark, scratch):
    target = VersionedDataset(spark, scratch)
    load(frame(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-02")), target,
         LoadSpec(update_key="d"))
    return target


def test_full_refresh_takes_the_source_schema(spark, dataset):
    load(spark.createDataFrame([(9,)], "other int"), dataset, LoadSpec())
    assert dataset.read().columns == ["other"]


def test_truncate_keeps_the_target_schema(spark, dataset):
    load(spark.createDataFrame([(9,)], "k int"), dataset, LoadSpec(mode="truncate"))
    assert rows(dataset.read()) == [(None, 9, None)]
    assert dataset.read().schema["k"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError, match="extra"):
        load(spark.createDataFrame([(9, 1)], "k int, extra int"), dataset,
             LoadSpec(mode="truncate"))


def test_incremental_is_strictly_above_the_mark(spark, dataset):
    source = frame(spark, (2, "late", "2024-01-02"), (1, "new", "2024-01-03"),
                   (3, "c", "2024-01-03"))
    spec = LoadSpec(mode="incremental", primary_key="k", update_key="d")
    report = load(source, dataset, spec)
    assert (report.rows_in, report.rows_out) == (2, 3)
    assert kv(dataset.read()) == [(1, "new"), (2, "b"), (3, "c")]
    assert dataset.state()["high_water"] == "2024-01-03"
    version = dataset.versions()[-1]
    assert load(source, dataset, spec).rows_in == 0
    assert dataset.versions()[-1] == version


def test_insert_strategy_appends_only(spark, dataset):
    source = frame(spark, (2, "changed", "2024-01-05"), (3, "c", "2024-01-05"))
    load(source, dataset, LoadSpec(mode="incremental", primary_key="k", strategy="insert"))
    assert [f.split("-")[0] for f in dataset.latest()["folders"]] == ["_version=1", "_version=2"]
    assert kv(dataset.read()) == [(1, "a"), (2, "b"), (3, "c")]


def test_new_and_widened_columns(spark, dataset):
    source = spark.createDataFrame([(2.5, "b", 7)], "k double, v string, extra int")
    spec = LoadSpec(mode="incremental", primary_key="k")
    with pytest.raises(ValueError, match="extra"):
        load(source, dataset, spec)
    load(source, dataset, LoadSpec(mode="incremental", primary_key="k", add_new_columns=True,
                                   adjust_column_type=True))
    found = dataset.read()
    assert found.schema["k"].dataType.simpleString() == "double"
    assert sorted(r["k"] for r in found.collect()) == [1.0, 2.0, 2.5]
    assert found.where("k = 2.5").first()["extra"] == 7


def test_backfill_keeps_the_mark_and_needs_its_arguments(spark, dataset):
    source = frame(spark, (1, "redo", "2023-12-31"), (5, "old", "2023-12-31"))
    load(source, dataset, LoadSpec(mode="backfill", primary_key="k", update_key="d",
                                   range="2023-12-01..2023-12-31"))
    assert dataset.state()["high_water"] == "2024-01-02"
    assert kv(dataset.read()) == [(1, "redo"), (2, "b"), (5, "old")]
    with pytest.raises(TransferError, match="range"):
        load(source, dataset, LoadSpec(mode="backfill", primary_key="k", update_key="d"))
    with pytest.raises(ValueError, match="start..end"):
        load(source, dataset, LoadSpec(mode="backfill", primary_key="k", update_key="d",
                                       range="2023-12-01"))


def test_delete_missing_needs_the_full_source(spark, dataset):
    source = frame(spark, (1, "only", "2024-01-09"))
    with pytest.raises(TransferError, match="full source"):
        load(source, dataset, LoadSpec(mode="incremental", primary_key="k", update_key="d",
                                       delete_missing=True))
    load(source, dataset, LoadSpec(mode="incremental", primary_key="k", delete_missing=True))
    assert kv(dataset.read()) == [(1, "only")]


def test_incremental_needs_a_key(spark, dataset):
    with pytest.raises(TransferError, match="primary_key"):
        load(dataset.read(), dataset, LoadSpec(mode="incremental"))


def test_chunks_cover_the_range_once(spark):
    source = frame(spark, (1, "a", "2024-01-01"))
    spec = LoadSpec(update_key="d", range="2024-01-31..2024-04-15", chunk_size="1m")
    bounds = chunk_bounds(source, spec)
    assert bounds[0][0] == "2024-01-31" and bounds[-1][1:] == ("2024-04-15", True)
    assert all(a[1] == b[0] for a, b in zip(bounds, bounds[1:]))
    by_key = chunk_bounds(source, LoadSpec(update_key="k", range="1..10", chunk_size=4))
    assert by_key == [("1", "5", False), ("5", "9", False), ("9", "10", True)]
    for bad in ("0", "x", "3q"):
        with pytest.raises(ValueError):
            chunk_bounds(source, LoadSpec(update_key="d", range="2024-01-01..2024-02-01",
                                          chunk_size=bad))


def test_failed_load_leaves_the_table(spark, dataset):
    bad = frame(spark, (1, "a", "2024-02-01")).withColumn("v", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception, match="boom"):
        load(bad, dataset, LoadSpec(mode="incremental", primary_key="k"))
    assert len(rows(dataset.read())) == 2


def test_concurrent_commit_is_noticed(spark, dataset):
    schema = dataset.read().schema
    with pytest.raises(TransferError, match="another load"):
        dataset._publish(dataset.versions()[-1], [], schema, {})


def test_time_travel_and_vacuum(spark, dataset):
    first = dataset.versions()[-1]
    load(frame(spark, (7, "z", "2024-03-01")), dataset, LoadSpec())
    assert len(rows(dataset.read_version(first))) == 2
    assert [n.split("-")[0] for n in dataset.vacuum()] == [f"_version={first}"]
    assert len(rows(dataset.read())) == 1


def test_dataset_written_by_others_is_adopted(spark, scratch):
    frame(spark, (1, "a", "2024-01-01")).write.parquet(scratch)
    target = VersionedDataset(spark, scratch)
    load(frame(spark, (2, "b", "2024-01-02")), target,
         LoadSpec(mode="incremental", primary_key="k"))
    assert kv(target.read()) == [(1, "a"), (2, "b")]


def test_catalog_table_modes(spark):
    target = CatalogTable(spark, f"{create_database(spark, 'modes')}.t")
    load(frame(spark, (1, "a", "2024-01-01")), target, LoadSpec())
    load(frame(spark, (1, "x", "2024-01-02"), (2, "b", "2024-01-02")), target,
         LoadSpec(mode="incremental", primary_key="k", update_key="d"))
    assert kv(target.read()) == [(1, "x"), (2, "b")]
    load(frame(spark, (3, "c", "2024-01-03")), target, LoadSpec(mode="truncate"))
    assert kv(target.read()) == [(3, "c")]
    load(frame(spark, (3, "no", "2024-01-03"), (4, "d", "2024-01-03")), target,
         LoadSpec(mode="incremental", primary_key="k", strategy="insert"))
    assert kv(target.read()) == [(3, "c"), (4, "d")]


def test_plain_files_have_no_keyed_loads(spark, scratch):
    target = FileTarget(spark, scratch, "csv", TargetOptions())
    load(frame(spark, (1, "a", "2024-01-01")), target, LoadSpec())
    with pytest.raises(TransferError, match="parquet or table"):
        load(frame(spark, (1, "a", "2024-01-01")), target,
             LoadSpec(mode="incremental", primary_key="k"))


def test_stage_keeps_rows_and_schema(spark):
    df = frame(spark, (1, "a", "2024-01-01"))
    assert rows(stage(df, "t")) == rows(df)


def test_marks_of_instants_survive_another_time_zone(spark, scratch):
    target = VersionedDataset(spark, scratch)
    source = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-01 12:00:00")],
                                   "k int, at string").withColumn("at", F.to_timestamp("at"))
    spec = LoadSpec(mode="incremental", primary_key="k", update_key="at")
    load(source.where("k = 1"), target, spec)
    assert target.state()["high_water"].endswith("10:00:00.000000Z")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert load(source, target, spec).rows_in == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert target.read().count() == 2


def test_compaction_keeps_rows_and_mark(spark, dataset):
    load(frame(spark, (3, "c", "2024-01-03")), dataset,
         LoadSpec(mode="incremental", update_key="d"))
    before, mark = rows(dataset.read()), dataset.state()
    dataset.compact()
    assert rows(dataset.read()) == before and dataset.state() == mark
    assert len(dataset.latest()["folders"]) == 1
