"""Overwriting keeps the old files until the new ones are whole; file limits hold."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ferryline import LoadSpec, TargetOptions, VersionedDataset, load
from ferryline.fs import ClusterFiles
from ferryline.session import shared_dir
from ferryline.sinks.files import write_files
from ferryline.sources.files import read_files


@pytest.mark.parametrize("fmt", ["parquet", "csv", "arrow", "json"])
def test_a_failed_overwrite_keeps_the_old_rows(spark, tmp_path, fmt):
    path = str(tmp_path / f"t.{fmt}")
    write_files(spark.range(5), path, fmt)
    broken = spark.range(9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("x")))
                                   .otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="x"):
        write_files(broken, path, fmt)
    assert read_files(spark, path, {"format": fmt}).count() == 5
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == [f"t.{fmt}"]


@pytest.mark.parametrize("fmt", ["parquet", "arrow"])
def test_a_dataset_can_be_written_onto_itself(spark, tmp_path, fmt):
    path = str(tmp_path / f"t.{fmt}")
    write_files(spark.range(10), path, fmt)
    write_files(read_files(spark, path, {"format": fmt}).where("id < 4"), path, fmt)
    assert read_files(spark, path, {"format": fmt}).count() == 4


@pytest.mark.parametrize("fmt, name", [("json", "t.json"), ("arrow", "t.arrow"),
                                       ("csv", "t.csv.zip"), ("jsonlines", "t.jsonl")])
def test_row_limits_hold_for_every_format(spark, tmp_path, fmt, name):
    path = str(tmp_path / name)
    write_files(spark.range(95).coalesce(2), path, fmt, TargetOptions(file_max_rows=10))
    files = [p for p in Path(path).iterdir() if p.name.startswith("part")]
    assert len(files) >= 10
    found = read_files(spark, path, {"format": fmt,
                                     "flatten": True})
    assert sorted(r["id"] for r in found.collect()) == list(range(95))
    if fmt == "json":
        assert max(len(json.loads(p.read_text())) for p in files) == 10


def test_staged_copies_go_with_the_load(spark, scratch):
    def staged():
        return set(ClusterFiles(spark).names(f"{shared_dir(spark)}/ferryline"))

    target, before = VersionedDataset(spark, f"{scratch}/t"), staged()
    for k in range(2):
        load(spark.createDataFrame([(k, "a"), (9, str(k))], "k long, v string"), target,
             LoadSpec(mode="incremental", primary_key="k"))
    broken = spark.createDataFrame([(1, "b"), (1, "c")], "k long, v string")
    with pytest.raises(ValueError):
        load(broken, target, LoadSpec(mode="incremental", primary_key="k"))
    assert {n for n in staged() - before if not n.startswith("test-")} == set()
    assert target.read().count() == 3
