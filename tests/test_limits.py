"""Files within their bytes; headers of their own; one Arrow file in many tasks."""

import json
import zipfile
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ferryline import TargetOptions
from ferryline.sinks.files import write_files
from ferryline.sources import archives
from ferryline.sources.files import read_files


@pytest.mark.parametrize("name, fmt", [
    ("t.csv", "csv"), ("t.csv.gz", "csv"), ("t.csv.zip", "csv"), ("t.jsonl", "jsonlines"),
    ("t.json", "json"), ("t.arrow", "arrow"), ("t.xml", "xml")])
def test_no_file_is_larger_than_its_limit(spark, tmp_path, name, fmt):
    """The rows grow: what the first of them need says nothing about the last."""
    rows = spark.range(0, 3000, 1, 3).select("id", F.expr(
        "repeat(concat('a\"b', chr(10), ','), CAST(id / 60 AS INT))").alias("text"),
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("maybe"))
    path, limit = str(tmp_path / name), 20_000
    write_files(rows, path, fmt, TargetOptions(file_max_bytes=limit))
    files = [p for p in Path(path).iterdir() if p.name.startswith("part")]
    assert len(files) > 20 and max(p.stat().st_size for p in files) <= limit
    found = read_files(spark, path, {"format": fmt, "flatten": fmt == "jsonlines"},
                       columns={"id": "bigint"} if fmt in ("csv", "xml") else None)
    assert {(r["id"], r["text"] or "") for r in found.collect()} == {
        (r["id"], r["text"]) for r in rows.collect()}


def test_bytes_and_rows_limit_together_and_a_large_row_stands_alone(spark, tmp_path):
    rows = spark.createDataFrame([(k, "x" * (5000 if k == 7 else 10)) for k in range(40)],
                                 "id long, text string").coalesce(1)
    path = str(tmp_path / "t.jsonl")
    write_files(rows, path, "jsonlines", TargetOptions(file_max_bytes=400, file_max_rows=5))
    counts = [len(p.read_text().splitlines()) for p in Path(path).iterdir()
              if p.name.startswith("part")]
    assert sum(counts) == 40 and max(counts) == 5 and counts.count(1) >= 1
    empty = str(tmp_path / "e.json")
    write_files(rows.limit(0), empty, "json", TargetOptions(file_max_bytes=400))
    assert [json.loads(p.read_text()) for p in Path(empty).iterdir()
            if p.name.startswith("part")] == [[]]


def test_every_archive_has_its_own_header(spark, tmp_path):
    for name, members in {"a": {"1.csv": "x,y\n1,2\n"}, "b": {"1.csv": "y,x,z\n3,4,5\n",
                                                             "2.csv": "﻿z,x\n,6\n"}}.items():
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as archive:
            for member, text in members.items():
                archive.writestr(member, text)
    found = read_files(spark, str(tmp_path), {"format": "csv", "compression": "zip"},
                       stream_url=True)
    assert found.columns == ["x", "y", "z", "_stream_url"]
    assert {tuple(r)[:3] for r in found.collect()} == {(1, 2, None), (4, 3, 5), (6, None, None)}
    urls = {r["_stream_url"].rsplit("/", 1)[1] for r in found.collect()}
    assert urls == {"a.zip#1.csv", "b.zip#1.csv", "b.zip#2.csv"}
    by_place = read_files(spark, str(tmp_path), {"format": "csv", "compression": "zip",
                                                 "header": False})
    assert by_place.columns == ["_c0", "_c1", "_c2"] and by_place.count() == 6


def test_one_arrow_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "RANGE_BYTES", 2000)
    table = pa.table({"id": list(range(5000)), "text": [f"t{k}" for k in range(5000)]})
    with pa.ipc.new_file(str(tmp_path / "a.arrow"), table.schema) as writer:
        for batch in table.to_batches(max_chunksize=100):
            writer.write_batch(batch)
    other = pa.table({"more": [1.5], "id": pa.array([9], pa.int32())})
    with pa.ipc.new_stream(str(tmp_path / "b.arrow"), other.schema) as writer:
        writer.write_table(other)
    found = read_files(spark, str(tmp_path), {"format": "arrow"}, stream_url=True)
    assert found.select(F.spark_partition_id()).distinct().count() > 4
    assert found.columns == ["id", "text", "more", "_stream_url"]
    rows = [(r["id"], r["more"]) for r in found.collect()]
    assert len(rows) == 5001 and set(rows) == {(k, None) for k in range(5000)} | {(9, 1.5)}
    assert found.where("_stream_url LIKE '%b.arrow'").count() == 1
