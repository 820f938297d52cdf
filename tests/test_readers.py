"""Readers decide per file, never from the first file or line."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline import Mode, Transfer
from ferryline.operators.infer import apply_inferred
from ferryline.sinks.files import write_files
from ferryline.sources import files
from ferryline.sources.archives import read_arrow
from ferryline.sources.files import read_files

from conftest import rows


def put(folder, **files):
    for name, text in files.items():
        (folder / name.replace("__", ".")).write_text(text)
    return str(folder)


def test_csv_headers_differ_between_files(spark, tmp_path):
    path = put(tmp_path, a__csv="x,y\n1,2\n", b__csv="y,x,z\n3,4,5\n", c__csv='x,y\n6,"a\nb"\n')
    found = read_files(spark, path, {"format": "csv"}, infer=False)
    assert found.columns == ["x", "y", "z"]
    assert {(r["x"], r["y"], r["z"]) for r in found.collect()} == {
        ("1", "2", None), ("4", "3", "5"), ("6", "a\nb", None)}


def test_csv_file_names_with_signs(spark, tmp_path):
    path = put(tmp_path, **{"a b%20[1]__csv": "x\n1\n", "c__csv": "y\n2\n"})
    found = read_files(spark, path, {"format": "csv"}, infer=False)
    assert {(r["x"], r["y"]) for r in found.collect()} == {("1", None), (None, "2")}


def test_json_layouts_differ_between_files(spark, tmp_path):
    path = put(tmp_path, a__json='[{"k": 1},\n {"k": 2}]', b__json='{"k": 3}\n{"k": 4}\n',
               c__json='\n{\n "k": 5,\n "v": "x"\n}\n')
    found = read_files(spark, path, {"format": "json"}, infer=False)
    assert {(r["k"], r["v"]) for r in found.collect()} == {
        (1, None), (2, None), (3, None), (4, None), (5, "x")}


def test_arrow_schemas_are_united(spark, tmp_path):
    for name, table in (("a", pa.table({"k": pa.array([1], pa.int32())})),
                        ("b", pa.table({"v": ["x"], "k": pa.array([2 ** 40], pa.int64())}))):
        with pa.OSFile(str(tmp_path / f"{name}.arrow"), "wb") as out, \
                pa.ipc.new_file(out, table.schema) as writer:
            writer.write_table(table)
    found = read_arrow(spark, [str(tmp_path)])
    assert {(r["k"], r["v"]) for r in found.collect()} == {(1, None), (2 ** 40, "x")}


@pytest.mark.parametrize("values, kind", [
    (["+4791234567"], "string"), (["12345678901234567.89"], "string"), (["1.5", "2"], "double"),
    (["1234567890123456789"], "bigint"), (["1234567890123456789", "0.5"], "string"),
    (["0.12345678901234567890"], "string"), (["-12", "7"], "bigint"), (["1.25e-7"], "double")])
def test_inference_keeps_every_digit(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert apply_inferred(df).schema["v"].dataType.simpleString() == kind


def test_rows_without_update_key_are_merged(spark, tmp_path):
    schema, target = "k long, at date, v string", str(tmp_path / "t.parquet")
    for batch in ([(1, None, "a"), (2, None, "b")], [(1, None, "c"), (3, None, "d")]):
        frame = spark.createDataFrame(batch, schema).selectExpr(
            "k", "IF(k = 2, DATE'2024-01-01', at) AS at", "v")
        Transfer(input=frame, tgt_object=target, mode=Mode.INCREMENTAL,
                 primary_key="k", update_key="at").run()
    found = Transfer(src_stream=target).dataframe()
    assert rows(found.select("k", "v")) == [(1, "c"), (2, "b"), (3, "d")]


def _tasks(df):
    return df.select(F.spark_partition_id()).distinct().count()


def test_large_json_arrays_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """An array with its elements on lines of their own is split, with the types
    and values that reading it whole gives."""
    monkeypatch.setattr(files, "SPLIT_FROM", 10_000)
    written = spark.range(3000).select(
        "id", F.when(F.col("id") % 7 > 0, F.col("id") / 4).alias("x"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit(' ],\\"[\n{},'), "id")).alias("text"),
        F.array(F.struct(F.col("id").alias("k"))).alias("nested"))
    path, before = str(tmp_path / "t.json"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    write_files(written.coalesce(1), path, "json")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
        found = read_files(spark, path, {"format": "json"})
        plain = spark.read.option("multiLine", True).json(path)
        assert found.schema == plain.schema
        assert rows(found) == rows(plain) and found.count() == 3000
        assert found.where("text IS NULL").count() == 1000
        assert _tasks(found) > 2 and _tasks(plain) == 1
        typed = read_files(spark, path, {"format": "json"}, schema=T.StructType(
            [T.StructField("text", T.LongType()), T.StructField("id", T.LongType())]))
        assert rows(typed) == sorted([(i, None) for i in range(3000)], key=repr)
        urls = read_files(spark, path, {"format": "json"}, stream_url=True)
        assert urls.where("_stream_url LIKE '%part-00000%'").count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("text", [
    '[\n{"k": 1},\n{"k": 2}\n]\n', '\n [\n\n{"k": 1}, \n\t{"k": 2}\t\n]', "[\n]", "[]", '[\n{}\n]',
    '[\n{"k": 1}, {"k": 2}\n]', '[{"k": 1},\n{"k": 2}]', '[\n{"k": [\n{"k": 1}\n]}\n]',
    '[\n{"k": 1}\n{"k": 2}\n]', '[\n{"k": 1},\n{"k": 2},\n]', '[\n{"k": 1},\n{"k": 2}\n',
    '[\n{"k": 1},\nnull,\n{"k": 2}\n]', '[\n{"k": 1},\n{"k": "\t"}\n]', '[\n{"k": NaN},\n{"k": 1.5}\n]',
    '[\n{"k": 1},\n{"k": 2\n}\n]', "[\n{'k': 'a'},\n{\"v\": {\"k\": 1}}\n]",
    '[\n{"k": 1}\n],\n[\n{"k": 2}\n]', '[\n{"k": 1}\n]\n[\n{"k": 2}\n]'])
@pytest.mark.parametrize("beside", [None, '[{"k": 1}]', '{"k":\n"x"}'])
def test_json_layouts_read_as_they_do_whole(spark, tmp_path, monkeypatch, text, beside):
    monkeypatch.setattr(files, "SPLIT_FROM", 0)
    path = put(tmp_path, a__json=text, **({"b__json": beside} if beside else {}))
    found = read_files(spark, path, {"format": "json"}, infer=False)
    plain = spark.read.option("multiLine", True).json(path)
    assert found.schema == plain.schema
    if found.columns != ["_corrupt_record"]:  # which Spark does not read alone
        assert repr(rows(found)) == repr(rows(plain)) and found.count() == plain.count()
