"""Transfers end to end: inputs, files, streaming back, errors."""

import csv
import datetime as dt
import decimal
import glob
import json

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ferryline import Format, Mode, SourceOptions, Transfer, TransferError, UnsupportedError
from ferryline.sources import inputs
from ferryline.sources.files import malformed_rows, read_files
from ferryline.sources.inputs import input_frame

PEOPLE = [
    {"id": 1, "name": "Ann", "age": 41, "city": "Oslo", "pay": 3120,
     "at": dt.datetime(2021, 7, 19, 8, 15, 2, 500)},
    {"id": 2, "name": "Ben", "age": 19, "city": "Lima, Peru", "pay": 874.75,
     "at": dt.datetime(1999, 12, 31, 23, 59, 59, 999999)},
    {"id": 3, "name": 'Cy "C"', "age": 63, "city": "Rome\nItaly", "pay": 12.5,
     "at": dt.datetime(2024, 2, 29, 12, 0, 0, 70000)},
]


def stored(path):
    lines = []
    for part in sorted(glob.glob(f"{path}/part-*")):
        with open(part, newline="") as handle:
            lines += list(csv.DictReader(handle))
    return lines


@pytest.mark.parametrize("suffix, options", [
    (".csv", {}), (".json", {"columns": {"at": "timestamp"}}), (".parquet", {}), (".arrow", {}),
    (".xml", {}), (".csv.gz", {}), (".csv.zip", {}),
    (".jsonl", {"flatten": True, "columns": {"at": "timestamp"}})])
def test_round_trip(spark, tmp_path, suffix, options):
    target = f"file://{tmp_path}/people{suffix}"
    report = Transfer(input=PEOPLE, tgt_object=target, mode=Mode.FULL_REFRESH, spark=spark).run()
    assert report.status == "success"
    back = {r["id"]: r for r in Transfer(src_stream=target, src_options=options,
                                         spark=spark).stream()}
    if suffix == ".csv.zip":
        back = {k: {**v, "at": v["at"]} for k, v in back.items()}
    assert back == {r["id"]: {**r, "pay": float(r["pay"])} for r in PEOPLE}


def test_json_array_files_are_json(spark, tmp_path):
    Transfer(input=PEOPLE, tgt_object=f"{tmp_path}/out.json", spark=spark).run()
    found = [row for part in glob.glob(f"{tmp_path}/out.json/part-*")
             for row in json.load(open(part))]
    assert sorted(r["id"] for r in found) == [1, 2, 3]


def test_json_lines_come_back_as_text(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text("".join(json.dumps({"name": r["name"], "age": r["age"]}) + "\n"
                            for r in PEOPLE))
    found = list(Transfer(src_conn=f"file://{path}", spark=spark).stream())
    assert [list(r) for r in found] == [["data"]] * 3
    assert json.loads(found[0]["data"]) == {"name": "Ann", "age": 41}


def test_generators_are_drained_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(inputs, "CHUNK_ROWS", 10)
    rows = ({"id": i, "v": i / 2 if i >= 15 else i, **({"late": "x"} if i > 30 else {})}
            for i in range(35))
    df = input_frame(spark, rows)
    assert df.count() == 35 and df.where("late = 'x'").count() == 4
    assert dict(df.dtypes) == {"id": "bigint", "v": "double", "late": "string"}


def test_type_lattice(spark):
    df = input_frame(spark, [
        {"b": True, "i": 1, "f": 1, "t": dt.datetime(2024, 1, 1), "d": dt.date(2024, 1, 1),
         "m": 1, "n": None, "l": [1], "x": decimal.Decimal("1.50"), "td": dt.date(2024, 1, 1),
         "bi": True},
        {"b": None, "i": 2, "f": 2.5, "t": None, "d": dt.date(2024, 1, 2), "m": "a", "n": None,
         "l": {"k": "v"}, "x": None, "td": dt.datetime(2024, 1, 2, 3), "bi": 1}])
    assert dict(df.dtypes) == {
        "b": "boolean", "i": "bigint", "f": "double", "t": "timestamp_ntz", "d": "date",
        "m": "string", "n": "string", "l": "string", "x": "string", "td": "timestamp_ntz",
        "bi": "string"}
    assert df.columns == sorted(df.columns)
    assert sorted(r["l"] for r in df.collect()) == ["[1]", '{"k": "v"}']
    assert [r["x"] for r in df.collect() if r["x"]] == ["1.50"]


def test_missing_keys_and_null_marks(spark, tmp_path):
    rows = [{"id": 1, "name": "John"}, {"id": 2, "age": 35}, {"id": 3, "name": "\\N", "age": None}]
    df = input_frame(spark, rows)
    assert sorted((r["id"], r["name"], r["age"]) for r in df.collect()) == [
        (1, "John", None), (2, None, 35), (3, None, None)]
    Transfer(input=rows, tgt_object=f"{tmp_path}/n.csv", spark=spark).run()
    assert sorted((r["id"], r["name"], r["age"]) for r in stored(f"{tmp_path}/n.csv")) == [
        ("1", "John", ""), ("2", "", "35"), ("3", "", "")]


def test_tables_as_input(spark):
    frame = pd.DataFrame({"a": [1, 2], "s": ["x", None]})
    for data in (frame, pa.Table.from_pandas(frame), spark.createDataFrame(frame)):
        assert sorted(r["a"] for r in input_frame(spark, data).collect()) == [1, 2]

    class Other:
        def to_arrow(self):
            return pa.table({"a": [5]})

    assert input_frame(spark, Other()).first()["a"] == 5
    with pytest.raises(TypeError):
        input_frame(spark, 5)


def test_empty_input_makes_an_empty_target(spark, tmp_path):
    Transfer(input=[], tgt_object=f"{tmp_path}/none.csv", spark=spark).run()
    assert list(Transfer(src_stream=f"{tmp_path}/none.csv", spark=spark).stream()) == []


def test_columns_cast_and_select_selects(spark, tmp_path):
    rows = [{"id": 1, "name": "A", "created": "2024-01-15", "value": 100}]

    def names(**arguments):
        return dict(Transfer(input=rows, spark=spark, **arguments).dataframe().dtypes)

    assert names(columns={"created": "timestamp"}) == {
        "id": "bigint", "name": "string", "created": "timestamp_ntz", "value": "bigint"}
    assert list(names(select=["id", "name"])) == ["id", "name"]
    assert list(names(select="id, missing")) == ["id"]
    assert names(select=["id", "created"], columns={"created": "date"}) == {
        "id": "bigint", "created": "date"}
    with pytest.raises(ValueError, match="none of the selected"):
        names(select=["nope"])
    with pytest.raises(ValueError, match="do not exist"):
        names(columns={"nope": "int"})


def test_limits_and_where(spark, tmp_path):
    Transfer(input=PEOPLE, tgt_object=f"{tmp_path}/p.csv", spark=spark).run()

    def count(**arguments):
        return len(list(Transfer(src_stream=f"{tmp_path}/p.csv", spark=spark,
                                 **arguments).stream()))

    assert count(limit=2) == 2 and count(limit=2, offset=2) == 1
    assert count(where="age > 26") == 2 and count(where="age > 26 and city = 'Oslo'") == 1
    assert count(src_options={"limit": 1}) == 1


def test_stream_arrow_keeps_types_and_stops_early(spark, tmp_path):
    rows = [{**PEOPLE[0], "id": i} for i in range(5000)]
    target = f"{tmp_path}/many.parquet"
    Transfer(input=spark.createDataFrame(pd.DataFrame(rows)).repartition(8), tgt_object=target,
             spark=spark).run()
    table = Transfer(src_stream=target, spark=spark).stream_arrow().read_all()
    assert table.num_rows == 5000
    assert str(table.schema.field("at").type) == "timestamp[us, tz=UTC]"
    assert table.column("pay").type == pa.int64()
    reader = Transfer(src_stream=target, spark=spark).stream_arrow(batch_rows=100)
    assert next(iter(reader)).num_rows <= 100
    reader.close()
    stream = Transfer(src_stream=target, spark=spark).stream()
    assert next(stream)["name"] == "Ann"
    empty = Transfer(src_stream=target, where="id < 0", spark=spark).stream_arrow().read_all()
    assert empty.num_rows == 0 and empty.column_names == table.column_names


def test_wrong_uses_are_errors(spark, tmp_path):
    with pytest.raises(TransferError, match="no target object"):
        Transfer(input=PEOPLE, spark=spark).run()
    with pytest.raises(TransferError, match="streamed back"):
        Transfer(input=PEOPLE, spark=spark).stream()
    with pytest.raises(TransferError, match="target object"):
        Transfer(src_stream="/x.csv", tgt_object="/y.csv", spark=spark).stream_arrow()
    with pytest.raises(TransferError, match="no source"):
        Transfer(tgt_object=f"{tmp_path}/x.csv", spark=spark).run()
    for fmt in ("avro", "xlsx", "sas7bdat"):
        with pytest.raises(UnsupportedError):
            Transfer(input=PEOPLE, tgt_object=f"{tmp_path}/x.{fmt}", spark=spark).run()
    with pytest.raises(UnsupportedError, match="avro"):
        read_files(spark, f"{tmp_path}/x.avro")
    with pytest.raises(UnsupportedError, match="zstd"):
        Transfer(input=PEOPLE, tgt_object=f"{tmp_path}/x.csv", spark=spark,
                 tgt_options={"compression": "zstd"}).run()


def test_caller_options_are_not_changed(spark, tmp_path):
    options = {"format": Format.CSV}
    source = SourceOptions(format="csv")
    Transfer(input=PEOPLE, tgt_object=f"{tmp_path}/o", tgt_options=options, spark=spark).run()
    list(Transfer(src_stream=f"{tmp_path}/o", src_options=source, limit=1, spark=spark).stream())
    assert options == {"format": Format.CSV} and source == SourceOptions(format="csv")


def test_stream_with_target_runs(spark, tmp_path):
    made = Transfer(input=PEOPLE, tgt_object=f"{tmp_path}/s.csv", spark=spark).stream()
    assert list(made) == [] and len(stored(f"{tmp_path}/s.csv")) >= 3


def test_incremental_transfer_to_files(spark, tmp_path):
    target = f"{tmp_path}/inc.parquet"

    def run(rows):
        return Transfer(input=rows, tgt_object=target, mode="incremental", primary_key="id",
                        update_key="at", spark=spark).run()

    run(PEOPLE[:2])
    run([{**PEOPLE[0], "name": "Ada", "at": dt.datetime(2030, 1, 1)}, PEOPLE[2]])
    found = {r["id"]: r["name"] for r in Transfer(src_stream=target, spark=spark).stream()}
    assert found == {1: "Ada", 2: "Ben", 3: 'Cy "C"'}


def test_environment_switches(spark, tmp_path):
    Transfer(input=PEOPLE, tgt_object=f"{tmp_path}/e.csv", spark=spark).run()
    df = Transfer(src_stream=f"{tmp_path}/e.csv", select="id", spark=spark,
                  env={"X_STREAM_URL_COLUMN": "true", "X_LOADED_AT_COLUMN": "true"}).dataframe()
    assert df.columns == ["id", "_stream_url", "_loaded_at"]
    assert df.select("_loaded_at").distinct().count() == 1
    assert "e.csv/part-" in df.first()["_stream_url"]


def test_malformed_rows_can_be_listed(spark, tmp_path):
    (tmp_path / "m.csv").write_text("a,b\n1,x\n2\n3,y,z\n")
    good = read_files(spark, f"{tmp_path}/m.csv", on_malformed="skip")
    assert [tuple(r) for r in good.collect()] == [(1, "x")] and good.count() == 1
    bad = malformed_rows(spark, f"{tmp_path}/m.csv", None, good.schema)
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == ["2", "3,y,z"]


def test_inference_never_loses_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "zip,big,mixed,dates,num\n00123,123456789012345678901,1,2024-01-01,1\n"
        "10001,5,x,2024-01-02 10:00:00,1e3\n")
    df = read_files(spark, f"{tmp_path}/t.csv")
    assert dict(df.dtypes) == {"zip": "string", "big": "string", "mixed": "string",
                               "dates": "timestamp_ntz", "num": "double"}
    assert df.first()["zip"] == "00123"


def test_column_named_value_in_transforms(spark):
    df = Transfer(input=[{"a": 2, "value": 3}], transforms={"a": "value * 10", "value": "value + a"},
                  spark=spark).dataframe()
    assert df.first().asDict() == {"a": 20, "value": 23}


def test_config_document(spark, tmp_path):
    Transfer(input=PEOPLE, tgt_object=f"{tmp_path}/in.csv", spark=spark).run()
    Transfer(config=json.dumps({
        "source": {"stream": f"{tmp_path}/in.csv"}, "mode": "full-refresh",
        "target": {"object": f"{tmp_path}/out", "options": {"format": "jsonlines"}}}),
        spark=spark).run()
    assert spark.read.json(f"{tmp_path}/out").agg(F.sum("age")).first()[0] == 123


def test_lost_casts_are_counted_and_strict_casts_raise(spark, tmp_path):
    rows = [{"id": "1", "n": "7"}, {"id": "x", "n": "8"}, {"id": None, "n": "y"}]

    def run(**arguments):
        return Transfer(input=rows, tgt_object=f"{tmp_path}/c.parquet", spark=spark,
                        columns={"id": "int", "n": "bigint"}, **arguments).run()

    assert run().detail == {"cast_nulls": 2}
    assert run(mode="incremental", update_key="n").detail == {"cast_nulls": 2}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run(strict_casts=True)


def test_staging_place_and_concurrency(spark, tmp_path):
    stage_at, target = f"{tmp_path}/staging", f"{tmp_path}/t.parquet"
    for _ in range(2):
        Transfer(input=PEOPLE, tgt_object=target, mode="incremental", primary_key="id",
                 tgt_options={"table_tmp": stage_at}, spark=spark).run()
    assert spark.read.parquet(stage_at).count() == 3
    assert Transfer(src_stream=target, spark=spark).dataframe().count() == 3
    Transfer(input=PEOPLE, tgt_object=f"{tmp_path}/n.jsonl", tgt_options={"concurrency": 3},
             spark=spark).run()
    assert len(glob.glob(f"{tmp_path}/n.jsonl/part-*")) == 3


def test_target_options_shape_the_columns(spark, tmp_path):
    Transfer(input=[{"OrderId": 1, "unitPrice": 2.345}], tgt_object=f"{tmp_path}/s.parquet",
             spark=spark, tgt_options={"column_casing": "snake", "max_decimals": 2,
                                       "column_typing": {"bigint": "string"}}).run()
    assert spark.read.parquet(f"{tmp_path}/s.parquet").first().asDict() == {
        "order_id": "1", "unit_price": 2.35}
