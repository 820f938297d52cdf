"""Options that reach a transfer, slices of an order, streams at a time, one merge."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from ferryline import LoadSpec, Replication, Transfer, VersionedDataset, load
from ferryline.operators import shape
from ferryline.plans import replication


def test_ordered_slices_tile_the_rows(spark, monkeypatch):
    monkeypatch.setattr(shape, "TOP_ROWS", 10)
    df = spark.range(0, 5000, 1, 6).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"),
                                           F.when(F.col("id") % 11 > 0, F.col("id")).alias("n"))
    rows = [tuple(r) for r in df.orderBy(F.desc("k"), "v").collect()]
    for offset, limit in ((0, 1500), (1500, 1500), (3000, None), (4990, 100), (6000, 5), (10, 0)):
        found = shape.limit_offset(df, limit, offset, "k desc")
        end = None if limit is None else offset + limit
        assert sorted(tuple(r) for r in found.select("k", "v").collect()) == sorted(
            r[:2] for r in rows[offset:end])
    # No order: pages follow all columns, and neither overlap nor leave gaps.
    pages = [shape.limit_offset(df.repartition(k), 1000, 1000 * k).collect() for k in range(1, 5)]
    first = shape.limit_offset(df, 1000, 0, "k").collect()
    assert len({r["v"] for p in pages + [first] for r in p}) == 5000
    plan = shape.limit_offset(df, 2000, 1000, "k")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "GlobalLimit" not in plan


def test_slices_through_a_transfer(spark, tmp_path):
    spark.range(100).repartition(5).write.parquet(f"{tmp_path}/t.parquet")
    found = Transfer(src_stream=f"file:{tmp_path}/t.parquet", limit=10, offset=20,
                     order_by="id desc", spark=spark).dataframe()
    assert {r["id"] for r in found.collect()} == set(range(70, 80))


def test_malformed_lines_are_skipped_and_counted(spark, tmp_path):
    (tmp_path / "m.csv").write_text("a,b\n1,2\n3\n4,5,6\n7,8\n")
    report = Transfer(src_stream=f"file:{tmp_path}/m.csv", tgt_object=f"file:{tmp_path}/o.parquet",
                      on_malformed="skip", spark=spark).run()
    assert report.rows_in == 2 and report.detail["malformed"] == 2


def test_a_list_of_datasets_and_files(spark, tmp_path):
    for k in (1, 2):
        VersionedDataset(spark, f"file:{tmp_path}/d{k}.parquet").replace(
            spark.createDataFrame([(k, "x")], "a long, b string"))
    spark.createDataFrame([(3, 1.5)], "a long, c double").write.parquet(f"{tmp_path}/p.parquet")
    found = Transfer(files=[f"file:{tmp_path}/{n}.parquet" for n in ("d1", "d2", "p")],
                     spark=spark).dataframe()
    assert {tuple(r) for r in found.collect()} == {(1, "x", None), (2, "x", None), (3, None, 1.5)}


def test_chunk_size_on_a_full_refresh(spark, tmp_path):
    spark.range(90).write.parquet(f"{tmp_path}/s.parquet")
    target = f"file:{tmp_path}/t.parquet"
    VersionedDataset(spark, target).replace(spark.range(0))
    report = Transfer(src_stream=f"file:{tmp_path}/s.parquet", tgt_object=target, primary_key="id",
                      src_options={"chunk_size": 40}, spark=spark).run()
    assert report.detail["chunks"] == 4 and VersionedDataset(spark, target).read().count() == 90


def test_snapshots_are_told_apart_by_their_stamp(spark, scratch):
    target = VersionedDataset(spark, f"{scratch}/s")
    for stamp in ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-01 00:00:00"):
        load(spark.range(2), target, LoadSpec(mode="snapshot", loaded_at=stamp))
    assert target.read().count() == 4


def test_rows_that_no_mark_places_are_told(spark, scratch):
    target = VersionedDataset(spark, f"{scratch}/u")
    rows = spark.createDataFrame([(1, 5), (2, None)], "a long, u long")
    load(rows, target, LoadSpec(mode="incremental", update_key="u"))
    more = rows.union(spark.createDataFrame([(3, 9)], rows.schema))
    report = load(more, target, LoadSpec(mode="incremental", update_key="u"))
    assert report.rows_in == 1 and report.left_out == 1 and target.read().count() == 3


def test_a_chunked_backfill_publishes_once(spark, scratch):
    target = VersionedDataset(spark, f"{scratch}/b")
    rows = spark.range(100).select("id", F.lit("new").alias("v"))
    target.replace(spark.range(0, 100, 2).select("id", F.lit("old").alias("v")))
    before = len(target.versions())
    report = load(rows, target, LoadSpec(mode="backfill", primary_key="id", update_key="id",
                                         range="10..59", chunk_size=10))
    assert len(target.versions()) == before + 1
    assert report.detail["chunks"] == 5 and report.rows_in == 50
    assert target.read().where("v = 'new'").count() == 50 and target.read().count() == 75


@pytest.mark.parametrize("concurrency", [1, 3])
def test_streams_run_at_a_time(spark, tmp_path, monkeypatch, concurrency):
    for k in range(4):
        spark.range(k + 1).write.parquet(f"{tmp_path}/in/t{k}.parquet")
    running, most, groups, lock = set(), [0], [], threading.Lock()
    plain = replication.Replication._run_stream

    def watched(self, name, *rest):
        with lock:
            running.add(name)
            most[0] = max(most[0], len(running))
            groups.append(spark.sparkContext.getLocalProperty("spark.jobGroup.id") == name)
        time.sleep(0.5)
        try:
            return plain(self, name, *rest)
        finally:
            with lock:
                running.discard(name)

    monkeypatch.setattr(replication.Replication, "_run_stream", watched)
    streams = {f"file:{tmp_path}/in/t{k}.parquet": {} for k in range(4)}
    streams[f"file:{tmp_path}/in/none.parquet"] = {}
    run = Replication(streams=streams, spark=spark, concurrency=concurrency, defaults={
        "object": f"file:{tmp_path}/out/{{stream_table}}.parquet"})
    report = run.run(raise_on_error=False).collect()
    assert [r["stream"] for r in report] == list(streams)
    assert [r["rows_in"] for r in report] == [1, 2, 3, 4, None] and report[4]["status"] == "error"
    assert most[0] == concurrency and all(groups)


@pytest.mark.parametrize("mode", ["full-refresh", "truncate", "snapshot"])
def test_whole_loads_go_through_the_named_staging_place(spark, scratch, tmp_path, mode):
    spark.range(4).write.parquet(f"{tmp_path}/s.parquet")
    target = f"file:{tmp_path}/t.parquet"
    VersionedDataset(spark, target).replace(spark.range(0))
    Transfer(src_stream=f"file:{tmp_path}/s.parquet", where="id > 0", tgt_object=target, mode=mode,
             tgt_options={"table_tmp": f"{scratch}/tmp", "add_new_columns": True},
             spark=spark).run()
    assert spark.read.parquet(f"{scratch}/tmp").count() == 3
    assert VersionedDataset(spark, target).read().count() == 3
