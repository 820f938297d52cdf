"""Csv files with line breaks in quotes, split over tasks, against the whole-file read."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from ferryline.sources import quoted
from ferryline.sources.files import read_files


@pytest.fixture()
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "4000", "spark.sql.files.openCostInBytes": "1"}
    for key, value in names.items():
        spark.conf.set(key, value)
    yield
    for key in names:
        spark.conf.unset(key)


def rows(n, seed):
    rng = random.Random(seed)
    parts = ["word", "\n", "\r\n", '"', ",", "a,b", "é", " ", "\n\n"]
    out = [[str(k), "".join(rng.choice(parts) for _ in range(rng.randint(0, 12))),
            rng.choice(["", "x", 'say "yes"'])] for k in range(n)]
    out[n // 2][1] = "long\n" * 3000  # a record that spans several ranges
    out[n // 3][1] = "z" * 9000 + '"\n' + "z" * 9000
    return out


def test_quoted_line_breaks_in_many_tasks(spark, tmp_path, small_splits):
    for name, lines, end in (("a.csv", rows(900, 1), "\n"), ("b.csv", rows(700, 2), "\r\n")):
        with open(tmp_path / name, "w", newline="", encoding="utf-8") as handle:
            out = csv.writer(handle, lineterminator=end)
            out.writerow(["id", "text", "more"])
            out.writerows(lines)
    (tmp_path / "c.csv").write_text("more,id\nplain,5000\n")
    found = read_files(spark, str(tmp_path), {"format": "csv"}, columns={"id": "bigint"},
                       stream_url=True)
    assert found.select("id").rdd.getNumPartitions() > 5
    # Unquoted empty values are null, like empty ones that csv.writer does not quote.
    expected = {(int(i), t or None, m or None) for n, s in ((900, 1), (700, 2))
                for i, t, m in rows(n, s)} | {(5000, None, "plain")}
    got = [(r["id"], r["text"], r["more"]) for r in found.collect()]
    assert len(got) == 1601 and set(got) == expected
    assert found.select("_stream_url").distinct().count() == 3
    spread = quoted.whole_records(spark, [str(tmp_path / "a.csv")]).select("start").distinct()
    assert spread.count() > 5


def test_agrees_with_the_whole_file_read(spark, tmp_path, small_splits):
    text = ('id;text\r\n1;"a\nb"\r\n\r\n2;"c ""quoted""\r\nd"\r\n3;""\r\n4;\r\n5;x;y\r\n6\r\n7;" e "')
    path = str(tmp_path / "t.csv")
    (tmp_path / "t.csv").write_bytes(text.encode())
    options = {"format": "csv", "delimiter": ";"}
    # Spark's own reader turns line ends inside quotes to \n; here they stay as they are.
    split = read_files(spark, path, options, infer=False).withColumn(
        "text", F.replace("text", F.lit("\r\n"), F.lit("\n")))
    whole = read_files(spark, path, options, infer=False, multi_line=True)
    assert sorted(tuple(r) for r in split.fillna("?").collect()) == sorted(
        tuple(r) for r in whole.fillna("?").collect())
    kept = read_files(spark, path, options, infer=False, on_malformed="skip")
    assert {r["id"] for r in kept.collect()} == {"1", "2", "3", "4", "7"}
    with pytest.raises(Exception, match="malformed"):
        read_files(spark, path, options, infer=False, on_malformed="fail").collect()
    bare = read_files(spark, path, {**options, "header": False}, infer=False)
    assert bare.columns == ["_c0", "_c1"] and bare.where(F.col("_c0") == "id").count() == 1
