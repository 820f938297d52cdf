"""Statements and splits for databases, held against what they mean in Spark and in
DuckDB; no database is reached."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline import LoadSpec, Replication, load
from ferryline.plans import targets
from ferryline.sources import connections, database
from ferryline.sources.inputs import REST, frequent_keys, ragged_frame

TARGET = [(1, "a", "x"), (2, "b", "y"), (3, "c", None), (None, "n", "z")]
SOURCE = [(2, "B"), (4, "D"), (None, "N")]


def merged_in_sql(strategy, delete_missing=False):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k BIGINT, v VARCHAR, w VARCHAR)")
    con.execute("CREATE TABLE s (k BIGINT, v VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", TARGET)
    con.executemany("INSERT INTO s VALUES (?, ?)", SOURCE)
    for text in database.merge_statements("t", "s", ["k"], ["k", "v"], strategy, delete_missing):
        con.execute(text)
    return set(con.execute("SELECT * FROM t").fetchall())


def test_merge_statements():
    kept = {(1, "a", "x"), (3, "c", None), (None, "n", "z")}
    new = {(4, "D", None), (None, "N", None)}
    assert merged_in_sql("update_insert") == kept | {(2, "B", "y")} | new
    assert merged_in_sql("delete_insert") == kept | {(2, "B", None)} | new
    assert merged_in_sql("insert") == kept | {(2, "b", "y")} | new
    assert merged_in_sql("update") == kept | {(2, "B", "y")}
    assert merged_in_sql("update_insert", delete_missing=True) == {(2, "B", "y")} | new


@pytest.mark.parametrize("kind, values", [
    ("BIGINT", [5, 1, None, 9, 9, 9, 3]), ("VARCHAR", ["b", "it's", None, "a", "zz", "b"]),
    ("DATE", ["2024-01-05", "2023-12-31", None, "2024-02-29"]),
    ("TIMESTAMP", ["2024-01-05 10:00:00", None, "2024-01-05 10:00:01", "2020-01-01 00:00:00"])])
def test_ranges_hold_every_row_once(kind, values):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t (k {kind})")
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
    spark_kind = {"BIGINT": T.LongType(), "VARCHAR": T.StringType(), "DATE": T.DateType(),
                  "TIMESTAMP": T.TimestampNTZType()}[kind]
    for parts in (1, 3, 10):
        bounds = [r[0] for r in con.execute(database.bounds_query("t", "k", parts)).fetchall()]
        found = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0]
                 for p in database.range_predicates("k", bounds, spark_kind)]
        assert sum(found) == len(values)
    assert database.range_predicates("k", [], spark_kind) == ["1 = 1"]


class Connection:
    """What the driver asks of java.sql.Connection, written down."""

    def __init__(self, tables=(), fails=None):
        self.log, self.names, self.fails, self.at = [], list(tables), fails, -1

    def setAutoCommit(self, on):
        self.log.append(f"autocommit {on}")

    def createStatement(self):
        return self

    def execute(self, text):
        if self.fails and self.fails in text:
            raise RuntimeError("no")
        self.log.append(text)

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")

    def getMetaData(self):
        return self

    def getTables(self, *_):
        self.at = -1
        return self

    def next(self):
        self.at += 1
        return self.at < len(self.names)

    def getString(self, column):
        return dict(zip(("TABLE_SCHEM", "TABLE_NAME", "TABLE_TYPE"), self.names[self.at])).get(column)


@pytest.fixture()
def fake(monkeypatch):
    made = Connection([("sales", "orders", "TABLE"), ("sales", "order_lines", "VIEW"),
                       ("hr", "people", "TABLE"), ("sales", "orders_x", "SYSTEM TABLE")])
    monkeypatch.setattr(database.Database, "connect", lambda self: made)
    return made


def test_statements_run_together_or_not_at_all(spark, fake):
    base = database.Database(spark, "jdbc:x")
    base.run_together(["one", "two"])
    assert fake.log == ["autocommit False", "one", "two", "commit", "close"]
    fake.log.clear()
    fake.fails = "two"
    with pytest.raises(RuntimeError):
        base.run_together(["one", "two", "three"])
    assert fake.log == ["autocommit False", "one", "rollback", "close"]


def test_tables_of_a_database(spark, fake, monkeypatch):
    base = database.Database(spark, "jdbc:x")
    assert base.tables("sales.*") == ["sales.order_lines", "sales.orders"]
    assert base.tables("ord*") == ["sales.order_lines", "sales.orders"]
    assert base.has_table("HR.People") and not base.has_table("hr.orders")
    plan = Replication(source="jdbc:postgresql://h/d", spark=spark, streams={
        "sales.*": {}, "sales.orders": {"mode": "incremental"}}).planned()
    assert {n: c.mode for n, c in plan.items()} == {"sales.orders": "incremental",
                                                    "sales.order_lines": None}

    def lost(self):
        raise ConnectionError("gone")

    monkeypatch.setattr(database.Database, "connect", lost)
    with pytest.raises(ConnectionError):  # not taken for an absent table
        targets.JdbcTable(spark, "jdbc:x", "t").exists()


def test_a_merge_writes_the_source_beside_and_merges_it(spark, fake, monkeypatch):
    fake.names.append(("", "t", "TABLE"))
    written = {}
    monkeypatch.setattr(targets.JdbcTable, "read", lambda self: spark.createDataFrame(
        TARGET, "k long, v string, w string"))
    monkeypatch.setattr(targets.JdbcTable, "_write", lambda self, df, mode, truncate=False:
                        written.update({self.table: (mode, {tuple(r) for r in df.collect()})}))
    target = targets.JdbcTable(spark, "jdbc:x", "t")
    load(spark.createDataFrame(SOURCE, "k long, v string"), target,
         LoadSpec(mode="incremental", primary_key="k"))
    (staging, (mode, rows)), = written.items()
    assert staging.startswith("t_in_") and mode == "append" and rows == set(SOURCE)
    assert fake.log[-4:] == ["autocommit False", f"DROP TABLE {staging}", "commit", "close"]
    merge = [x.replace(staging, "s") for x in fake.log if "INTO t" in x or x.startswith("UPDATE t")]
    assert merge == database.merge_statements("t", "s", ["k"], ["k", "v"], "update_insert")


def test_split_extracts_are_read_by_predicates(spark, monkeypatch):
    asked = {}

    class Reader:
        def format(self, _):
            return self

        option = options = lambda self, *a, **k: self

        def load(self):
            return spark.createDataFrame([], "day date, v string")

        def jdbc(self, url, table, predicates, properties):
            asked.update(url=url, table=table, predicates=predicates)
            return spark.range(1)

    answers = {"COUNT": spark.sql("SELECT 25 AS n"), "NTILE": spark.sql(
        "SELECT * FROM VALUES (DATE '2024-01-01'), (DATE '2024-03-01'), (DATE '2024-02-01') AS t(k)")}
    monkeypatch.setattr(connections, "sql_frame", lambda s, where, text, args=None: next(
        a for key, a in answers.items() if key in text))
    monkeypatch.setattr(type(spark), "read", property(lambda self: Reader()))
    connections.jdbc_table(spark, connections.Location("jdbc", "jdbc:x"), "t", "day", 10)
    assert asked["predicates"] == ["day < DATE '2024-02-01' OR day IS NULL",
                                   "day >= DATE '2024-02-01' AND day < DATE '2024-03-01'",
                                   "day >= DATE '2024-03-01'"]


def test_a_table_with_very_many_keys_loads(spark):
    rows = spark.range(20_000).select(F.to_json(F.map_from_arrays(
        F.array(F.lit("id"), *[F.concat(F.lit(f"k{i}_"), "id") for i in range(5)]),
        F.array(F.col("id").cast("string"), *[F.lit(str(i)) for i in range(5)]))).alias("data"))
    names, more = frequent_keys(rows, "data", 10)
    assert len(names) == 10 and "id" in names and more  # 100,001 keys in all
    found = ragged_frame(rows, "data", 10)
    assert found.columns == [*names, REST] and found.where("id IS NULL").count() == 0
    one = found.where("id = '15000'").select(F.to_json(REST).alias("r")).first()["r"]
    assert json.loads(one) == {f"k{i}_15000": str(i) for i in range(5)}
    few = ragged_frame(rows.limit(1), "data")
    assert len(few.columns) == 6 and REST not in few.columns
