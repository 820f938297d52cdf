"""Specifications run over landed responses; expressions as they are written."""

import json

import pytest
from pyspark.sql import types as T

from ferryline.errors import TransferError
from ferryline.functions.language import expression, rendered_state, spark_sql
from ferryline.plans.apirun import SpecRun, run_spec
from ferryline.plans.apispec import ApiSpec

RECORD = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("at", T.TimestampNTZType()),
    T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("name", T.StringType())])

TEXT = """
name: Shop
queues: [ids]
defaults:
  response:
    records: {jmespath: "data[]", primary_key: [id]}
    rules:
    - {action: retry, condition: response.status == 429}
    - {action: stop, condition: response.status == 403}
endpoints:
  details:
    iterate: {over: queue.ids, into: state.of}
    response:
      processors:
      - {expression: state.of, output: record.of}
      - {expression: record.id, output: state.newest, aggregation: last}
  things:
    state: {day: '{coalesce(sync.mark, "none")}'}
    sync: [mark]
    overrides: {mode: incremental}
    response:
      processors:
      - {expression: record.id, output: queue.ids, if: "!(length(record.tags) < 2)"}
      - {expression: 'date_format(record.at, "%Y-%m-%d")', output: state.mark, aggregation: maximum}
      - {expression: record.id, output: state.all, aggregation: collect}
"""


def page(endpoint, number, ids, status=200, value=None, day=1):
    data = [{"id": i, "at": f"2024-01-{day:02d}T00:00:0{i % 10}", "tags": ["a"] * (i % 3),
             "name": f"n{i}"} for i in ids]
    return (endpoint, value, number, status, json.dumps({"data": data}))


def frame(spark, pages):
    return spark.createDataFrame(pages, "endpoint string, value string, page long, status int, "
                                        "body string").repartition(3)


def test_endpoints_hand_on_queues_and_state(spark, scratch):
    spec, schemas = ApiSpec.parse(TEXT), {"things": RECORD, "details": RECORD}
    pages = [page("things", 0, [1, 2, 5]), page("things", 1, [2, 8], day=2),
             page("things", 2, [3], status=429), page("things", 3, [11], status=403),
             page("things", 4, [14]), page("other", 0, [2, 5]),
             page("details", 0, [20, 21], value="2"), page("details", 0, [22], value="4"),
             page("details", 1, [23], value="8"), page("details", 0, [24], 403, "5")]
    run = SpecRun(frame(spark, pages), spec, schemas=schemas, sync_path=f"{scratch}/sync",
                  target=f"file:{scratch}/out/{{endpoint}}.parquet")
    found = run.run()
    assert {r["id"] for r in found["things"].records.collect()} == {1, 2, 5, 8}
    assert {(r["id"], r["of"]) for r in found["details"].records.collect()} == {
        (20, "2"), (21, "2"), (23, "8")}
    assert found["details"].state["newest"] == 23
    assert {r["all"] for r in found["things"].collected["all"].collect()} == {1, 2, 5, 8}
    # A page to send again is told, not lost without a word.
    report = {(r["endpoint"], r["action"]): r["pages"] for r in run.report().collect()}
    assert report == {("things", "continue"): 3, ("things", "retry"): 1, ("things", "stop"): 1,
                      ("details", "continue"): 2, ("details", "stop"): 1}
    assert run.sync.read("things") == {"mark": "2024-01-02"}

    later = pages[:2] + [page("things", 2, [30], day=3)]
    again = SpecRun(frame(spark, later), spec, schemas=schemas, sync_path=f"{scratch}/sync",
                    target=f"file:{scratch}/out/{{endpoint}}.parquet")
    assert {r["id"] for r in again.run(["things"])["things"].records.collect()} == {30}
    assert again.sync.read("things") == {"mark": "2024-01-03"}
    from ferryline import Transfer

    loaded = Transfer(src_stream=f"file:{scratch}/out/things.parquet", spark=spark).dataframe()
    assert {r["id"] for r in loaded.collect()} == {1, 2, 5, 8, 30}


def test_specifications_without_types_values_or_responses(spark):
    spec = ApiSpec.parse(TEXT)
    found = run_spec(frame(spark, [page("things", 0, [1])]), spec)
    assert found["things"].records.columns == ["at", "id", "name", "tags"]
    assert found["details"].records.count() == 0
    with pytest.raises(TransferError):
        run_spec(frame(spark, [page("things", 0, [1], status=500)]), spec)


def test_expressions(spark):
    one = spark.sql("SELECT named_struct('t', TIMESTAMP_NTZ '2024-02-29 10:00:00', 'n', 3, "
                    "'l', array(1, 2), 's', \"it's, (so)\", 'no', CAST(NULL AS INT)) AS record")

    def value(text):
        return one.select(expression(one, text).alias("v")).first()["v"]

    assert str(value('date_add(record.t, -1, "year")')) == "2023-02-28 10:00:00"
    assert value('date_format(date_add(record.t, 1, "day"), "%Y-%m-%d")') == "2024-03-01"
    assert value("length(record.l)") == 2 and value("length(record.s)") == 10
    assert value('require(record.n, "n") + 1') == 4
    assert value("!is_null(record.no)") is False and value("!!(record.n > 2) && true") is True
    assert value('record.s == "it\'s, (so)"') is True
    assert value('coalesce(record.no, length("a,b)"), 9)') == 4
    assert value("CASE WHEN record.n in (1, 3) THEN 'x' END") == "x"
    assert str(value('date_parse("2024-05-06T07:08:09Z", "%Y-%m-%dT%H:%M:%SZ")')) == "2024-05-06 07:08:09"
    with pytest.raises(Exception, match="gone"):
        value('require(record.no, "gone")')
    for wrong in ("f(a", "a, b", "a !"):
        with pytest.raises(ValueError):
            spark_sql(wrong, lambda sql: T.StringType())


def test_state_values(spark):
    state = rendered_state(spark, {
        "base": "https://x.example", "limit": 50, "url": "{state.base}/v{state.limit}",
        "since": '{coalesce(sync.last, date_format(inputs.day, "%Y/%m"))}', "twice": "{state.limit * 2}",
        "region": '{require(inputs.region, "region required")}'},
        {"sync": {"last": None}, "inputs": {"day": "2024-03-05", "region": "eu"}})
    assert state == {"base": "https://x.example", "limit": 50, "url": "https://x.example/v50",
                     "since": "2024/03", "twice": 100, "region": "eu"}
