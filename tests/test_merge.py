"""Merge laws, checked against a plain Python model."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferryline.operators.merge import dedupe_latest, merge
from tests.conftest import rows

SCHEMA = "k bigint, v string, n bigint"
KEYS = st.one_of(st.none(), st.integers(0, 6))
TARGET = st.lists(st.tuples(KEYS, st.sampled_from("abc"), st.integers(0, 3)), max_size=8,
                  unique_by=lambda r: r[0] if r[0] is not None else object())
SOURCE = st.lists(st.tuples(KEYS, st.sampled_from("xyz"), st.integers(4, 9)), max_size=8,
                  unique_by=lambda r: r[0] if r[0] is not None else object())
LAWS = settings(max_examples=6, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


def model(target, source, strategy):
    keys_t = {r[0] for r in target if r[0] is not None}
    keys_s = {r[0] for r in source if r[0] is not None}
    new = [r for r in source if r[0] is None or r[0] not in keys_t]
    hit = [r for r in source if r[0] in keys_t and r[0] is not None]
    rest = [r for r in target if r[0] is None or r[0] not in keys_s]
    if strategy == "insert":
        return sorted(target + new, key=repr)
    if strategy == "update":
        return sorted(rest + hit, key=repr)
    return sorted(rest + hit + new, key=repr)


def merged(spark, target, source, strategy):
    df = merge(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA), "k",
               strategy)
    return sorted((tuple(r) for r in df.select("k", "v", "n").collect()), key=repr)


@pytest.mark.parametrize("strategy", ["update_insert", "delete_insert", "insert", "update"])
@LAWS
@given(target=TARGET, source=SOURCE)
def test_strategies_follow_the_model(spark, strategy, target, source):
    assert merged(spark, target, source, strategy) == model(target, source, strategy)


@LAWS
@given(target=TARGET, source=SOURCE)
def test_update_insert_is_update_then_insert(spark, target, source):
    """With partial columns, so the update and insert parts are separate joins."""
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA).select("k", "v").where("k is not null")
    both = merge(t, s, "k", "update_insert")
    steps = merge(merge(t, s, "k", "update"), s, "k", "insert")
    assert rows(both) == rows(steps)


def test_second_merge_changes_nothing(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA)
    s = spark.createDataFrame([(2, "x", 5), (3, "y", 5)], SCHEMA)
    for strategy in ("update_insert", "delete_insert", "insert", "update"):
        once = merge(t, s, "k", strategy)
        assert rows(merge(once, s, "k", strategy)) == rows(once)


def test_null_wins_and_absent_columns_stay(spark):
    t = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    s = spark.createDataFrame([(1, None)], "k bigint, v string")
    assert rows(merge(t, s, "k")) == [(1, 1, None)]


def test_delete_missing(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "c", 1)], SCHEMA)
    s = spark.createDataFrame([(2, "x", 5), (3, "y", 5)], SCHEMA)
    expect = {"update_insert": [(2, 5, "x"), (3, 5, "y")], "insert": [(2, 1, "b"), (3, 5, "y")],
              "update": [(2, 5, "x")], "delete_insert": [(2, 5, "x"), (3, 5, "y")]}
    for strategy, want in expect.items():
        assert rows(merge(t, s, "k", strategy, delete_missing=True)) == want


def test_repeated_source_keys(spark):
    t = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    s = spark.createDataFrame([(1, "x", 5), (1, "y", 7)], SCHEMA)
    with pytest.raises(ValueError, match="1 source keys"):
        merge(t, s, "k")
    assert rows(merge(t, s, "k", update_key="n")) == [(1, 7, "y")]
    assert len(rows(merge(t, s, "k", "delete_insert"))) == 2


def test_keys_of_different_number_types_match(spark):
    t = spark.createDataFrame([(1, "a", 1)], "k int, v string, n bigint")
    s = spark.createDataFrame([(1, "x", 5)], SCHEMA)
    assert rows(merge(t, s, "k")) == [(1, 5, "x")]


def test_dedupe_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 1), (None, "c", 1)], SCHEMA)
    assert rows(dedupe_latest(df, "k", "n")) == [(1, 2, "b"), (None, 1, "c"), (None, 1, "c")]


def test_arguments_are_checked(spark):
    t = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    with pytest.raises(ValueError, match="primary_key"):
        merge(t, t, [])
    with pytest.raises(ValueError, match="missing"):
        merge(t, t, "other")
    with pytest.raises(ValueError, match="not in the target"):
        merge(t, t.withColumn("extra", F.lit(1)), "k")
