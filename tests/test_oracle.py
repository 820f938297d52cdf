"""Every registered query against its SQL."""

import pytest

import __spark_entry__
from scenarios import base, check


@pytest.fixture(scope="module")
def duck(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(base.QUERIES))
def test_query_agrees_with_sql(spark, duck, sf_dir, name):
    assert check.compare(spark, duck, name, sf_dir) == []


def test_every_query_has_sql():
    assert sorted(base.QUERIES) == sorted(base.ORACLE)


def test_entry(spark):
    found = __spark_entry__.entry(spark)
    assert found.columns == ["o_orderstatus", "n_orders", "total_price"]
    assert {r["o_orderstatus"] for r in found.collect()} >= {"X"}
