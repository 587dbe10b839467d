"""Every catalogue query against plain SQL on the same tables."""

import compare
import pytest

import __spark_entry__ as entry_points
from diagarc.plans.catalog import QUERIES
from diagarc.plans.oracles import ORACLES

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(DIRECTORY)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    difference = compare.compare(entry_points.queries()[name](spark, DIRECTORY), con, ORACLES[name])
    assert difference is None, difference


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.columns == ["path", "name", "n", "avg_value"] and rows.count() > 0
