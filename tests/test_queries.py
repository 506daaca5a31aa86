"""Every registered query against its SQL on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from tickerlake import registry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con):
    assert difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["ref", "symbol", "cutoff", "category", "score", "rank"]
    assert rows.count() > 0
