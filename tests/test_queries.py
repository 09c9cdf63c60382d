"""Every named query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests import compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_equals_sql(spark, con, name):
    same, note = compare.compare(spark, con, name, SF)
    assert same, note


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
