"""Every registered query against its SQL on the smallest data set."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_its_sql(spark, duck, name):
    ok, note = compare(spark, duck, entry.queries()[name], entry.oracle_sql()[name], FOLDER)
    assert ok, note


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns[:2] == ["Site", "Workcell"]
