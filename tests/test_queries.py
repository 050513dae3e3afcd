"""Every registered query at the smallest scale against its oracle SQL in DuckDB."""

import pytest

import compare
from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    message, ok = compare.compare(spark, con, SF, name, queries()[name], oracle_sql().get(name))
    assert ok, message


def test_entry(spark):
    assert entry(spark).count() > 0
