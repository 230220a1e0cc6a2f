"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF))
    expected_columns, expected = duck_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
