"""Every registered query against its SQL on the given tables."""

import pytest

import __spark_entry__ as entry_points
from tests.oracle import compare, data_dir

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    sf_dir = data_dir()
    problem, rows = compare(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir)
    assert problem is None, problem
    assert rows > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, data_dir()).count() > 0


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["date", "sales", "is_forecast"]
    assert result.count() > 0
