"""Every registered query against its SQL on DuckDB."""

import pytest

from checks import compare
from checks.duckdb_sql import SQL
from checks.spark_queries import QUERIES


@pytest.fixture(scope="module")
def duck(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, small, name):
    assert compare.difference(spark, duck, small, name) is None


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry_points(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).columns == ["attack_category", "count", "percentage"]
    assert set(driver.queries()) >= set(QUERIES)
    assert set(driver.oracle_sql()) >= set(SQL)
