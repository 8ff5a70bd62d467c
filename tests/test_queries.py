"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from tests.compare import connect, differences
from weftmart.queries import REGISTRY

SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def database(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(name, spark, folder, database):
    result = driver.queries()[name](spark, folder)
    assert name in SQL, "a query without SQL needs a test of its own"
    assert differences(result, database, SQL[name]) is None


def test_comparison_notices_differences(spark, folder, database):
    rows = driver.queries()["f12_source_keys"](spark, folder)
    assert differences(rows, database, "SELECT c_custkey + 1 AS c_custkey FROM customer") is not None
    assert differences(rows, database, "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey FROM customer") is not None
    assert differences(rows, database, "SELECT c_custkey AS other FROM customer") is not None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
