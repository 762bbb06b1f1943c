"""Every registered query against its SQL in DuckDB."""

import pytest
from compare import difference, duckdb_connection

import __spark_entry__
from plumbline.plans import catalog, oracles

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duckdb_connection(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_all_are_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_anomalies_are_found(spark):
    assert QUERIES["revenue_anomalies_one_deviation"](spark, FOLDER).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 24


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, connection, name):
    assert difference(spark, connection, QUERIES[name], ORACLES[name], FOLDER) is None
