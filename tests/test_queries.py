"""Every registered query against its SQL on the smallest data set."""

import pytest
from conftest import SF_DIR
from oracle_check import compare, duck

import __spark_entry__
from catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    problem, _, _ = compare(spark, connection, name, SF_DIR)
    assert problem is None


def test_contract(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns == [
        "symbol", "date", "low", "high", "volume", "factor", "pe"]
    assert set(ORACLES) == set(QUERIES)  # every query has its SQL
