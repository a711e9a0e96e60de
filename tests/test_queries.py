"""Every query with an SQL twin gives the same rows on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_queries import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF).startswith("ok")


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["source_ip", "failed_logins", "peak_in_window", "users"] and result.count() > 0


def test_twins_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
