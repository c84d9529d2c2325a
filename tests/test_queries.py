"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from feedloom.checking import compare

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for name in entry.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, sql, name):
    assert compare(QUERIES[name](spark, sf_dir), sql.sql(ORACLES[name])) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["user_id", "articletype", "ids"]
