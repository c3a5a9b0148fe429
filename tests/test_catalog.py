"""Every query with SQL gives the same rows as DuckDB; the others run and keep their columns."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, rows_of

SQL = entry.oracle_sql()
QUERIES = entry.queries()
ROWS_ONLY = ["K2_propensity_scores", "X2_rolling_forecast", "X5_structural_decompose", "W11_factor_top_items", "G2_classify_nodes"]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, got) == rows_of(columns, cur.fetchall())


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_run(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "volatility" in df.columns
