"""Every registered query agrees with its SQL twin; plans keep their shape."""

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerline import catalog, oracle
from tools.check_oracle import TABLES, rows_of

@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = entry.queries()[name](spark, sf_dir)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    actual = rows_of([tuple(r) for r in df.collect()], df.columns)
    assert actual == rows_of(result.fetchall(), columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(catalog.QUERIES["credit_sales_only"](spark, sf_dir))
    assert "o_orderpriority" in text and "o_totalprice" not in text
    text = plan(catalog.QUERIES["recompute_stock"](spark, sf_dir))
    assert "EqualTo(l_linestatus,O)" in text and "l_extendedprice" not in text


def test_customer_filter_passes_the_ledger_window(spark, sf_dir):
    text = plan(catalog.QUERIES["ledger_for_customer"](spark, sf_dir))
    assert "EqualTo(user_id,1)" in text


def test_top_k_does_not_sort_everything(spark, sf_dir):
    for name in ("category_top5", "top_balances", "low_stock_top10", "daily_revenue_last30"):
        assert "TakeOrderedAndProject" in plan(catalog.QUERIES[name](spark, sf_dir)), name


def test_no_cross_joins(spark, sf_dir):
    for name in ("proportional_allocation", "fifo_allocation", "invoice_aging", "price_as_of", "hour_share"):
        text = plan(catalog.QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
