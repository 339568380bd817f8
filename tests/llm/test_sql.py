"""Queries of this part against their SQL twins in DuckDB."""

import duckdb
import pytest

from ledgerline.llm import queries, sql
from tools.check_oracle import TABLES, rows_of


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(sql.QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = queries.QUERIES[name](spark, sf_dir)
    result = duck.execute(sql.QUERIES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(result.fetchall(), columns)
