"""Every registered query against its SQL in DuckDB, on all rows of the given tables."""

import duckdb
import pytest

import __spark_entry__ as spark_entry
from nestweave.plans.queries import QUERIES, SQL

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    yield connection
    connection.close()


def rows(table):
    columns = sorted(table.column_names)
    return sorted(map(repr, zip(*[table[c].to_pylist() for c in columns], strict=True)))


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(SQL) <= set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, sf_dir, name):
    got = spark_entry.queries()[name](spark, sf_dir).toArrow()
    want = duck.sql(spark_entry.oracle_sql()[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert got.num_rows == want.num_rows > 0
    assert rows(got) == rows(want)


def test_entry(spark):
    result = spark_entry.entry(spark)
    assert result.columns == [
        "domain", "order_key", "id", "line_number", "quantity", "enrich"
    ]
    assert result.count() > 0
