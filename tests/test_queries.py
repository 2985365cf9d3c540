"""Every registered query against its SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracles import TABLES, as_rows


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(entry.registered.queries()))
def test_query_equals_sql(spark, db, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert as_rows(df.columns, [tuple(r) for r in df.collect()]) == as_rows(columns, cursor.fetchall())


def test_every_query_has_sql():
    assert set(entry.registered.queries()) == set(entry.oracles.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
