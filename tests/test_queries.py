"""Every registered query against its SQL over whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from msgflow.plans import batch, streams

NAMES = [*batch.QUERIES, *streams.QUERIES]
SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    result = entry.queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in result.collect()]
    expected = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert canonical(result.columns, rows) == canonical(columns, expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
