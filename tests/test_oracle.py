"""Every registered query against the same query in SQL on another engine."""

import math
import os

import duckdb
import pytest

from clickloom.plans.oracle import oracle_queries
from clickloom.plans.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = all_queries()
ORACLE = oracle_queries()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in sorted(os.listdir(SF_DIR)):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{name}')")
    return connection


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(normal(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((value is not None, str(type(value)), str(value)) for value in row),
    )


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLE[name])
    columns = [column[0] for column in cursor.description]
    expected = rows_of(columns, cursor.fetchall())
    assert sorted(result.columns) == sorted(columns)
    found = rows_of(result.columns, [tuple(row) for row in result.collect()])
    assert len(found) == len(expected)
    assert found == expected
    assert found, "the query gives no rows"
