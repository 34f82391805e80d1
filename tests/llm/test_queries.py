"""The registered queries of the package: SQL where there is some, rows where there is none."""

import duckdb
import pytest

from clickloom.llm.oracle import llm_oracle
from clickloom.llm.queries import llm_queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(llm_oracle()))
def test_same_rows_as_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    cursor = connection.execute(llm_oracle()[name])
    columns = sorted(c[0] for c in cursor.description)
    want = [dict(zip([c[0] for c in cursor.description], row)) for row in cursor.fetchall()]
    found = llm_queries()[name](spark, SF)
    assert sorted(found.columns) == columns
    key = lambda row: str([row[c] for c in columns])
    assert sorted((r.asDict() for r in found.collect()), key=key) == [
        {c: row[c] for c in columns} for row in sorted(want, key=key)
    ]


def test_names():
    assert [name.split("_")[0] for name in llm_queries()] == [f"op{n}" for n in range(1, 14)]
