"""Corpus queries against their SQL, on another engine over the same files."""

import pytest

from starmart.llm.queries import ORACLE, QUERIES
from tests.test_oracle import ROOT, pytestmark, sortable  # noqa: F401

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{ROOT}/{table}.parquet'")
    df = QUERIES[name](spark, ROOT)
    columns = sorted(df.columns)
    made = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=sortable)
    cursor = connection.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=sortable)
    assert made == expected
    assert made
