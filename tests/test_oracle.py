"""Every registered query against its SQL, on another engine over the same files."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from starmart.plans.catalogue import QUERIES

duckdb = pytest.importorskip("duckdb")

ROOT = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

pytestmark = pytest.mark.skipif(not Path(ROOT).exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def connection():
    made = duckdb.connect()
    for table in TABLES:
        made.execute(f"CREATE VIEW {table} AS SELECT * FROM '{ROOT}/{table}.parquet'")
    return made


def sortable(row):
    return tuple((v is None, "" if v is None else v) for v in row)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    df = driver.queries()[name](spark, ROOT)
    columns = sorted(df.columns)
    made = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=sortable)
    cursor = connection.execute(driver.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=sortable)
    assert made == expected
    assert made, "a query that returns nothing checks nothing"


def test_entry(spark):
    assert driver.entry(spark).count() == 2
