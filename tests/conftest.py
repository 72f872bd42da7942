from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql.types import StructType

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from starmart import RawZone, Source, Star  # noqa: E402
from starmart.session import local_session  # noqa: E402
from starmart.sources import chinook, northwind  # noqa: E402
from tests import data  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        4,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def make_zone(spark, tables, schemas):
    """Raw tables; columns at the end of a schema that the rows do not have are NULL."""
    frames = {}
    for name, ddl in schemas.items():
        schema = StructType.fromDDL(ddl)
        rows = [(*row, *[None] * (len(schema) - len(row))) for row in tables.get(name, [])]
        frames[name] = spark.createDataFrame(rows, schema)
    return RawZone.frames(frames)


@pytest.fixture(scope="session")
def music(spark):
    return Source(chinook.CHINOOK, make_zone(spark, data.MUSIC, chinook.RAW_SCHEMAS))


@pytest.fixture(scope="session")
def food(spark):
    return Source(northwind.NORTHWIND, make_zone(spark, data.FOOD, northwind.RAW_SCHEMAS))


@pytest.fixture(scope="session")
def star(spark, music, food):
    return Star(spark, [music, food])


@pytest.fixture
def no_broadcast(spark):
    """Joins as on data too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)
