"""Counts and bounds of stored tables from the footers of their Parquet files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_V1 = "spark.sql.sources.useV1SourceList"
_PUSHED = "spark.sql.parquet.aggregatePushdown"


@contextmanager
def footers(spark: SparkSession) -> Iterator[None]:
    """While this holds, COUNT, MIN and MAX over whole Parquet tables are answered from footers.

    Spark's newer Parquet source does it; the settings are put back after, as it can't
    prune by what a join finds.
    """
    before = {name: spark.conf.get(name) for name in (_V1, _PUSHED)}
    kept = [x for x in before[_V1].split(",") if x.strip() and x.strip() != "parquet"]
    spark.conf.set(_V1, ",".join(kept))
    spark.conf.set(_PUSHED, "true")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def bounds(spark: SparkSession, paths: Sequence[str], schema: StructType, column: str, given: str) -> DataFrame:
    """low, high, n: least and greatest value of a column over some Parquet tables, and their rows.

    ``given`` is a condition on the tables' folders that leaves out files in which the
    column is NULL throughout: their footers have no bounds. Run it within ``footers``,
    then no row is read.
    """
    parts = []
    for path in paths:
        df = spark.read.schema(schema).parquet(path)
        parts.append(df.agg(F.count(F.lit(1)).alias("n")))
        parts.append(df.where(given).agg(F.min(column).alias("low"), F.max(column).alias("high")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
