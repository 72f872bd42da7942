"""Join helpers that hold up under hot and missing keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

NULL_SPREAD = 1024


def spread_nulls(key: Column, *varying: str) -> Column:
    """The key, with NULLs replaced by one of many values that match nothing.

    An outer join keeps rows whose key is NULL, and a shuffle would send all of
    them to one task. Canonical ids always hold a colon, the stand-ins never do.
    """
    bucket = F.pmod(F.xxhash64(*varying), F.lit(NULL_SPREAD))
    return F.coalesce(key.cast("string"), F.concat(F.lit("null/"), bucket.cast("string")))


def lookup(rows: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Left lookup of a dimension by canonical id for rows that were not aggregated.

    Whether the dimension is broadcast is left to Spark, which checks its size;
    beyond the threshold the sort-merge join splits a hot key under AQE.
    ``dim`` must bring its key and attributes under names ``rows`` does not use,
    apart from the key.
    """
    probe = "__probe"
    member = dim.withColumnRenamed(dim_key or key, probe)
    varying = [c for c in rows.columns if c != key]
    joined = rows.join(member, spread_nulls(rows[key], *varying) == member[probe], "left")
    return joined.drop(probe)
