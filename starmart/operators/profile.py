"""Inventories and profiles of raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starmart.sources.spec import Source, union_all

SYSTEM_TABLE_PREFIX = "sqlite_"


def system_tables(names: Sequence[str], prefix: str = SYSTEM_TABLE_PREFIX) -> list[str]:
    """The tables among ``names`` that belong to the storage system, not to the business."""
    return sorted(n for n in names if n.lower().startswith(prefix))


def table_inventory(sources: Sequence[Source], system_prefix: str = SYSTEM_TABLE_PREFIX) -> DataFrame:
    """Records and columns of every business table as delivered; those of the storage system are not read."""
    tables = []
    for source in sources:
        left_out = system_tables(source.spec.tables, system_prefix)
        for name in source.spec.tables:
            if name in left_out:
                continue
            df = source.raw.delivered(name)
            tables.append(
                df.agg(F.count("*").alias("RecordCount")).select(
                    F.lit(source.spec.name).alias("SourceSystem"),
                    F.lit(name).alias("TableName"),
                    "RecordCount",
                    F.lit(len(df.columns)).alias("ColumnCount"),
                )
            )
    return union_all(tables)


def source_inventory(sources: Sequence[Source]) -> DataFrame:
    """Tables, columns, declared relationships and records per source."""
    relationships = F.lit(None).cast("bigint")
    for source in sources:
        count = F.lit(len(source.spec.foreign_keys)).cast("bigint")
        relationships = F.when(F.col("SourceSystem") == source.spec.name, count).otherwise(relationships)
    return (
        table_inventory(sources)
        .groupBy("SourceSystem")
        .agg(
            F.count("*").alias("TableCount"),
            F.sum("ColumnCount").alias("ColumnCount"),
            F.sum("RecordCount").alias("RecordCount"),
        )
        .withColumn("RelationshipCount", relationships)
    )


def profile_table(name: str, df: DataFrame, primary_key: Sequence[str] = ()) -> DataFrame:
    """Type, declared nullability, key membership, filled and missing values of each column: one pass."""
    counts = df.agg(F.count("*").alias("RowCount"), *[F.count(c).alias(c) for c in df.columns])
    long = counts.unpivot(["RowCount"], df.columns, "ColumnName", "FilledRows")
    types = F.create_map(
        *[F.lit(v) for f in df.schema.fields for v in (f.name, f.dataType.simpleString())]
    )
    nullable = [f.name for f in df.schema.fields if f.nullable]
    return long.select(
        F.lit(name).alias("TableName"),
        "ColumnName",
        types[F.col("ColumnName")].alias("DataType"),
        F.col("ColumnName").isin(nullable).alias("Nullable"),
        F.col("ColumnName").isin(list(primary_key)).alias("IsPrimaryKey"),
        "RowCount",
        "FilledRows",
        (F.col("RowCount") - F.col("FilledRows")).alias("MissingRows"),
    )


def profile_columns(sources: Sequence[Source]) -> DataFrame:
    """The column inventory of every source as delivered, with what its data holds."""
    profiles = []
    for source in sources:
        for name in source.spec.tables:
            keys = source.spec.primary_keys.get(name, ())
            profile = profile_table(name, source.raw.delivered(name), keys)
            profiles.append(profile.withColumn("SourceSystem", F.lit(source.spec.name)))
    return union_all(profiles)


def pk_uniqueness(source: Source) -> DataFrame:
    """Whether each declared primary key of a source is unique and filled on its data.

    Rows are counted per key and the counts summed up, so a key that holds a
    large share of the rows is one row per task in the shuffle.
    """
    checks = []
    for name, keys in source.spec.primary_keys.items():
        copies = source.raw.table(name).groupBy(*keys).agg(F.count("*").alias("Copies"))
        filled = F.lit(True)
        for key in keys:
            filled = filled & F.col(key).isNotNull()
        checks.append(
            copies.agg(
                F.lit(source.spec.name).alias("SourceSystem"),
                F.lit(name).alias("TableName"),
                F.lit(",".join(keys)).alias("KeyColumns"),
                F.coalesce(F.sum("Copies"), F.lit(0)).alias("RecordCount"),
                F.count_if(filled).alias("DistinctKeys"),
                F.count_if(filled & (F.col("Copies") > 1)).alias("RepeatedKeys"),
                F.coalesce(F.sum(F.when(~filled, F.col("Copies"))), F.lit(0)).alias("NullKeyRows"),
            ).withColumn(
                "IsPrimaryKey", (F.col("RepeatedKeys") == 0) & (F.col("NullKeyRows") == 0)
            )
        )
    return union_all(checks)
