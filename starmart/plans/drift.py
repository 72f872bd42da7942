"""How the schema of a source changes from load to load, and reading old and new loads alike.

Raw loads keep the columns they were delivered with. Two loads of a table are compared
by the schemas in their files; a reader sees all loads under the columns of any of
them, NULL where a load has none, if every column's types can be widened to one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from starmart.sources.spec import union_all

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


def wider(one: DataType, two: DataType) -> DataType | None:
    """The type that holds every value of both exactly, None if there is none."""
    if one == two:
        return one
    kinds = type(one), type(two)
    if all(k in _WHOLE for k in kinds):
        return one if _WHOLE.index(kinds[0]) > _WHOLE.index(kinds[1]) else two
    if set(kinds) == {FloatType, DoubleType}:
        return DoubleType()
    if DecimalType in kinds:
        parts = []
        for t in (one, two):
            if isinstance(t, DecimalType):
                parts.append((t.precision - t.scale, t.scale))
            elif type(t) in _DIGITS:
                parts.append((_DIGITS[type(t)], 0))
            else:
                return None
        whole, scale = (max(p[k] for p in parts) for k in (0, 1))
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def load_schema(spark: SparkSession, path: str, source: str, table: str, load: str) -> StructType | None:
    """The schema in the files of one retained load, None if the load has no such table."""
    try:
        return spark.read.parquet(f"{path}/{source}/{table}/load={load}").schema
    except Exception as e:  # a load without the table has no folder or no file
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def compared(before: StructType | None, after: StructType | None) -> list[tuple[str, str, str | None, str | None]]:
    """(column, change, type before, type after) of columns that are not alike in both.

    added, gone; widened: every old value has its place in the new type; narrowed: the
    other way round; retyped: neither. Names are compared as Spark resolves them, by
    any case; a new spelling is renamed.
    """
    old = {f.name.lower(): f for f in (before or StructType())}
    new = {f.name.lower(): f for f in (after or StructType())}
    out = []
    for key in sorted(old.keys() | new.keys()):
        a, b = old.get(key), new.get(key)
        if a is None:
            out.append((b.name, "added", None, b.dataType.simpleString()))
        elif b is None:
            out.append((a.name, "gone", a.dataType.simpleString(), None))
        elif a.dataType != b.dataType:
            both = wider(a.dataType, b.dataType)
            change = "widened" if both == b.dataType else "narrowed" if both == a.dataType else "retyped"
            out.append((b.name, change, a.dataType.simpleString(), b.dataType.simpleString()))
        elif a.name != b.name:
            out.append((b.name, "renamed", a.dataType.simpleString(), b.dataType.simpleString()))
    return out


def schema_drift(
    spark: SparkSession, path: str, source: str, tables: Sequence[str], before: str, after: str
) -> DataFrame:
    """TableName, ColumnName, Change, TypeBefore, TypeAfter between two retained loads of a source.

    Only the files' schemas are read. A table that one load lacks is all added or gone.
    """
    rows = []
    for table in tables:
        pair = (load_schema(spark, path, source, table, load) for load in (before, after))
        rows += [(table, *change) for change in compared(*pair)]
    return spark.createDataFrame(
        rows, "TableName string, ColumnName string, Change string, TypeBefore string, TypeAfter string"
    )


def merged_schema(schemas: Sequence[StructType]) -> StructType:
    """The columns of all schemas, in order of appearance, each as wide as it has to be.

    A column whose types nothing holds both of is text. All are nullable: a load may not have them.
    """
    fields: dict[str, StructField] = {}
    for schema in schemas:
        for f in schema:
            known = fields.get(f.name.lower())
            kind = f.dataType if known is None else wider(known.dataType, f.dataType) or StringType()
            fields[f.name.lower()] = StructField(known.name if known else f.name, kind, True)
    return StructType(list(fields.values()))


def read_loads(spark: SparkSession, path: str, source: str, table: str, loads: Sequence[str]) -> DataFrame:
    """Rows of several retained loads under one schema, with ``load``; columns a load lacks are NULL.

    Each load is read with the types of its files and cast to the common ones: no file
    is written again when a column comes or goes.
    """
    found = {load: load_schema(spark, path, source, table, load) for load in loads}
    schema = merged_schema([s for s in found.values() if s is not None])
    parts = []
    for load, own in found.items():
        if own is None:
            continue
        names = {f.name.lower(): f.name for f in own}
        rows = spark.read.schema(own).parquet(f"{path}/{source}/{table}/load={load}")
        columns = [
            (F.col(f"`{names[f.name.lower()]}`") if f.name.lower() in names else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
        parts.append(rows.select(*columns, F.lit(load).alias("load")))
    if not parts:
        return spark.createDataFrame([], StructType([*schema.fields, StructField("load", StringType())]))
    return union_all(parts)
