"""The five conformed dimensions, each the union of what every source contributes."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from starmart.functions import calendar_columns, canonical_key, money, parse_date
from starmart.schema import (
    DIM_CUSTOMER,
    DIM_EMPLOYEE,
    DIM_PRODUCT,
    DIM_SOURCE_SYSTEM,
    DIM_TIME,
    conform,
)
from starmart.sources.spec import Mapped, Source, union_all


def dim_source_system(spark: SparkSession, sources: Sequence[Source]) -> DataFrame:
    """One member per source, as a literal table that Catalyst can see into."""
    args: dict[str, int | str] = {}
    for i, source in enumerate(sources):
        args[f"id{i}"], args[f"name{i}"] = source.spec.system_id, source.spec.name
    values = ", ".join(f"(:id{i}, :name{i})" for i in range(len(sources)))
    members = spark.sql(f"SELECT * FROM VALUES {values} AS t(SourceSystemID, SourceSystemName)", args)
    return conform(members, DIM_SOURCE_SYSTEM)


def _members(
    mapped: Mapped, prefix: str, keys: Sequence[str], schema: StructType, only: Collection[str] | None
) -> DataFrame:
    """The dimension's rows; with ``only`` just these columns, without lookups they do not need."""
    if only is not None:
        schema = StructType([f for f in schema.fields if f.name in only])
    df, types = mapped.evaluated(only)
    made = {k: canonical_key(prefix, F.col(k), types[k]) for k in keys if k in types}
    if "UnitPrice" in types:
        made["UnitPrice"] = money(F.col("UnitPrice"))
    return conform(df.withColumns(made), schema)


def customers_of(source: Source, only: Collection[str] | None = None) -> DataFrame:
    spec = source.spec
    return _members(spec.customers(source.raw), spec.prefix, ("CustomerID",), DIM_CUSTOMER, only)


def employees_of(source: Source, only: Collection[str] | None = None) -> DataFrame:
    spec = source.spec
    return _members(
        spec.employees(source.raw), spec.prefix, ("EmployeeID", "ReportsTo"), DIM_EMPLOYEE, only
    )


def products_of(source: Source, only: Collection[str] | None = None) -> DataFrame:
    spec = source.spec
    return _members(spec.products(source.raw), spec.prefix, ("ProductID",), DIM_PRODUCT, only)


def dates_of(source: Source) -> DataFrame:
    """Usable calendar dates of the source's headers, repeats included."""
    df, types = source.spec.dates(source.raw).evaluated()
    days = df.select(parse_date(F.col("OrderDate"), types["OrderDate"]).alias("FullDate"))
    return days.where(F.col("FullDate").isNotNull())


def dim_customer(sources: Sequence[Source], only: Collection[str] | None = None) -> DataFrame:
    return union_all(customers_of(s, only) for s in sources)


def dim_employee(sources: Sequence[Source], only: Collection[str] | None = None) -> DataFrame:
    return union_all(employees_of(s, only) for s in sources)


def dim_product(sources: Sequence[Source], only: Collection[str] | None = None) -> DataFrame:
    return union_all(products_of(s, only) for s in sources)


def calendar(days: DataFrame) -> DataFrame:
    """DimTime rows of the distinct dates in ``FullDate``.

    Built from headers, never from lines; each task reduces its share to the
    distinct dates before anything is shuffled.
    """
    columns = calendar_columns(F.col("FullDate"))
    return conform(days.distinct().select(*[c.alias(n) for n, c in columns.items()]), DIM_TIME)


def dim_time(sources: Sequence[Source]) -> DataFrame:
    """Only the dates that occur in some source."""
    return calendar(union_all(dates_of(s) for s in sources))
