"""FactSales: one row per sales line item of every source."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StructType

from starmart.functions import (
    canonical_key,
    line_amount,
    money,
    quantity,
    surely_fits,
)
from starmart.operators.joins import lookup
from starmart.schema import FACT_SALES, conform
from starmart.sources.spec import Source, union_all

#: What header sales share with the fact.
HEADER_COLUMNS = ("DateKey", "CustomerID", "SourceSystemID", "SalesQuantity", "SalesAmount")


def _measured(types: dict[str, DataType]) -> tuple[Column, Column, Column]:
    """Price (or amount) as delivered, the amount, and whether both measures have a value."""
    units = F.col("Quantity")
    if "Amount" in types:
        price, amount = F.col("Amount"), money(F.col("Amount"))
        sizes, inputs = [units, price], ["Quantity", "Amount"]
    else:
        price = F.col("UnitPrice")
        amount = line_amount(price, units)
        product = price.cast("double") * units.cast("double")
        sizes, inputs = [units, price, product], ["Quantity", "UnitPrice"]
    exact = quantity(units).isNotNull() & amount.isNotNull()
    return price, amount, surely_fits(sizes, [types[name] for name in inputs]) | exact


def staged_sales(source: Source, how: str = "inner", carried: Sequence[str] = ()) -> DataFrame:
    """Joined lines of one source: the fact columns next to the values they came from.

    With ``how`` "left" lines that find no header or customer are there too, their
    ``Matched`` is false. Columns of the joined rows named in ``carried`` come along.

    Unusable dates and measures are NULL here; ``Usable`` tells whether both
    measures have a value. The quality operators read the raw columns, the fact
    leaves them out and they are pruned from the scan.
    """
    spec = source.spec
    mapped = spec.sales(source.raw, how)
    rules = mapped.rules | {name: F.col(name) for name in carried}
    df, types = replace(mapped, rules=rules).evaluated()

    def key(target: str) -> Column:
        return canonical_key(spec.prefix, F.col(target), types[target]).alias(target)

    units = F.col("Quantity")
    price, amount, usable = _measured(types)
    matched = ["Matched"] if how == "left" else []
    return df.select(
        *matched,
        "LineKey",
        F.col("OrderDate").cast("string").alias("RawDate"),
        units.cast("string").alias("RawQuantity"),
        price.cast("string").alias("RawPrice"),
        "DateKey",
        key("CustomerID"),
        key("EmployeeID"),
        key("ProductID"),
        F.lit(spec.system_id).alias("SourceSystemID"),
        quantity(units).alias("SalesQuantity"),
        amount.alias("SalesAmount"),
        usable.alias("Usable"),
        *carried,
    )


def sales_of(source: Source) -> DataFrame:
    """Lines with usable measures. Other lines go to quarantine, they are never patched."""
    return conform(staged_sales(source).where("Usable"), FACT_SALES)


def fact_sales(sources: Sequence[Source]) -> DataFrame:
    """All sources. The measure columns are never NULL, the keys of a line may be."""
    return union_all(sales_of(s) for s in sources)


def named_sales_of(source: Source, customers: DataFrame) -> DataFrame:
    """The source's sales with the attributes in ``customers``, a left lookup by CustomerID.

    A source with headers looks them up once per header, below the join with its lines.
    """
    spec = source.spec
    if spec.header_customer is None:
        return lookup(sales_of(source), customers, "CustomerID")
    table, column = spec.header_customer
    headers = source.raw.table(table)
    key = canonical_key(spec.prefix, F.col(column), headers.schema[column].dataType)
    names = [c for c in customers.columns if c != "CustomerID"]
    found = lookup(headers.withColumn("CustomerID", key), customers, "CustomerID").drop("CustomerID")
    lines = staged_sales(Source(spec, source.raw.replacing(**{table: found})), carried=names)
    return conform(lines.where("Usable"), StructType([*FACT_SALES, *[customers.schema[c] for c in names]]))


def named_sales(sources: Sequence[Source], customers: DataFrame) -> DataFrame:
    """The fact with the attributes in ``customers``, as lookup() on it would give."""
    return union_all(named_sales_of(s, customers) for s in sources)


def header_sales_of(source: Source) -> DataFrame:
    """The source's sales without what only lines know, summed per header below the join.

    A hot header reaches the join as one row per task, and a header with many lines
    as one row. A source without headers gives its lines.
    """
    spec = source.spec
    if spec.header_sales is None:
        return sales_of(source).select(*HEADER_COLUMNS, F.lit(1).cast("bigint").alias("Lines"))
    parts = spec.header_sales(source.raw)
    lines, types = parts.lines.evaluated()
    _, amount, usable = _measured(types)
    sums = (
        lines.where(usable)
        .select("HeaderKey", quantity(F.col("Quantity")).alias("SalesQuantity"), amount.alias("SalesAmount"))
        .groupBy("HeaderKey")
        .agg(
            F.sum("SalesQuantity").alias("SalesQuantity"),
            F.sum("SalesAmount").alias("SalesAmount"),
            F.count(F.lit(1)).alias("Lines"),
        )
    )
    headers, header_types = parts.headers.evaluated()
    key = canonical_key(spec.prefix, F.col("CustomerID"), header_types["CustomerID"])
    keyed = headers.withColumn("CustomerID", key)
    joined = sums.join(keyed, "HeaderKey").withColumn("SourceSystemID", F.lit(spec.system_id))
    return joined.select(*HEADER_COLUMNS, "Lines")


def sold_dates_of(source: Source) -> DataFrame:
    """DateKey of the source's headers that have a line in the fact; lines are only looked up, not summed."""
    spec = source.spec
    if spec.header_sales is None:
        return sales_of(source).select("DateKey")
    parts = spec.header_sales(source.raw)
    lines, types = parts.lines.evaluated()
    _, _, usable = _measured(types)
    # Distinct first: a header with very many lines is one row per task.
    sold = lines.where(usable).select("HeaderKey").distinct()
    headers, _ = parts.headers.evaluated(("HeaderKey", "DateKey"))
    return headers.join(sold, "HeaderKey", "left_semi").select("DateKey")


def sold_dates(sources: Sequence[Source]) -> DataFrame:
    return union_all(sold_dates_of(s) for s in sources)


def header_sales(sources: Sequence[Source]) -> DataFrame:
    """All sources: for reports on source, date and customer, whose sums need no single line."""
    return union_all(header_sales_of(s) for s in sources)
