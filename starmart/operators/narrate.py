"""Fact rows as English sentences."""

from __future__ import annotations

import os.path

from pyspark.sql import Column, DataFrame, functions as F

from starmart.operators.joins import lookup
from starmart.schema import FACT_SALES


#: What the sentences read of the members.
NAMES = {
    "DimCustomer": ("CustomerID", "CustomerName"),
    "DimEmployee": ("EmployeeID", "EmployeeName", "Title"),
    "DimProduct": ("ProductID", "ProductName"),
}


def describe_fact_rows(
    fact: DataFrame,
    dim_customer: DataFrame,
    dim_employee: DataFrame,
    dim_product: DataFrame,
    dim_time: DataFrame,
    dim_source_system: DataFrame,
) -> DataFrame:
    """The given fact rows with their ``Sentence``; all rows at once, by left lookups.

    A member that cannot be found, or has no name, is "an unknown ..."; a line
    whose date is not in DimTime shows its DateKey; the employee clause needs an
    employee that is found, its title is optional. Texts are made after the last
    lookup, and what is broadcast is looked up last: lines that meet members too large
    for a broadcast are shuffled bare, with the names found so far. A fact that brings
    its ``CustomerName`` (``named_sales``: found per header) is not shuffled for it.

    DimTime and DimSourceSystem are broadcast. The calendar bounds the first:
    four-digit years hold 3.7 million dates, a century 36,525. The second has one
    row per registered source. The other dimensions grow with the data and are
    broadcast only if Spark finds them small.
    """
    dates = dim_time.select(
        "DateKey", F.date_format("FullDate", "MMMM d, yyyy").alias("__date")
    )
    customers = dim_customer.select("CustomerID", F.col("CustomerName").alias("__customer"))
    products = dim_product.select("ProductID", F.col("ProductName").alias("__product"))
    employees = dim_employee.select(
        "EmployeeID", F.col("EmployeeName").alias("__employee"), F.col("Title").alias("__title")
    )

    if "CustomerName" in fact.columns:
        rows = fact.withColumnRenamed("CustomerName", "__customer")
    else:
        rows = lookup(fact, customers, "CustomerID")
    rows = lookup(rows, employees, "EmployeeID")
    rows = lookup(rows, products, "ProductID")
    rows = rows.join(F.broadcast(dates), "DateKey", "left").join(
        F.broadcast(dim_source_system), "SourceSystemID", "left"
    )

    title = F.when(
        F.col("__title").isNotNull(), F.concat(F.lit(" ("), F.col("__title"), F.lit(")"))
    ).otherwise("")
    employee = F.concat(F.lit(", with the order attributed to "), F.col("__employee"), title)

    # The wording of the sentence.
    sentence = F.concat(
        F.lit("On "),
        F.coalesce(F.col("__date"), F.col("DateKey").cast("string"), F.lit("<NA>")),
        F.lit(", one "),
        F.coalesce(F.col("SourceSystemName"), F.lit("an unknown source")),
        F.lit(" sales line item recorded customer "),
        F.coalesce(F.col("__customer"), F.lit("an unknown customer")),
        F.lit(" purchasing "),
        F.col("SalesQuantity").cast("string"),
        F.lit(" unit(s) of "),
        F.coalesce(F.col("__product"), F.lit("an unknown product")),
        F.lit(" for a SalesAmount of "),
        F.format_number("SalesAmount", 2),
        F.coalesce(employee, F.lit("")),
        F.lit("."),
    )
    return rows.select(*FACT_SALES.names, sentence.alias("Sentence"))


#: Rows that may be put in order by one task.
FEW = 10_000
#: Groups counted at once.
CELLS = 2_000


def _cells(column: str, low: object, high: object) -> Column:
    """Cells of a column between two bounds, in its order and not too many."""
    if isinstance(low, str):
        return F.substring(column, 1, len(os.path.commonprefix([low, high])) + 2)
    if high - low < CELLS:
        return F.col(column)
    return F.floor((F.col(column) - F.lit(low)) / F.lit((high - low) // CELLS + 1))


def nth_fact_row(fact: DataFrame, n: int, few: int = FEW) -> DataFrame:
    """One row of the (filtered) fact by position, counted from 0 in the order of all columns.

    Rows are counted by the leading column's values, then only those with the value
    that holds the position are counted by the next column, and so on, until ``few``
    rows are left to be put in order. Nothing is sorted but these, and nothing is
    written: what comes to the driver are counts, per day (bounded by the calendar),
    per two more letters of a text, or per CELLS parts of a range of numbers. A
    position beyond the last row gives no row.
    """
    rows = fact
    for column in FACT_SALES.names:
        at = F.col(column)
        cells = at if column == "DateKey" else at.isNull()
        while True:
            counted = (
                rows.groupBy(cells.alias("cell"))
                .agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("low"), F.max(at).alias("high"))
                .collect()
            )
            for cell in sorted(counted, key=lambda r: (r.low is not None, r.low)):
                if n < cell.n:
                    break
                n -= cell.n
            else:
                return fact.limit(0)
            inside = at.isNull() if cell.low is None else (at >= F.lit(cell.low)) & (at <= F.lit(cell.high))
            rows = rows.where(inside)
            if cell.n <= few:
                return rows.orderBy(*FACT_SALES.names).offset(n).limit(1)
            if cell.low == cell.high:
                break
            cells = _cells(column, cell.low, cell.high)
    # All that are left are equal.
    return rows.limit(1)
