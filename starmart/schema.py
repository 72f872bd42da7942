"""Target schemas of the star. Column order is part of the contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(18, 2)


def _table(**columns) -> StructType:
    """``name=type`` or ``name=(type, False)`` for a column that must not be NULL."""
    fields = []
    for name, spec in columns.items():
        data_type, nullable = spec if isinstance(spec, tuple) else (spec, True)
        fields.append(StructField(name, data_type, nullable))
    return StructType(fields)


_TEXT, _INT, _LONG = StringType(), IntegerType(), LongType()

FACT_SALES = _table(
    DateKey=_INT,
    CustomerID=_TEXT,
    EmployeeID=_TEXT,
    ProductID=(_TEXT, False),
    SourceSystemID=(_INT, False),
    SalesQuantity=(_LONG, False),
    SalesAmount=(MONEY, False),
)

DIM_TIME = _table(
    DateKey=(_INT, False),
    FullDate=(DateType(), False),
    DayOfMonth=(_INT, False),
    DayOfWeek=(_TEXT, False),
    Month=(_INT, False),
    Quarter=(_INT, False),
    Year=(_INT, False),
)

DIM_CUSTOMER = _table(
    CustomerID=(_TEXT, False),
    CustomerName=_TEXT,
    CompanyName=_TEXT,
    City=_TEXT,
    State=_TEXT,
    Country=_TEXT,
    PostalCode=_TEXT,
    Phone=_TEXT,
    Email=_TEXT,
)

DIM_EMPLOYEE = _table(
    EmployeeID=(_TEXT, False),
    EmployeeName=(_TEXT, False),
    Title=_TEXT,
    City=_TEXT,
    Country=_TEXT,
    ReportsTo=_TEXT,
)

DIM_PRODUCT = _table(
    ProductID=(_TEXT, False),
    ProductName=(_TEXT, False),
    CategoryName=_TEXT,
    GenreName=_TEXT,
    Composer=_TEXT,
    UnitPrice=MONEY,
)

DIM_SOURCE_SYSTEM = _table(
    SourceSystemID=(_INT, False),
    SourceSystemName=(_TEXT, False),
)

STAR_TABLES = {
    "FactSales": FACT_SALES,
    "DimTime": DIM_TIME,
    "DimCustomer": DIM_CUSTOMER,
    "DimEmployee": DIM_EMPLOYEE,
    "DimProduct": DIM_PRODUCT,
    "DimSourceSystem": DIM_SOURCE_SYSTEM,
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project to the contract's columns, in order and type.

    A contract column the frame lacks becomes a typed NULL: a source that has
    no such attribute says so by leaving it out.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        if present.get(field.name) == field.dataType:
            columns.append(field.name)
        else:
            column = F.col(field.name) if field.name in present else F.lit(None)
            columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(*columns)
