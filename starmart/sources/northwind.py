"""Mapping of the food wholesaler. Sales are attributed to the employee on the order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.functions import line_key, person_name, with_date_key
from starmart.sources.raw import RawZone
from starmart.sources.spec import ForeignKey, HeaderSales, Lookup, Mapped, SourceSpec

# Raw schemas: the columns the mapping reads, with the source's types, and the keys of
# the other tables. Discount is kept in the raw zone and read by no mapping.
RAW_SCHEMAS = {
    "Categories": "CategoryID bigint, CategoryName string",
    "Customers": "CustomerID string, CompanyName string, ContactName string, City string, "
    "Region string, Country string, PostalCode string, Phone string",
    "Employees": "EmployeeID bigint, FirstName string, LastName string, Title string, City string, "
    "Country string, ReportsTo bigint",
    "Order Details": "OrderID bigint, ProductID bigint, UnitPrice decimal(18,2), Quantity bigint, "
    "Discount double",
    "Orders": "OrderID bigint, CustomerID string, EmployeeID bigint, OrderDate string, ShipVia bigint",
    "Products": "ProductID bigint, ProductName string, CategoryID bigint, UnitPrice decimal(18,2), "
    "SupplierID bigint",
    "CustomerCustomerDemo": "CustomerID string, CustomerTypeID string",
    "CustomerDemographics": "CustomerTypeID string, CustomerDesc string",
    "EmployeeTerritories": "EmployeeID bigint, TerritoryID string",
    "Regions": "RegionID bigint, RegionDescription string",
    "Shippers": "ShipperID bigint, CompanyName string, Phone string",
    "Suppliers": "SupplierID bigint, CompanyName string, ContactName string, ContactTitle string, "
    "Address string, City string, Region string, PostalCode string, Country string, Phone string, "
    "Fax string, HomePage string",
    "Territories": "TerritoryID string, TerritoryDescription string, RegionID bigint",
}


def _customers(raw: RawZone) -> Mapped:
    c = F.col
    return Mapped(
        raw.table("Customers"),
        {
            "CustomerID": c("CustomerID"),
            "CustomerName": c("ContactName"),
            "CompanyName": c("CompanyName"),
            "City": c("City"),
            "State": c("Region"),
            "Country": c("Country"),
            "PostalCode": c("PostalCode"),
            "Phone": c("Phone"),
        },
    )


def _employees(raw: RawZone) -> Mapped:
    c = F.col
    return Mapped(
        raw.table("Employees"),
        {
            "EmployeeID": c("EmployeeID"),
            "EmployeeName": person_name(c("FirstName"), c("LastName")),
            "Title": c("Title"),
            "City": c("City"),
            "Country": c("Country"),
            "ReportsTo": c("ReportsTo"),
        },
    )


def _products(raw: RawZone) -> Mapped:
    product, category = raw.table("Products").alias("p"), raw.table("Categories").alias("c")
    return Mapped(
        product,
        {
            "ProductID": F.col("p.ProductID"),
            "ProductName": F.col("p.ProductName"),
            "UnitPrice": F.col("p.UnitPrice"),
        },
        (
            Lookup(
                category,
                F.col("p.CategoryID") == F.col("c.CategoryID"),
                {"CategoryName": F.col("c.CategoryName")},
            ),
        ),
    )


def _dates(raw: RawZone) -> Mapped:
    return Mapped(raw.table("Orders"), {"OrderDate": F.col("OrderDate")})


def _lines(raw: RawZone) -> DataFrame:
    return raw.table("Order Details")


def _sales(raw: RawZone, how: str = "inner") -> Mapped:
    line = raw.table("Order Details").alias("l")
    order = with_date_key(raw.table("Orders"), "OrderDate").alias("h")
    return Mapped(
        line.join(order, F.col("l.OrderID") == F.col("h.OrderID"), how),
        {
            "Matched": F.col("h.OrderID").isNotNull(),
            "LineKey": line_key("l.OrderID", "l.ProductID"),
            "OrderDate": F.col("h.OrderDate"),
            "DateKey": F.col("h.DateKey"),
            "CustomerID": F.col("h.CustomerID"),
            "EmployeeID": F.col("h.EmployeeID"),
            "ProductID": F.col("l.ProductID"),
            "Quantity": F.col("l.Quantity"),
            "UnitPrice": F.col("l.UnitPrice"),
        },
    )


def _header_sales(raw: RawZone) -> HeaderSales:
    columns = ("Quantity", "UnitPrice")
    headers = with_date_key(raw.table("Orders"), "OrderDate")
    return HeaderSales(
        Mapped(
            raw.table("Order Details"), {"HeaderKey": F.col("OrderID"), **{c: F.col(c) for c in columns}}
        ),
        Mapped(
            headers,
            {"HeaderKey": F.col("OrderID"), "DateKey": F.col("DateKey"), "CustomerID": F.col("CustomerID")},
        ),
    )


NORTHWIND = SourceSpec(
    system_id=2,
    name="Northwind",
    prefix="NORTHWIND",
    customers=_customers,
    employees=_employees,
    products=_products,
    dates=_dates,
    sales=_sales,
    header_sales=_header_sales,
    lines=_lines,
    line_key=("OrderID", "ProductID"),
    tables=tuple(RAW_SCHEMAS),
    primary_keys={
        "Categories": ("CategoryID",),
        "Customers": ("CustomerID",),
        "Employees": ("EmployeeID",),
        "Order Details": ("OrderID", "ProductID"),
        "Orders": ("OrderID",),
        "Products": ("ProductID",),
        "CustomerCustomerDemo": ("CustomerID", "CustomerTypeID"),
        "CustomerDemographics": ("CustomerTypeID",),
        "EmployeeTerritories": ("EmployeeID", "TerritoryID"),
        "Regions": ("RegionID",),
        "Shippers": ("ShipperID",),
        "Suppliers": ("SupplierID",),
        "Territories": ("TerritoryID",),
    },
    foreign_keys=(
        ForeignKey("Employees", ("ReportsTo",), "Employees", ("EmployeeID",)),
        ForeignKey("Order Details", ("OrderID",), "Orders", ("OrderID",)),
        ForeignKey("Order Details", ("ProductID",), "Products", ("ProductID",)),
        ForeignKey("Orders", ("CustomerID",), "Customers", ("CustomerID",)),
        ForeignKey("Orders", ("EmployeeID",), "Employees", ("EmployeeID",)),
        ForeignKey("Orders", ("ShipVia",), "Shippers", ("ShipperID",)),
        ForeignKey("Products", ("CategoryID",), "Categories", ("CategoryID",)),
        ForeignKey("Products", ("SupplierID",), "Suppliers", ("SupplierID",)),
        ForeignKey("CustomerCustomerDemo", ("CustomerID",), "Customers", ("CustomerID",)),
        ForeignKey("CustomerCustomerDemo", ("CustomerTypeID",), "CustomerDemographics", ("CustomerTypeID",)),
        ForeignKey("EmployeeTerritories", ("EmployeeID",), "Employees", ("EmployeeID",)),
        ForeignKey("EmployeeTerritories", ("TerritoryID",), "Territories", ("TerritoryID",)),
        ForeignKey("Territories", ("RegionID",), "Regions", ("RegionID",)),
    ),
)
