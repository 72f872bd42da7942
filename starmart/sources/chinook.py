"""Mapping of the music store. Sales are attributed to the customer's support representative."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.functions import person_name, with_date_key
from starmart.sources.raw import RawZone
from starmart.sources.spec import ForeignKey, HeaderSales, Lookup, Mapped, SourceSpec

# Raw schemas: the columns the mapping reads, with the source's types, and the keys of
# the other tables.
RAW_SCHEMAS = {
    "Artist": "ArtistId bigint, Name string",
    "Album": "AlbumId bigint, Title string, ArtistId bigint",
    "Customer": "CustomerId bigint, FirstName string, LastName string, Company string, City string, "
    "State string, Country string, PostalCode string, Phone string, Email string, SupportRepId bigint",
    "Employee": "EmployeeId bigint, FirstName string, LastName string, Title string, City string, "
    "Country string, ReportsTo bigint",
    "Genre": "GenreId bigint, Name string",
    "Invoice": "InvoiceId bigint, CustomerId bigint, InvoiceDate string, Total decimal(10,2)",
    "InvoiceLine": "InvoiceLineId bigint, InvoiceId bigint, TrackId bigint, UnitPrice decimal(10,2), "
    "Quantity bigint",
    "Track": "TrackId bigint, Name string, GenreId bigint, Composer string, UnitPrice decimal(10,2), "
    "AlbumId bigint, MediaTypeId bigint",
    "MediaType": "MediaTypeId bigint, Name string",
    "Playlist": "PlaylistId bigint, Name string",
    "PlaylistTrack": "PlaylistId bigint, TrackId bigint",
}


def _customers(raw: RawZone) -> Mapped:
    c = F.col
    return Mapped(
        raw.table("Customer"),
        {
            "CustomerID": c("CustomerId"),
            "CustomerName": person_name(c("FirstName"), c("LastName")),
            "CompanyName": c("Company"),
            "City": c("City"),
            "State": c("State"),
            "Country": c("Country"),
            "PostalCode": c("PostalCode"),
            "Phone": c("Phone"),
            "Email": c("Email"),
        },
    )


def _employees(raw: RawZone) -> Mapped:
    c = F.col
    return Mapped(
        raw.table("Employee"),
        {
            "EmployeeID": c("EmployeeId"),
            "EmployeeName": person_name(c("FirstName"), c("LastName")),
            "Title": c("Title"),
            "City": c("City"),
            "Country": c("Country"),
            "ReportsTo": c("ReportsTo"),
        },
    )


def _products(raw: RawZone) -> Mapped:
    track, genre = raw.table("Track").alias("t"), raw.table("Genre").alias("g")
    return Mapped(
        track,
        {
            "ProductID": F.col("t.TrackId"),
            "ProductName": F.col("t.Name"),
            "Composer": F.col("t.Composer"),
            "UnitPrice": F.col("t.UnitPrice"),
        },
        (Lookup(genre, F.col("t.GenreId") == F.col("g.GenreId"), {"GenreName": F.col("g.Name")}),),
    )


def _dates(raw: RawZone) -> Mapped:
    return Mapped(raw.table("Invoice"), {"OrderDate": F.col("InvoiceDate")})


def _lines(raw: RawZone) -> DataFrame:
    return raw.table("InvoiceLine")


def _sales(raw: RawZone, how: str = "inner") -> Mapped:
    line, invoice, customer = (
        raw.table("InvoiceLine").alias("l"),
        with_date_key(raw.table("Invoice"), "InvoiceDate").alias("h"),
        raw.table("Customer").alias("c"),
    )
    rows = line.join(invoice, F.col("l.InvoiceId") == F.col("h.InvoiceId"), how).join(
        customer, F.col("h.CustomerId") == F.col("c.CustomerId"), how
    )
    return Mapped(
        rows,
        {
            "Matched": F.col("c.CustomerId").isNotNull(),
            "LineKey": F.col("l.InvoiceLineId").cast("string"),
            "OrderDate": F.col("h.InvoiceDate"),
            "DateKey": F.col("h.DateKey"),
            "CustomerID": F.col("h.CustomerId"),
            "EmployeeID": F.col("c.SupportRepId"),
            "ProductID": F.col("l.TrackId"),
            "Quantity": F.col("l.Quantity"),
            "UnitPrice": F.col("l.UnitPrice"),
        },
    )


def _header_sales(raw: RawZone) -> HeaderSales:
    """An invoice counts once for every row of its customer, as in the joined lines."""
    invoice = with_date_key(raw.table("Invoice"), "InvoiceDate").alias("h")
    customer = raw.table("Customer").alias("c")
    return HeaderSales(
        Mapped(
            raw.table("InvoiceLine"),
            {
                "HeaderKey": F.col("InvoiceId"),
                "Quantity": F.col("Quantity"),
                "UnitPrice": F.col("UnitPrice"),
            },
        ),
        Mapped(
            invoice.join(customer, F.col("h.CustomerId") == F.col("c.CustomerId")),
            {
                "HeaderKey": F.col("h.InvoiceId"),
                "DateKey": F.col("h.DateKey"),
                "CustomerID": F.col("h.CustomerId"),
            },
        ),
    )


CHINOOK = SourceSpec(
    system_id=1,
    name="Chinook",
    prefix="CHINOOK",
    customers=_customers,
    employees=_employees,
    products=_products,
    dates=_dates,
    sales=_sales,
    header_sales=_header_sales,
    lines=_lines,
    line_key=("InvoiceLineId",),
    tables=tuple(RAW_SCHEMAS),
    primary_keys={
        "Artist": ("ArtistId",),
        "Album": ("AlbumId",),
        "Customer": ("CustomerId",),
        "Employee": ("EmployeeId",),
        "Genre": ("GenreId",),
        "Invoice": ("InvoiceId",),
        "InvoiceLine": ("InvoiceLineId",),
        "Track": ("TrackId",),
        "MediaType": ("MediaTypeId",),
        "Playlist": ("PlaylistId",),
        "PlaylistTrack": ("PlaylistId", "TrackId"),
    },
    foreign_keys=(
        ForeignKey("Album", ("ArtistId",), "Artist", ("ArtistId",)),
        ForeignKey("Customer", ("SupportRepId",), "Employee", ("EmployeeId",)),
        ForeignKey("Employee", ("ReportsTo",), "Employee", ("EmployeeId",)),
        ForeignKey("Invoice", ("CustomerId",), "Customer", ("CustomerId",)),
        ForeignKey("InvoiceLine", ("InvoiceId",), "Invoice", ("InvoiceId",)),
        ForeignKey("InvoiceLine", ("TrackId",), "Track", ("TrackId",)),
        ForeignKey("Track", ("AlbumId",), "Album", ("AlbumId",)),
        ForeignKey("Track", ("GenreId",), "Genre", ("GenreId",)),
        ForeignKey("Track", ("MediaTypeId",), "MediaType", ("MediaTypeId",)),
        ForeignKey("PlaylistTrack", ("PlaylistId",), "Playlist", ("PlaylistId",)),
        ForeignKey("PlaylistTrack", ("TrackId",), "Track", ("TrackId",)),
    ),
)
