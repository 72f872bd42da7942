"""The driver's tables in the role of differently built sales systems.

The tables hold one company only, so this mapping is role play, for tests and
benchmarks:

- ORDERS (1): lines join headers, the employee stands on the line.
- EVENTS (2): purchase events, the employee is found through the customer.
- SIGNUPS (3): a system that joins later, built like EVENTS.
- INTAKE (4): all events as an untyped text feed with faults put in, for the
  quality rules.

Native ids overlap between the systems on purpose.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.functions import line_key, with_date_key
from starmart.sources.raw import RawZone
from starmart.sources.spec import ForeignKey, HeaderSales, Lookup, Mapped, Source, SourceSpec, union_all

RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
}

PRIMARY_KEYS = {
    "region": ("r_regionkey",),
    "nation": ("n_nationkey",),
    "customer": ("c_custkey",),
    "supplier": ("s_suppkey",),
    "part": ("p_partkey",),
    "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey", "l_linenumber"),
    "events": ("event_id",),
}


def _keys_of(*tables: str) -> dict[str, tuple[str, ...]]:
    return {t: PRIMARY_KEYS[t] for t in tables}


def _nation(raw: RawZone, nation_key: str) -> Lookup:
    return Lookup(raw.table("nation"), F.col(nation_key) == F.col("n_nationkey"), {"Country": F.col("n_name")})


# ORDERS


def _order_customers(raw: RawZone) -> Mapped:
    return Mapped(
        raw.table("customer"),
        {"CustomerID": F.col("c_custkey"), "CustomerName": F.col("c_name")},
        (_nation(raw, "c_nationkey"),),
    )


def _order_employees(raw: RawZone) -> Mapped:
    return Mapped(
        raw.table("supplier"),
        {
            "EmployeeID": F.col("s_suppkey"),
            "EmployeeName": F.col("s_name"),
            "Title": F.lit("Supplier"),
        },
        (_nation(raw, "s_nationkey"),),
    )


def _order_products(raw: RawZone) -> Mapped:
    return Mapped(
        raw.table("part"),
        {
            "ProductID": F.col("p_partkey"),
            "ProductName": F.col("p_name"),
            "CategoryName": F.col("p_type"),
            "UnitPrice": F.col("p_retailprice"),
        },
    )


def _order_dates(raw: RawZone) -> Mapped:
    return Mapped(raw.table("orders"), {"OrderDate": F.col("o_orderdate")})


def _order_lines(raw: RawZone) -> DataFrame:
    return raw.table("lineitem")


def _order_sales(raw: RawZone, how: str = "inner") -> Mapped:
    line = raw.table("lineitem")
    header = with_date_key(raw.table("orders"), "o_orderdate")
    return Mapped(
        line.join(header, line["l_orderkey"] == header["o_orderkey"], how),
        {
            "Matched": F.col("o_orderkey").isNotNull(),
            "LineKey": line_key("l_orderkey", "l_linenumber"),
            "OrderDate": F.col("o_orderdate"),
            "DateKey": F.col("DateKey"),
            "CustomerID": F.col("o_custkey"),
            # Role play: returned lines stand for lines without an employee.
            "EmployeeID": F.when(F.col("l_returnflag") != "R", F.col("l_suppkey")),
            "ProductID": F.col("l_partkey"),
            "Quantity": F.col("l_quantity"),
            # The gross line amount as stored; l_discount is never read.
            "Amount": F.col("l_extendedprice"),
        },
    )


def _order_header_sales(raw: RawZone) -> HeaderSales:
    return HeaderSales(
        Mapped(
            raw.table("lineitem"),
            {
                "HeaderKey": F.col("l_orderkey"),
                "Quantity": F.col("l_quantity"),
                "Amount": F.col("l_extendedprice"),
            },
        ),
        Mapped(
            with_date_key(raw.table("orders"), "o_orderdate"),
            {
                "HeaderKey": F.col("o_orderkey"),
                "DateKey": F.col("DateKey"),
                "CustomerID": F.col("o_custkey"),
            },
        ),
    )


ORDERS = SourceSpec(
    system_id=1,
    name="Orders",
    prefix="ORDERS",
    customers=_order_customers,
    employees=_order_employees,
    products=_order_products,
    dates=_order_dates,
    sales=_order_sales,
    header_sales=_order_header_sales,
    header_customer=("orders", "o_custkey"),
    lines=_order_lines,
    line_key=("l_orderkey", "l_linenumber"),
    tables=("customer", "lineitem", "nation", "orders", "part", "supplier"),
    primary_keys=_keys_of("customer", "lineitem", "nation", "orders", "part", "supplier"),
    foreign_keys=(
        ForeignKey("customer", ("c_nationkey",), "nation", ("n_nationkey",)),
        ForeignKey("lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
        ForeignKey("lineitem", ("l_partkey",), "part", ("p_partkey",)),
        ForeignKey("lineitem", ("l_suppkey",), "supplier", ("s_suppkey",)),
        ForeignKey("orders", ("o_custkey",), "customer", ("c_custkey",)),
        ForeignKey("supplier", ("s_nationkey",), "nation", ("n_nationkey",)),
    ),
)


# EVENTS, SIGNUPS


def event_product() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _event_customers(raw: RawZone) -> Mapped:
    users = raw.table("events").select("user_id").distinct()
    customer = raw.table("customer")
    known = Lookup(
        customer,
        F.col("user_id") == F.col("c_custkey"),
        {"CustomerName": F.col("c_name")},
        (_nation(raw, "c_nationkey"),),
    )
    return Mapped(users, {"CustomerID": F.col("user_id")}, (known,))


def _event_employees(raw: RawZone) -> Mapped:
    """Nation desks report to region desks."""
    nation = raw.table("nation").select(
        F.concat(F.lit("N"), "n_nationkey").alias("EmployeeID"),
        F.col("n_name").alias("EmployeeName"),
        F.lit("Nation desk").alias("Title"),
        F.concat(F.lit("R"), "n_regionkey").alias("ReportsTo"),
    )
    region = raw.table("region").select(
        F.concat(F.lit("R"), "r_regionkey").alias("EmployeeID"),
        F.col("r_name").alias("EmployeeName"),
        F.lit("Region desk").alias("Title"),
    )
    columns = ("EmployeeID", "EmployeeName", "Title", "ReportsTo")
    rows = nation.unionByName(region, allowMissingColumns=True)
    return Mapped(rows, {name: F.col(name) for name in columns})


def _event_products(raw: RawZone) -> Mapped:
    sold = raw.table("events").select(event_product().alias("k")).distinct()
    part = raw.table("part")
    known = Lookup(
        part,
        F.col("k") == F.col("p_partkey"),
        {
            "ProductName": F.col("p_name"),
            "GenreName": F.col("p_brand"),
            "UnitPrice": F.col("p_retailprice"),
        },
    )
    return Mapped(sold, {"ProductID": F.col("k")}, (known,))


def _events_as_source(event_type: str, system_id: int, name: str, prefix: str) -> SourceSpec:
    def lines(raw: RawZone) -> DataFrame:
        events = raw.table("events")
        return events.where(events["event_type"] == event_type)

    def dates(raw: RawZone) -> Mapped:
        return Mapped(lines(raw), {"OrderDate": F.col("ts")})

    def sales(raw: RawZone, how: str = "inner") -> Mapped:
        events, customer = with_date_key(lines(raw), "ts"), raw.table("customer")
        return Mapped(
            events.join(customer, events["user_id"] == customer["c_custkey"], how),
            {
                "Matched": F.col("c_custkey").isNotNull(),
                "LineKey": F.col("event_id").cast("string"),
                "OrderDate": F.col("ts"),
                "DateKey": F.col("DateKey"),
                "CustomerID": F.col("user_id"),
                "EmployeeID": F.concat(F.lit("N"), "c_nationkey"),
                "ProductID": event_product(),
                "Quantity": F.lit(1),
                "UnitPrice": F.col("value"),
            },
        )

    return SourceSpec(
        system_id=system_id,
        name=name,
        prefix=prefix,
        customers=_event_customers,
        employees=_event_employees,
        products=_event_products,
        dates=dates,
        sales=sales,
        lines=lines,
        line_key=("event_id",),
        tables=("customer", "events", "nation", "part", "region"),
        primary_keys=_keys_of("customer", "events", "nation", "part", "region"),
        foreign_keys=(
            ForeignKey("customer", ("c_nationkey",), "nation", ("n_nationkey",)),
            ForeignKey("events", ("user_id",), "customer", ("c_custkey",)),
            ForeignKey("nation", ("n_regionkey",), "region", ("r_regionkey",)),
        ),
    )


EVENTS = _events_as_source("purchase", 2, "Events", "EVENTS")
SIGNUPS = _events_as_source("signup", 3, "Signups", "SIGNUPS")


# INTAKE


def _every(n: int, remainder: int) -> Column:
    return F.col("event_id") % n == remainder


def intake_lines(raw: RawZone) -> DataFrame:
    """Every event as a line of text, with faults at fixed places."""
    text = F.col("ts").cast("string")
    full, day, year = (F.substring(text, 1, n) for n in (19, 10, 4))
    american = F.concat_ws("/", F.substring(text, 6, 2), F.substring(text, 9, 2), year)
    price = F.col("value").cast("decimal(18,2)").cast("string")
    return raw.table("events").select(
        "event_id",
        F.when(_every(50, 0), "junk")
        .when(_every(50, 1), "")
        .when(_every(50, 2), F.lit(None))
        .when(_every(50, 3), american)
        .when(_every(50, 4), F.concat(day, F.lit(" 25:99:99")))
        .when(_every(50, 5), year)
        .when(_every(2, 0), day)
        .otherwise(full)
        .alias("order_date"),
        F.when(_every(40, 7), F.lit(None))
        .when(_every(40, 9), F.col("user_id") + 10000000)
        .otherwise(F.col("user_id"))
        .cast("double")
        .alias("customer"),
        F.when(_every(60, 11), F.concat(F.lit("X"), F.get_json_object("props", "$.k")))
        .otherwise(F.get_json_object("props", "$.k"))
        .alias("product"),
        F.when(_every(70, 0), "two")
        .when(_every(70, 1), F.lit(None))
        .when(_every(70, 2), "0")
        .when(_every(70, 3), "-3")
        .otherwise("1")
        .alias("quantity"),
        F.when(_every(80, 5), "free")
        .when(_every(80, 6), F.lit(None))
        .when(_every(80, 7), "-1.00")
        .otherwise(price)
        .alias("price"),
    )


def _intake_dates(raw: RawZone) -> Mapped:
    return Mapped(intake_lines(raw), {"OrderDate": F.col("order_date")})


def _intake_sales(raw: RawZone, how: str = "inner") -> Mapped:
    """The feed holds all there is on a line: there is no join, and no line without a header."""
    return Mapped(
        with_date_key(intake_lines(raw), "order_date"),
        {
            "Matched": F.lit(True),
            "LineKey": F.col("event_id").cast("string"),
            "OrderDate": F.col("order_date"),
            "DateKey": F.col("DateKey"),
            "CustomerID": F.col("customer"),
            "EmployeeID": F.lit(None).cast("string"),
            "ProductID": F.col("product"),
            "Quantity": F.col("quantity"),
            "UnitPrice": F.col("price"),
        },
    )


INTAKE = replace(
    EVENTS,
    system_id=4,
    name="Intake",
    prefix="INTAKE",
    dates=_intake_dates,
    sales=_intake_sales,
    lines=intake_lines,
)


def sources(spark: SparkSession, root: str, *specs: SourceSpec) -> list[Source]:
    """The given systems (ORDERS and EVENTS by default) over the driver's parquet folder."""
    raw = RawZone.parquet(spark, root, schemas=RAW_SCHEMAS)
    return [Source(spec, raw) for spec in specs or (ORDERS, EVENTS)]


def next_load(raw: RawZone) -> RawZone:
    """ORDERS' tables as a later load could bring them: ids of members that went, came, moved or changed hands."""
    far = 10_000_000

    def renumbered(df: DataFrame, key: str, every: int) -> DataFrame:
        moved = F.when(F.col(key) % every == 0, F.col(key) + far).otherwise(F.col(key))
        return df.withColumn(key, moved)

    key, name = F.col("c_custkey"), F.col("c_name")
    owner = F.when(key % 79 == 0, F.concat(name, F.lit(" (new owner)"))).otherwise(name)
    stayed = raw.table("customer").where(key % 97 != 0).withColumn("c_name", owner)
    branches = raw.table("customer").where(key % 83 == 0).withColumns(
        {"c_custkey": key + 2 * far, "c_name": F.concat(name, F.lit(" (branch)"))}
    )
    customers = renumbered(stayed, "c_custkey", 89).unionByName(branches)
    return raw.replacing(customer=customers, part=renumbered(raw.table("part"), "p_partkey", 91))


def raw_totals(raw: RawZone) -> DataFrame:
    """SalesAmount per system and combined, straight from the raw tables: the figures to accept against."""
    money = "decimal(18,2)"
    events = raw.table("events").where(F.col("event_type") == "purchase")
    sums = union_all(
        [
            raw.table("lineitem").agg(F.sum(F.col("l_extendedprice").cast(money)).alias("Documented")).withColumn("Label", F.lit("Orders")),
            events.agg(F.sum(F.col("value").cast(money)).alias("Documented")).withColumn("Label", F.lit("Events")),
        ]
    )
    return sums.rollup("Label").agg(F.sum("Documented").alias("Documented")).select(
        F.coalesce("Label", F.lit("Combined")).alias("Label"), "Documented"
    )
