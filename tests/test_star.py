from collections import Counter
from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from starmart import Mapped, Star
from starmart.operators.fact import staged_sales
from starmart.schema import STAR_TABLES
from tests import data


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def test_every_table_has_the_contract_schema(star):
    for name, df in star.tables().items():
        expected = STAR_TABLES[name]
        assert df.columns == expected.names
        assert [f.dataType for f in df.schema.fields] == [f.dataType for f in expected.fields]


def test_documented_line(star):
    lines = rows(star.fact_sales.where("ProductID = 'NORTHWIND:11' and DateKey = 20160704"))
    assert lines == [(20160704, "NORTHWIND:VINET", "NORTHWIND:5", "NORTHWIND:11", 2, 12, D("168.00"))]


def test_fact_of_the_food_system(star):
    made = Counter(rows(star.fact_sales.where("SourceSystemID = 2")))
    n = "NORTHWIND:"
    assert made == Counter(
        [
            (20160704, n + "VINET", n + "5", n + "11", 2, 12, D("168.00")),
            (20160704, n + "VINET", n + "5", n + "42", 2, 10, D("98.00")),  # discount not applied
            (20230829, None, n + "6", n + "11", 2, 3, D("30.00")),
            (None, n + "NONAM", None, n + "77", 2, 2, D("2469.00")),
            (None, n + "GHOST", n + "9", n + "11", 2, 1, D("2.00")),
            (20161001, n + "VINET", n + "5", n + "42", 2, 4, D("20.00")),
        ]
    )


def test_fact_of_the_music_system_attributes_to_the_representative(star):
    made = Counter(rows(star.fact_sales.where("SourceSystemID = 1")))
    c = "CHINOOK:"
    assert made == Counter(
        [
            (20160704, c + "1", c + "3", c + "11", 1, 1, D("0.99")),
            (20160704, c + "1", c + "3", c + "12", 1, 2, D("1.98")),
            (20100131, c + "2", None, c + "11", 1, 1, D("0.99")),
            (None, c + "5", c + "4", c + "13", 1, 1, D("1.99")),
        ]
    )


def test_equal_lines_stay_separate(spark, star, music):
    twice = music.raw.table("InvoiceLine").unionByName(music.raw.table("InvoiceLine"))
    doubled = Star(spark, [type(music)(music.spec, music.raw.replacing(InvoiceLine=twice))])
    assert doubled.fact_sales.count() == 8


def test_dim_customer(star):
    made = {r.CustomerID: r for r in star.dim_customer.collect()}
    assert len(made) == 5
    assert made["CHINOOK:1"].CustomerName == "Ana Silva"
    assert made["CHINOOK:2"].CustomerName == "Mono"
    assert made["CHINOOK:5"].CustomerName == ""
    assert made["CHINOOK:1"].Email == "ana@x.pt"
    assert made["NORTHWIND:VINET"].State == "Western Europe"
    assert made["NORTHWIND:VINET"].Email is None
    assert made["NORTHWIND:NONAM"].CustomerName is None


def test_dim_employee_prefixes_the_manager(star):
    made = {r.EmployeeID: (r.EmployeeName, r.Title, r.ReportsTo) for r in star.dim_employee.collect()}
    assert made["CHINOOK:2"] == ("Nancy Edwards", "Sales Manager", "CHINOOK:1")
    assert made["NORTHWIND:2"] == ("Andrew Fuller", "Vice President", None)
    assert made["NORTHWIND:6"] == ("Michael", None, "NORTHWIND:5")


def test_dim_product(star):
    made = {r.ProductID: tuple(r)[1:] for r in star.dim_product.collect()}
    assert made == {
        "CHINOOK:11": ("Rock On", None, "Rock", "Angus", D("0.99")),
        "CHINOOK:12": ("Unnamed Genre", None, None, None, D("0.99")),
        "CHINOOK:13": ("No Genre", None, None, None, D("1.99")),
        "NORTHWIND:11": ("Queso Cabrales", "Dairy Products", None, None, D("21.00")),
        "NORTHWIND:42": ("Singaporean Hokkien", None, None, None, None),
    }


def test_dim_time_holds_the_dates_that_occur_once(star):
    assert sorted(rows(star.dim_time)) == [
        (20100131, date(2010, 1, 31), 31, "Sunday", 1, 1, 2010),
        (20100201, date(2010, 2, 1), 1, "Monday", 2, 1, 2010),
        (20160704, date(2016, 7, 4), 4, "Monday", 7, 3, 2016),
        (20161001, date(2016, 10, 1), 1, "Saturday", 10, 4, 2016),
        (20230829, date(2023, 8, 29), 29, "Tuesday", 8, 3, 2023),
    ]


def test_dim_source_system(star):
    assert rows(star.dim_source_system) == [(1, "Chinook"), (2, "Northwind")]


def test_discount_is_not_read(star):
    plan = star.fact_sales._jdf.queryExecution().optimizedPlan().toString()
    assert "Discount" not in plan.split("LogicalRDD")[0]
    assert "Discount" not in star.fact_sales.columns


def test_fact_keeps_the_result_without_broadcasts(star, no_broadcast):
    total = star.fact_sales.agg(F.sum("SalesAmount"), F.count("*")).first()
    assert tuple(total) == (D("2792.95"), 10)


def test_views_for_sql(spark, star):
    star.create_views()
    made = spark.sql(
        "SELECT SourceSystemName, sum(SalesAmount) AS a FROM FactSales "
        "JOIN DimSourceSystem USING (SourceSystemID) GROUP BY 1 ORDER BY 1"
    )
    assert rows(made) == [("Chinook", D("5.95")), ("Northwind", D("2787.00"))]


def test_third_system_needs_a_spec_only(spark, star, music):
    from dataclasses import replace

    def customers(raw):
        return Mapped(raw.table("Customer"), {"CustomerID": F.col("CustomerId"), "Phone": F.col("Phone")})

    spec = replace(music.spec, system_id=3, name="Third", prefix="THIRD", customers=customers)
    three = Star(spark, [*star.sources, type(music)(spec, music.raw)])
    known = "SourceSystemID in (1, 2)"
    assert Counter(rows(three.fact_sales.where(known))) == Counter(rows(star.fact_sales))
    assert three.fact_sales.where("SourceSystemID = 3").count() == 4
    new = [r for r in three.dim_customer.collect() if r.CustomerID.startswith("THIRD:")]
    assert len(new) == len(data.MUSIC["Customer"]) and all(r.CustomerName is None for r in new)


def test_staged_lines_keep_the_raw_values(food):
    staged = {r.LineKey: r for r in staged_sales(food).collect()}
    assert staged["10250|42"].RawQuantity is None and staged["10250|42"].SalesAmount is None
    assert staged["10250|77"].RawDate == "" and staged["10250|77"].DateKey is None
