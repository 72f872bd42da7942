from collections import defaultdict
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starmart.operators import acceptance, bi, filters
from starmart.schema import FACT_SALES


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_revenue_by_source(star):
    assert rows(bi.revenue_by_source(star.fact_sales, star.dim_source_system)) == [
        ("Chinook", D("5.95"), 5),
        ("Northwind", D("2787.00"), 32),
    ]


def test_revenue_without_sales_is_empty(star):
    nothing = star.fact_sales.where("false")
    assert rows(bi.revenue_by_source(nothing, star.dim_source_system)) == []


def test_top_customers_leaves_out_lines_without_customer_and_keeps_unknown_ones(star):
    top = bi.top_customers(star.fact_sales, star.dim_customer, star.dim_source_system, n=4)
    assert top.columns == ["CustomerName", "CompanyName", "Country", "SalesAmount", "SalesQuantity"]
    assert rows(top) == [
        (None, "No Name Inc", "Switzerland", D("2469.00"), 2),
        ("Paul Henriot", "Vins et alcools", "France", D("286.00"), 26),
        ("Ana Silva", None, "Portugal", D("2.97"), 3),
        (None, None, None, D("2.00"), 1),  # GHOST
    ]


def test_top_customers_split_adds_the_source(star):
    top = bi.top_customers(
        star.fact_sales, star.dim_customer, star.dim_source_system, n=3, split_by_source=True
    )
    assert [r.SourceSystemName for r in top.collect()] == ["Northwind", "Northwind", "Chinook"]


def test_top_n_beyond_the_broadcast_limit_gives_the_same(star, monkeypatch):
    few = rows(bi.top_customers(star.fact_sales, star.dim_customer, star.dim_source_system))
    monkeypatch.setattr(bi, "BROADCAST_ROWS", 1)
    assert rows(bi.top_customers(star.fact_sales, star.dim_customer, star.dim_source_system)) == few


def test_top_products(star):
    top = bi.top_products(star.fact_sales, star.dim_product, n=3)
    assert rows(top) == [
        (None, None, None, D("2469.00"), 2),
        ("Queso Cabrales", None, "Dairy Products", D("200.00"), 16),
        ("Singaporean Hokkien", None, None, D("118.00"), 14),
    ]
    by_quantity = bi.top_products(star.fact_sales, star.dim_product, n=2, order_by="SalesQuantity")
    assert [r.SalesQuantity for r in by_quantity.collect()] == [16, 14]
    named = bi.top_products(
        star.fact_sales, star.dim_product, n=10, dim_source_system=star.dim_source_system
    )
    assert {r.SourceSystemName for r in named.collect()} == {"Chinook", "Northwind"}


def test_employee_performance(star):
    made = bi.employee_performance(star.fact_sales, star.dim_employee, star.dim_source_system)
    assert rows(made) == [
        ("Steven Buchanan", "Sales Manager", D("286.00"), 26),
        ("Michael", None, D("30.00"), 3),
        ("Jane Peacock", "Sales Support Agent", D("2.97"), 3),
        (None, None, D("2.00"), 1),  # unknown employee 9
        ("Margaret Park", None, D("1.99"), 1),
    ]
    split = bi.employee_performance(
        star.fact_sales, star.dim_employee, star.dim_source_system, split_by_source=True
    )
    assert split.columns == ["EmployeeName", "Title", "SourceSystemName", "SalesAmount", "SalesQuantity"]


@pytest.mark.parametrize(
    "granularity, expected",
    [
        (
            "Day",
            [
                (date(2010, 1, 31), D("0.99"), 1),
                (date(2016, 7, 4), D("268.97"), 25),
                (date(2016, 10, 1), D("20.00"), 4),
                (date(2023, 8, 29), D("30.00"), 3),
            ],
        ),
        ("Month", [(1, D("0.99"), 1), (7, D("268.97"), 25), (8, D("30.00"), 3), (10, D("20.00"), 4)]),
        ("Quarter", [(1, D("0.99"), 1), (3, D("298.97"), 28), (4, D("20.00"), 4)]),
        ("Year", [(2010, D("0.99"), 1), (2016, D("288.97"), 29), (2023, D("30.00"), 3)]),
    ],
)
def test_sales_by_period(star, granularity, expected):
    made = bi.sales_by_period(star.fact_sales, star.dim_time, star.dim_source_system, granularity)
    assert rows(made) == expected


def test_sales_by_period_split(star):
    made = bi.sales_by_period(
        star.fact_sales, star.dim_time, star.dim_source_system, "Year", split_by_source=True
    )
    assert rows(made) == [
        (2010, "Chinook", D("0.99"), 1),
        (2016, "Chinook", D("2.97"), 3),
        (2016, "Northwind", D("286.00"), 26),
        (2023, "Northwind", D("30.00"), 3),
    ]


def test_pivot(star):
    made = bi.period_source_pivot(
        star.fact_sales, star.dim_time, star.dim_source_system, ["Chinook", "Northwind"], "Year"
    )
    assert made.columns == ["Year", "Chinook", "Northwind"]
    assert rows(made) == [
        (2010, D("0.99"), None),
        (2016, D("2.97"), D("286.00")),
        (2023, None, D("30.00")),
    ]


def test_calendar_groupings(star):
    week = dict(r[:2] for r in rows(bi.sales_by_day_of_week(star.fact_sales, star.dim_time)))
    assert week == {"Sunday": D("0.99"), "Monday": D("268.97"), "Saturday": D("20.00"), "Tuesday": D("30.00")}
    day = dict(r[:2] for r in rows(bi.sales_by_day_of_month(star.fact_sales, star.dim_time)))
    assert day == {31: D("0.99"), 4: D("268.97"), 1: D("20.00"), 29: D("30.00")}
    month = [r[:2] for r in rows(bi.sales_by_year_month(star.fact_sales, star.dim_time))]
    assert month == [(2010, 1), (2016, 7), (2016, 10), (2023, 8)]


def test_comparison_and_share(star):
    comparison = bi.source_system_comparison(star.fact_sales, star.dim_source_system)
    assert rows(comparison) == [
        ("Chinook", D("5.95"), 5, 4, pytest.approx(1.4875)),
        ("Northwind", D("2787.00"), 32, 6, pytest.approx(464.5)),
    ]
    share = bi.revenue_share(star.fact_sales, star.dim_source_system).collect()
    assert sum(r.SharePercent for r in share) == pytest.approx(100)
    assert [r.RatioToSmallest for r in share] == [1.0, pytest.approx(2787 / 5.95)]
    assert rows(bi.scale_gap(comparison, "SalesAmount")) == [("SalesAmount", 5.95, 2787.0, True)]


@pytest.mark.parametrize(
    "low, high, gap", [("1", "20", True), ("1", "19.99", False), ("0", "50", False), ("-1", "50", False)]
)
def test_scale_gap_needs_positive_values_and_a_factor_of_twenty(spark, low, high, gap):
    comparison = spark.createDataFrame([(D(low),), (D(high),)], "v decimal(18,2)")
    assert bi.scale_gap(comparison, "v").first().ScaleGap is gap


def test_share_of_nothing_is_null(spark, star):
    free = star.fact_sales.withColumn("SalesAmount", F.lit(0).cast("decimal(18,2)"))
    assert {r.SharePercent for r in bi.revenue_share(free, star.dim_source_system).collect()} == {None}


def test_totals_rollup(star):
    assert rows(bi.totals_rollup(star.fact_sales, star.dim_source_system)) == [
        ("Chinook", D("5.95"), 5),
        ("Combined", D("2792.95"), 37),
        ("Northwind", D("2787.00"), 32),
    ]


def test_acceptance(star):
    totals = {"Chinook": 5.95, "Northwind": 2787.0, "Combined": 2792.955}
    computed = acceptance.assert_documented_totals(star.fact_sales, star.dim_source_system, totals)
    assert computed == {"Chinook": 5.95, "Northwind": 2787.0, "Combined": 2792.95}


def test_acceptance_names_every_mismatch_and_counts_a_missing_source_as_zero(star):
    wrong = {"Chinook": 5.97, "Northwind": 2787.0, "Third": 1.0}
    with pytest.raises(AssertionError) as error:
        acceptance.assert_documented_totals(star.fact_sales, star.dim_source_system, wrong)
    assert "Chinook is 5.95 instead of 5.97" in str(error.value)
    assert "Third is 0.00 instead of 1.00" in str(error.value)
    assert "Northwind" not in str(error.value)


def test_totals_are_checked_for_whole_selections_only(star):
    documented = star.fact_sales.sparkSession.createDataFrame([("Chinook", "5.95")], "Label string, Documented string")

    def checked(**selection):
        picked = filters.Selection(**selection)
        return acceptance.check_totals(star.fact_sales, star.dim_source_system, documented, selection=picked).count()

    assert checked() == checked(sources=["Northwind", "Chinook"]) == 1
    assert checked(first=date(1990, 1, 1), last=date(2090, 1, 1)) == 1
    assert checked(sources=["Chinook"]) == checked(first=date(2020, 1, 1)) == checked(last=date(2012, 1, 1)) == 0


def test_filters(star):
    assert star.sales(["Chinook"]).count() == 4
    assert star.sales(["Northwind"], date(2016, 7, 4), date(2016, 10, 1)).count() == 3
    # a range leaves out lines without a date, also the whole range
    assert star.sales(first=date(2010, 1, 31), last=date(2023, 8, 29)).count() == 7
    assert star.sales().count() == 10
    assert star.sales([]).count() == 0
    assert rows(filters.date_bounds(star.fact_sales)) == [(date(2010, 1, 31), date(2023, 8, 29))]


def test_classification_and_title(star):
    made = bi.sales_by_classification(star.fact_sales, star.dim_product)
    assert rows(made) == [
        ("Unclassified", D("2590.97"), 19),
        ("Dairy Products", D("200.00"), 16),
        ("Rock", D("1.98"), 2),
    ]
    assert rows(bi.sales_by_title(star.fact_sales, star.dim_employee)) == [
        ("Sales Manager", D("286.00"), 26),
        ("Sales Support Agent", D("2.97"), 3),
    ]


def test_indirect_attribution(star):
    made = bi.indirect_attribution(star.sales(["Chinook"]), star.dim_employee)
    assert [(r.EmployeeName, r.Lines, r.Customers) for r in made.collect()] == [
        ("Jane Peacock", 2, 1),
        ("Margaret Park", 1, 1),
    ]


def test_header_reconciliation(music):
    lines = music.raw.table("InvoiceLine").select(
        F.col("InvoiceId").alias("HeaderKey"), (F.col("UnitPrice") * F.col("Quantity")).alias("Amount")
    )
    headers = music.raw.table("Invoice").select(F.col("InvoiceId").alias("HeaderKey"), "Total")
    extra = headers.sparkSession.createDataFrame([(500, D("3.00"))], headers.schema)
    made = bi.header_reconciliation(lines, headers.unionByName(extra)).collect()
    assert {r.HeaderKey: r.Matches for r in made} == {100: True, 101: True, 102: True, 103: True, 500: False}


def test_top_parents_by_children_counts_parents_without_children(music):
    made = bi.top_parents_by_children(
        music.raw.table("Artist"), music.raw.table("Album"), "ArtistId", "Name", "AlbumId", "ArtistId"
    )
    assert rows(made) == [(1, "AC/DC", 2), (2, "Accept", 1), (4, "Aerosmith", 1), (3, "Silent", 0)]


def many_customers(spark):
    """A fact in which one source holds most customers and amounts tie."""
    lines = [
        (20200101, f"S{1 if i % 10 else 2}:{i:04d}", None, "P:1", 1 if i % 10 else 2, 1, D(i * 7 % 50))
        for i in range(600)
    ]
    return spark.createDataFrame(lines, FACT_SALES)


@pytest.mark.parametrize("threshold", ["1000", "5"])
def test_top_per_source_against_brute_force(spark, star, threshold):
    """With and without the salted first ranking."""
    fact = many_customers(spark)
    expected = defaultdict(list)
    for r in fact.collect():
        expected[r.SourceSystemID].append((-r.SalesAmount, r.CustomerID))
    before = spark.conf.get(bi.GROUP_LIMIT_THRESHOLD)
    spark.conf.set(bi.GROUP_LIMIT_THRESHOLD, threshold)
    try:
        top = bi._top_within(
            fact.groupBy("CustomerID", "SourceSystemID").agg(F.sum("SalesAmount").alias("SalesAmount")),
            "SourceSystemID",
            7,
            "SalesAmount",
            "CustomerID",
        ).collect()
    finally:
        spark.conf.set(bi.GROUP_LIMIT_THRESHOLD, before)
    for source in (1, 2):
        made = sorted((r.Rank, r.CustomerID) for r in top if r.SourceSystemID == source)
        assert [c for _, c in made] == [c for _, c in sorted(expected[source])[:7]]


def test_top_customers_per_source(star):
    made = bi.top_customers_per_source(
        star.fact_sales, star.dim_customer, star.dim_source_system, n=2
    )
    assert [(r.SourceSystemName, r.Rank, r.SalesAmount) for r in made.collect()] == [
        ("Chinook", 1, D("2.97")),
        ("Chinook", 2, D("1.99")),
        ("Northwind", 1, D("2469.00")),
        ("Northwind", 2, D("286.00")),
    ]
