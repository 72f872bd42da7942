from collections import Counter
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starmart import RawZone, Source, Star
from starmart.operators import bi, filters, quality
from starmart.scratch import stored
from starmart.sources import northwind
from starmart.plans import footers
from starmart.plans.publish import (
    PublishedStar,
    log_violations,
    publish,
    publish_source,
    retain_bucketed,
    retain_raw,
    write_quarantine,
)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def published(spark, star, tmp_path):
    publish(star, str(tmp_path))
    return PublishedStar(spark, str(tmp_path))


def test_published_tables_equal_the_star(star, published):
    for name, df in star.tables().items():
        read = published.tables()[name]
        assert read.columns == df.columns
        assert rows(read) == rows(df), name


def test_reports_run_on_the_published_star(star, published):
    made = bi.top_customers(published.fact_sales, published.dim_customer, published.dim_source_system)
    assert rows(made) == rows(bi.top_customers(star.fact_sales, star.dim_customer, star.dim_source_system))


def test_header_sales_and_narrow_members_of_the_published_star(star, published):
    made = bi.source_system_comparison(published.header_sales, published.dim_source_system)
    assert rows(made) == rows(bi.source_system_comparison(star.header_sales, star.dim_source_system))
    narrow = published.tables({"DimCustomer": ("CustomerID",)})
    assert narrow["DimCustomer"].columns == ["CustomerID"]
    assert rows(narrow["DimProduct"]) == rows(star.dim_product)


def test_filters_prune_sources_and_years(star, published):
    chosen = (["Northwind"], date(2016, 7, 4), date(2016, 12, 31))
    made = published.sales(*chosen)
    assert rows(made) == rows(star.sales(*chosen))
    text = plan(made)
    partition_filters = text[text.index("PartitionFilters") : text.index("PushedFilters")]
    assert "Year" in partition_filters and "SourceSystemID" in partition_filters
    assert "GreaterThanOrEqual(DateKey,20160704)" in text


def test_lines_without_a_date_are_published(published):
    assert published.fact_sales.where("DateKey is null").count() == 3


def files(path, system_id):
    found = Path(path).rglob(f"SourceSystemID={system_id}/**/*.parquet")
    return {f: f.stat().st_mtime_ns for f in found}


def test_adding_and_reloading_a_source_leaves_the_others_alone(spark, star, tmp_path):
    path = str(tmp_path)
    music, food = star.sources
    publish_source(spark, music, path)
    before = files(path, 1)
    assert before and not files(path, 2)
    publish_source(spark, food, path)
    publish_source(spark, food, path)
    assert files(path, 1) == before
    assert rows(PublishedStar(spark, path).fact_sales) == rows(star.fact_sales)


def test_a_reload_drops_years_that_are_gone(spark, star, tmp_path):
    path = str(tmp_path)
    publish(star, path)
    food = star.sources[1]
    late = food.raw.table("Orders").where("OrderDate >= '2016-10'")
    reloaded = Source(food.spec, food.raw.replacing(Orders=late))
    publish_source(spark, reloaded, path)
    made = PublishedStar(spark, path)
    assert rows(made.sales(["Northwind"])) == rows(Star(spark, [reloaded]).fact_sales)


def test_a_hot_year_is_written_by_many_tasks(spark, food, tmp_path, no_broadcast):
    """All lines in one year: the write is split by size, and nothing is lost."""
    lines = spark.range(200000).selectExpr(
        "20000 + id % 100 as OrderID",
        "id as ProductID",
        "cast(id % 1000 as decimal(18,2)) as UnitPrice",
        "id as Quantity",
    )
    orders = spark.range(20000, 20100).selectExpr(
        "id as OrderID", "'VINET' as CustomerID", "5L as EmployeeID", "'2016-07-04' as OrderDate"
    )
    source = Source(food.spec, food.raw.replacing(**{"Order Details": lines, "Orders": orders}))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "256KB")
    try:
        publish_source(spark, source, str(tmp_path))
    finally:
        spark.conf.set(name, before)
    written = list((tmp_path / "FactSales" / "SourceSystemID=2" / "Year=2016").glob("*.parquet"))
    assert len(written) > 1  # a plain shuffle by year would write one
    assert PublishedStar(spark, str(tmp_path)).fact_sales.count() == 200000


def test_findings_and_rejected_lines_are_kept_per_load(spark, food, tmp_path):
    log_violations(food, f"{tmp_path}/findings", "a")
    write_quarantine(food, f"{tmp_path}/rejected", "a")
    findings = spark.read.parquet(f"{tmp_path}/findings")
    assert Counter(r.Rule for r in findings.collect()) == {"date": 3, "measure": 1}
    (row,) = spark.read.parquet(f"{tmp_path}/rejected").collect()
    assert (row.LineKey, row.RawPrice, row.Reason, row.load) == ("10250|42", "3.00", "quantity missing", "a")


def test_raw_zone_keeps_every_column_of_every_load(spark, food, tmp_path):
    for load in ("2024-01-01", "2024-01-02"):
        retain_raw(food, str(tmp_path), load)
    stored = spark.read.parquet(f"{tmp_path}/Northwind/Order Details")
    assert set(food.raw.table("Order Details").columns) < set(stored.columns)
    assert stored.groupBy("load").count().count() == 2 and stored.where("Discount > 0").count() == 4


def test_undeclared_columns_are_kept(spark, food, tmp_path):
    for name in food.spec.tables:
        food.raw.table(name).write.parquet(f"{tmp_path}/in/{name}.parquet")
    orders = food.raw.table("Orders").withColumn("Freight", F.lit(1.5))
    orders.write.mode("overwrite").parquet(f"{tmp_path}/in/Orders.parquet")
    declared = RawZone.parquet(spark, f"{tmp_path}/in", schemas=northwind.RAW_SCHEMAS)
    assert "Freight" not in declared.table("Orders").columns
    retain_raw(Source(food.spec, declared), f"{tmp_path}/out", "a")
    kept = spark.read.parquet(f"{tmp_path}/out/Northwind/Orders/load=a")
    assert "Freight" in kept.columns and kept.where("Freight = 1.5").count() == orders.count()


def test_raw_zone_can_be_read_back(spark, food, tmp_path):
    retain_raw(food, str(tmp_path), "a")
    again = Source(food.spec, RawZone.parquet(spark, f"{tmp_path}/Northwind", suffix="/load=a"))
    assert rows(Star(spark, [again]).fact_sales) == rows(Star(spark, [food]).fact_sales)


def test_bucketed_lines_and_headers_join_without_a_shuffle(spark, food, no_broadcast):
    retain_bucketed(food.raw.table("Order Details"), "nw_lines", "OrderID", 4)
    retain_bucketed(food.raw.table("Orders"), "nw_orders", "OrderID", 4)
    raw = food.raw.replacing(
        **{"Order Details": spark.table("nw_lines"), "Orders": spark.table("nw_orders")}
    )
    bucketed = Star(spark, [Source(food.spec, raw)]).fact_sales
    assert "SortMergeJoin" in plan(bucketed) and "Exchange" not in plan(bucketed)
    assert rows(bucketed) == rows(Star(spark, [food]).fact_sales)


def test_a_change_to_published_history_shows(spark, star, music, food, tmp_path):
    publish(Star(spark, [food]), str(tmp_path))
    before = stored(quality.fingerprint(PublishedStar(spark, str(tmp_path)).fact_sales))
    publish_source(spark, music, str(tmp_path))

    def unchanged():
        now = PublishedStar(spark, str(tmp_path))
        made = quality.history_check(before, now.fact_sales, now.dim_source_system)
        return {r.SourceSystemName: r.HistoryUnchanged for r in made.collect()}

    assert unchanged() == {"Northwind": True, "Chinook": None}
    lines = food.raw.table("Order Details").withColumn("UnitPrice", (F.col("UnitPrice") + 1).cast("decimal(18,2)"))
    publish_source(spark, Source(food.spec, food.raw.replacing(**{"Order Details": lines})), str(tmp_path))
    assert unchanged()["Northwind"] is False


def test_date_bounds_and_rows_come_from_the_footers(spark, star, published):
    expected = rows(filters.date_bounds(star.fact_sales))
    assert rows(published.date_bounds()) == rows(star.date_bounds()) == expected
    assert published.fact_rows() == star.fact_sales.count()
    with footers.footers(spark):
        text = plan(published._footer_bounds())
    assert "PushedAggregation: [MIN(DateKey), MAX(DateKey)]" in text and "PushedAggregation: [COUNT(*)]" in text
    # Outside, tables are read as before.
    assert "PushedAggregation" not in plan(published._footer_bounds())


def test_date_bounds_of_raw_tables_sum_no_line(star, no_broadcast):
    text = plan(star.date_bounds())
    assert "LeftSemi" in text and "sum(" not in text


def test_a_calendar_filter_reads_its_years_only(star, published):
    quarter = F.col("Quarter") == star.dim_time.agg(F.max("Quarter")).first()[0]
    made = published.sales_on(quarter)
    expected = rows(star.sales_on(quarter))
    assert rows(made) == expected and expected
    assert "dynamicpruning" in plan(published.sales_on(quarter))
    # Files of other years can't even be read, and nobody tries.
    years = {f"Year={r.DateKey // 10000}" for r in made.collect()}
    spoilt = 0
    for f in Path(published.path, "FactSales").rglob("*.parquet"):
        if f.parent.name not in years:
            f.write_bytes(b"not a table")
            spoilt += 1
    assert spoilt
    again = PublishedStar(published.spark, published.path)
    assert rows(again.sales_on(quarter)) == expected
    assert again.sales_on(F.col("Year") == 1900).count() == 0
