"""The plans at scale: what is read, shuffled and broadcast. Joins are planned without small sides."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from starmart.plans.catalogue import QUERIES
from starmart import Star
from starmart.operators import bi
from starmart.operators.filters import date_bounds, filter_sales
from starmart.sources import testdata
from starmart.sources.spec import Source
from tests.test_oracle import ROOT


@pytest.fixture(scope="module")
def big(spark):
    return Star(spark, testdata.sources(spark, ROOT))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    text = plan(df)
    return text[: text.index("Initial Plan")]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_uses_cross_joins_or_python(spark, name):
    text = plan(QUERIES[name](spark, ROOT))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


def test_report_reads_only_its_columns(big):
    text = plan(bi.revenue_by_source(big.fact_sales, big.dim_source_system))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    read = {c.split(":")[0] for s in schemas for c in s.split(",")}
    assert read == {
        "l_orderkey",
        "l_quantity",
        "l_extendedprice",
        "o_orderkey",
        "user_id",
        "event_type",
        "value",
        "c_custkey",
    }
    assert "EqualTo(event_type,purchase)" in text


def test_a_source_filter_removes_the_other_sources_from_the_plan(big):
    text = plan(big.sales(["Events"]))
    assert "events.parquet" in text and "lineitem.parquet" not in text


def test_date_key_is_made_on_headers(big, no_broadcast):
    """Below the shuffle of the headers, and it is the key that is shuffled."""
    text = plan(big.fact_sales)
    above, below = text.split("Exchange hashpartitioning(o_orderkey", 1)
    assert "year(" in below and "o_orderdate" not in above.split("SortMergeJoin [l_orderkey")[0]


def test_fact_shuffles_lines_and_headers_once(big, no_broadcast):
    text = plan(big.sales(["Orders"]))
    assert text.count("Exchange") == 2 and text.count("SortMergeJoin") == 1


def test_groups_are_summed_before_the_shuffle_and_before_dimensions(big, no_broadcast):
    text = plan(bi.employee_performance(big.fact_sales, big.dim_employee, big.dim_source_system))
    grouped = text[text.index("HashAggregate(keys=[EmployeeID") :]
    assert "partial_sum" in grouped and "supplier" not in grouped.split("partial_sum")[0]


def test_top_customers_shuffles_the_groups_once_and_no_dimension(big, no_broadcast):
    text = final_plan(
        bi.top_customers(big.fact_sales, big.dim_customer, big.dim_source_system, split_by_source=True)
    )
    assert "ReusedExchange [CustomerID" in text
    assert text.count("partial_sum(SalesAmount") == 1
    # the members are found by the broadcast groups, in the dimension's own partitions
    found = re.search(r"BroadcastHashJoin \[CustomerID#\d+\], \[CustomerID#\d+\], Inner, BuildRight", text)
    assert found and "customer.parquet" in text[found.end() :]


def test_ranking_within_a_source_is_cut_before_the_shuffle(big):
    text = plan(bi.top_customers_per_source(big.fact_sales, big.dim_customer, big.dim_source_system))
    ranked = text[text.index("WindowGroupLimit") :]
    assert ranked.index("Final") < ranked.index("Exchange hashpartitioning(SourceSystemID")
    assert ranked.index("Exchange hashpartitioning(SourceSystemID") < ranked.index("Partial")


def test_key_usage_reads_the_fact_once_and_joins_nothing_to_it(big, no_broadcast):
    from starmart.operators import quality

    text = plan(quality.key_usage(*big.tables().values()))
    assert text.count("lineitem.parquet") == 1
    assert text.count("SortMergeJoin [l_orderkey") == 1


def test_totals_are_rolled_up_after_the_sum(big):
    text = plan(bi.totals_rollup(big.fact_sales, big.dim_source_system))
    assert text.index("Expand") < text.index("partial_sum(SalesAmount#", text.index("Expand"))
    assert text.count("Expand") == 1
    lines = text[text.index("Union") :]
    assert "Expand" not in lines


def test_null_keys_are_spread_in_outer_joins(big, no_broadcast):
    from starmart.operators.joins import lookup

    made = lookup(big.fact_sales, big.dim_employee.select("EmployeeID", "Title"), "EmployeeID")
    assert "null/" in plan(made)
    spread = big.fact_sales.where("EmployeeID is null")
    from starmart.operators.joins import spread_nulls

    varying = [c for c in spread.columns if c != "EmployeeID"]
    buckets = spread.select(spread_nulls(F.col("EmployeeID"), *varying).alias("k"))
    assert buckets.distinct().count() > 500


def test_hot_key_is_split_by_aqe(spark, no_broadcast):
    """One order with most of the lines: the join splits it and loses nothing."""
    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        star = Star(spark, testdata.sources(spark, ROOT))
        raw = star.sources[0].raw
        lines = raw.table("lineitem")
        hot = F.when(F.col("l_partkey") % 2 == 0, F.lit(7)).otherwise(F.col("l_orderkey"))
        many = lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("copy")
        skewed = many.repartition(8).withColumn("l_orderkey", hot.cast("bigint"))
        source = type(star.sources[0])(testdata.ORDERS, raw.replacing(lineitem=skewed))
        fact = Star(spark, [source]).fact_sales
        assert fact.count() == lines.count() * 40
        grouped = fact.groupBy("CustomerID").agg(F.sum("SalesAmount").alias("a"), F.count("*").alias("n"))
        text = final_plan(grouped)
        assert "SortMergeJoin(skew=true)" in text
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_range_filter_on_the_fact_needs_no_dimension(big):
    text = plan(big.sales(first=date(1996, 1, 1), last=date(1996, 12, 31)))
    assert "DateKey" in text and text.count("Join") <= 2


REPORTS_ON_HEADERS = {
    "revenue_by_source": lambda s, f: bi.revenue_by_source(f, s.dim_source_system),
    "totals_rollup": lambda s, f: bi.totals_rollup(f, s.dim_source_system),
    "comparison": lambda s, f: bi.source_system_comparison(f, s.dim_source_system),
    "share": lambda s, f: bi.revenue_share(f, s.dim_source_system),
    "months": lambda s, f: bi.sales_by_period(f, s.dim_time, s.dim_source_system, "Month", True),
    "top_customers": lambda s, f: bi.top_customers(f, s.dim_customer, s.dim_source_system, 50, True),
    "bounds": lambda s, f: date_bounds(f),
    "filtered": lambda s, f: bi.revenue_by_source(
        filter_sales(f, None, date(1996, 3, 1), date(2024, 1, 15)), s.dim_source_system
    ),
}


@pytest.mark.parametrize("name", REPORTS_ON_HEADERS)
def test_header_sales_give_the_same_reports(big, star, name):
    report = REPORTS_ON_HEADERS[name]
    for one in (big, star):
        assert report(one, one.header_sales).collect() == report(one, one.fact_sales).collect()


def test_lines_are_summed_per_header_before_the_join(big, no_broadcast):
    text = plan(bi.revenue_by_source(big.header_sales, big.dim_source_system))
    lines = text[text.index("SortMergeJoin [HeaderKey") :]
    assert lines.index("HashAggregate(keys=[HeaderKey") < lines.index("Exchange hashpartitioning(HeaderKey")
    assert lines.index("Exchange hashpartitioning(HeaderKey") < lines.index("partial_sum(SalesAmount")
    assert lines.index("partial_sum(SalesAmount") < lines.index("lineitem.parquet")


def test_repeated_headers_and_missing_keys_count_as_in_the_lines(spark):
    raw = testdata.sources(spark, ROOT)[0].raw
    orders, lines = raw.table("orders"), raw.table("lineitem")
    twice = orders.unionAll(orders.where("o_orderkey % 7 = 0"))
    keyless = lines.withColumn("l_orderkey", F.when(F.col("l_partkey") % 5 != 0, F.col("l_orderkey")))
    bad = keyless.withColumn("l_quantity", F.when(F.col("l_suppkey") % 9 != 0, F.col("l_quantity")))
    source = Source(testdata.ORDERS, raw.replacing(orders=twice, lineitem=bad))
    one = Star(spark, [source])
    for name in ("comparison", "months", "top_customers"):
        report = REPORTS_ON_HEADERS[name]
        assert report(one, one.header_sales).collect() == report(one, one.fact_sales).collect()


def test_unread_lookups_are_left_out(big):
    from starmart.operators import narrate, quality

    keys = big.tables(quality.MEMBER_KEYS)
    assert keys["DimCustomer"].columns == ["CustomerID"]
    assert keys["DimEmployee"].columns == ["EmployeeID", "ReportsTo"]
    assert "nation.parquet" in plan(big.dim_customer)
    assert "nation.parquet" not in plan(keys["DimCustomer"])
    names = big.tables(narrate.NAMES)["DimCustomer"]
    assert "nation.parquet" not in plan(names)
    assert sorted(names.collect()) == sorted(big.dim_customer.select("CustomerID", "CustomerName").collect())
    narrow, whole = (quality.key_usage(*t.values()) for t in (big.tables(quality.MEMBER_KEYS), big.tables()))
    assert sorted(narrow.collect()) == sorted(whole.collect())
