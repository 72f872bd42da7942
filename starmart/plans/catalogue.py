"""The registered queries: every operator over the whole of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType

from starmart import files
from starmart.functions import canonical_key, line_amount, person_name, quantity
from starmart.operators import acceptance, bi, filters, hierarchy, keyfinder, narrate, profile, quality
from starmart.plans import drift
from starmart.plans.publish import retain_raw
from starmart.plans.release import ReleasedStar, release
from starmart.plans.stability import key_changes, stability, store_keys
from starmart.plans.star import Star
from starmart.scratch import new_folder, stored
from starmart.sources import testdata
from starmart.sources.raw import RawZone
from starmart.sources.spec import Source, union_all
from starmart.sources.testdata import EVENTS, INTAKE, ORDERS, SIGNUPS

Query = Callable[[SparkSession, str], DataFrame]

FILTER_FIRST, FILTER_LAST = date(1996, 3, 1), date(2024, 1, 15)
PICKED_ROW = 1000


def presented(df: DataFrame) -> DataFrame:
    """Decimals as double (after exact sums) and dates as text, for comparison across engines."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, DateType):
            column = column.cast("string").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def _star(spark: SparkSession, root: str, *specs) -> Star:
    return Star(spark, testdata.sources(spark, root, *specs))


def _on_star(build: Callable[[Star], DataFrame], *specs) -> Query:
    return lambda spark, root: presented(build(_star(spark, root, *specs)))


def _on_raw(build: Callable[[RawZone], DataFrame]) -> Query:
    return lambda spark, root: presented(build(RawZone.parquet(spark, root)))


# Model


def _dim_source_system(star: Star) -> DataFrame:
    """The members, each with the facts that carry its id."""
    rows = star.fact_sales.groupBy("SourceSystemID").agg(F.count("*").alias("FactRows"))
    members = star.dim_source_system.join(rows, "SourceSystemID", "left")
    return members.select("SourceSystemID", "SourceSystemName", "FactRows")


def _canonical_keys(raw: RawZone) -> DataFrame:
    orders = raw.table("orders")
    keys = {
        "FromBigint": ("A", F.col("o_custkey")),
        "FromDouble": ("B", F.col("o_custkey").cast("double")),
        "FromText": ("C", F.col("o_orderpriority")),
        "FromOptional": ("D", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))),
    }
    typed = orders.select("o_orderkey", *[column.alias(name) for name, (_, column) in keys.items()])
    made = [
        canonical_key(prefix, F.col(name), typed.schema[name].dataType).alias(name)
        for name, (prefix, _) in keys.items()
    ]
    return typed.select("o_orderkey", *made)


def _person_name(raw: RawZone) -> DataFrame:
    """Part names split in two, with missing and padded parts put in."""
    words = F.split("p_name", " ")
    first = F.when(F.col("p_size") % 5 != 0, F.concat(F.lit("\t "), words[0], F.lit(" \n")))
    last = F.when(F.col("p_size") % 7 != 0, F.concat(F.lit("  "), words[1], F.lit("\t")))
    return raw.table("part").select("p_partkey", person_name(first, last).alias("PersonName"))


# Reports


def _filtered(star: Star, fact: DataFrame, *names: str) -> DataFrame:
    return filters.filter_sales(fact, star.source_ids(names), FILTER_FIRST, FILTER_LAST)


def _period(granularity: str, split: bool = False) -> Query:
    return _on_star(
        lambda s: bi.sales_by_period(
            s.header_sales, s.dim_time, s.dim_source_system, granularity, split
        )
    )


def _scale_gap(star: Star) -> DataFrame:
    comparison = bi.source_system_comparison(star.header_sales, star.dim_source_system)
    return union_all(bi.scale_gap(comparison, m) for m in ("SalesAmount", "AvgLineValue"))


def _totals_check(star: Star) -> DataFrame:
    documented = testdata.raw_totals(star.sources[0].raw)
    return acceptance.check_totals(star.header_sales, star.dim_source_system, documented)


def _narrate(star: Star, fact: DataFrame) -> DataFrame:
    named = star.tables(narrate.NAMES)
    return narrate.describe_fact_rows(
        fact,
        named["DimCustomer"],
        named["DimEmployee"],
        named["DimProduct"],
        named["DimTime"],
        named["DimSourceSystem"],
    )


def _header_reconciliation(raw: RawZone) -> DataFrame:
    money = "decimal(18,2)"
    lines = raw.table("lineitem").select(
        F.col("l_orderkey").alias("HeaderKey"), F.col("l_extendedprice").cast(money).alias("Amount")
    )
    headers = raw.table("orders").select(
        F.col("o_orderkey").alias("HeaderKey"), F.col("o_totalprice").cast(money).alias("Total")
    )
    return bi.header_reconciliation(lines, headers)


# Quality


def _each_source(operator: Callable[[Source], DataFrame]) -> Query:
    """An operator on one source, over all three systems of the test tables."""
    return _on_star(lambda s: union_all(operator(x) for x in s.sources), ORDERS, EVENTS, INTAKE)


def _line_measure(raw: RawZone) -> DataFrame:
    """Price times a quantity with quarters, delivered as double, text and decimal."""
    units = F.col("l_quantity") / 4
    forms = {"FromDouble": "double", "FromText": "string", "FromDecimal": "decimal(17,6)"}
    lines = raw.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("price"),
        *[units.cast(form).alias(name) for name, form in forms.items()],
    )
    amounts = [line_amount(F.col("price"), F.col(name)).alias(name) for name in forms]
    return lines.select("l_orderkey", "l_linenumber", *amounts, quantity(F.col("FromText")).alias("Units"))


def _key_usage(star: Star) -> DataFrame:
    return quality.key_usage(*star.tables(quality.MEMBER_KEYS).values())


def _third_source(spark: SparkSession, root: str) -> DataFrame:
    """Two systems are released, a third is added, and what is stored is compared."""
    path = new_folder(spark)
    release(spark, _star(spark, root).sources, path)
    before = quality.fingerprint(ReleasedStar(spark, path).fact_sales)
    release(spark, _star(spark, root, SIGNUPS).sources, path)
    after = ReleasedStar(spark, path)
    made = stored(presented(quality.history_check(before, after.fact_sales, after.dim_source_system)))
    files.delete(spark, path)
    return made


def _staged_load(spark: SparkSession, root: str) -> DataFrame:
    """Three systems are released; their lines as observed while written, next to what is stored."""
    path = new_folder(spark)
    release(spark, _star(spark, root, ORDERS, EVENTS, INTAKE).sources, path)
    loaded = ReleasedStar(spark, path)
    counts = ("SourceLines", "LostInJoins", "Rejected", "FactRows")
    ids = ("SourceSystemID", "SourceSystemName")
    seen = loaded.observed_volume().select(*ids, *[F.col(c).alias(f"Observed{c}") for c in counts])
    made = stored(loaded.stored_volume().join(F.broadcast(seen), list(ids)))
    files.delete(spark, path)
    return made


def _reports_after_reload(spark: SparkSession, root: str) -> DataFrame:
    """Two systems are released and one is reloaded without every fifth event: sums as stored, bounds from footers."""
    path = new_folder(spark)
    star = _star(spark, root)
    release(spark, star.sources, path)
    events = star.sources[1]
    fewer = events.raw.replacing(events=events.raw.table("events").where("event_id % 5 != 0"))
    release(spark, [Source(events.spec, fewer)], path)
    now = ReleasedStar(spark, path)
    sums = bi.source_system_comparison(now.header_sales, now.dim_source_system)
    # One row, as it is known from the footers.
    facts = now.date_bounds().withColumn("FactRows", F.lit(now.fact_rows()).cast("bigint"))
    made = stored(presented(sums.crossJoin(F.broadcast(facts))))
    files.delete(spark, path)
    return made


def _calendar_filter(star: Star) -> DataFrame:
    """Sales of third quarters by source and year."""
    year = F.col("DateKey").substr(1, 4).cast("int")
    chosen = star.sales_on(F.col("Quarter") == 3)
    return chosen.groupBy("SourceSystemID", year.alias("Year")).agg(
        F.sum("SalesAmount").alias("SalesAmount"), F.sum("SalesQuantity").alias("SalesQuantity")
    )


def _kept_loads(spark: SparkSession, root: str) -> tuple[str, Source]:
    """Members of ORDERS as two loads delivered them: the later one with columns that came, went and changed."""
    (orders,) = testdata.sources(spark, root, ORDERS)
    spec = replace(orders.spec, tables=("customer", "part"))
    path = new_folder(spark)
    retain_raw(Source(spec, orders.raw), path, "a")
    customer = orders.raw.table("customer").drop("c_mktsegment").withColumn("c_since", F.lit("2024-01-01").cast("date"))
    part = orders.raw.table("part").withColumns(
        {"p_size": F.col("p_size").cast("bigint"), "p_retailprice": F.col("p_retailprice").cast("string")}
    )
    retain_raw(Source(spec, orders.raw.replacing(customer=customer, part=part)), path, "b")
    return path, Source(spec, orders.raw)


def _schema_drift(spark: SparkSession, root: str) -> DataFrame:
    path, source = _kept_loads(spark, root)
    made = stored(drift.schema_drift(spark, path, source.spec.name, source.spec.tables, "a", "b"))
    files.delete(spark, path)
    return made


def _loads_together(spark: SparkSession, root: str) -> DataFrame:
    """Rows and filled values of both loads, read under one schema."""
    path, source = _kept_loads(spark, root)
    parts = []
    for table in source.spec.tables:
        rows = drift.read_loads(spark, path, source.spec.name, table, ["a", "b"])
        columns = [c for c in rows.columns if c != "load"]
        counts = rows.groupBy("load").agg(F.count("*").alias("RowCount"), *[F.count(c).alias(c) for c in columns])
        long = counts.unpivot(["load", "RowCount"], columns, "ColumnName", "FilledRows")
        parts.append(long.select(F.lit(table).alias("TableName"), F.col("load").alias("Load"), "RowCount", "ColumnName", "FilledRows"))
    made = stored(union_all(parts))
    files.delete(spark, path)
    return made


def _retained_load(spark: SparkSession, root: str) -> DataFrame:
    """Sales of ORDERS made from a retained load, as if the source were gone."""
    (orders,) = testdata.sources(spark, root, ORDERS)
    path = new_folder(spark)
    retain_raw(orders, path, "a")
    kept = RawZone.parquet(spark, f"{path}/{orders.spec.name}", suffix="/load=a")
    star = Star(spark, [Source(orders.spec, kept)])
    made = stored(presented(bi.sales_by_year_month(star.header_sales, star.dim_time)))
    files.delete(spark, path)
    return made


def _business_tables(star: Star) -> DataFrame:
    """The inventory of a source that also lists tables of its storage system: those are not even opened."""
    listed = [
        Source(replace(s.spec, tables=(*s.spec.tables, "sqlite_sequence", "SQLITE_stat1")), s.raw) for s in star.sources
    ]
    return profile.table_inventory(listed)


def _selected_totals(star: Star) -> DataFrame:
    """Documented totals against a selection of everything, and against parts: those have no figures to be held to."""
    documented = testdata.raw_totals(star.sources[0].raw)
    selections = {
        "all": filters.Selection(),
        "all sources by name": filters.Selection(["Orders", "Events"]),
        "one source": filters.Selection(["Orders"]),
        "some days": filters.Selection(None, FILTER_FIRST, FILTER_LAST),
    }
    checks = [
        acceptance.check_totals(star.header_sales, star.dim_source_system, documented, selection=selection).withColumn(
            "Selection", F.lit(name)
        )
        for name, selection in selections.items()
    ]
    return union_all(checks)


def _two_loads(compare: Callable[[SparkSession, str, str], DataFrame]) -> Query:
    """A comparison of the ids of two stored loads of ORDERS."""

    def run(spark: SparkSession, root: str) -> DataFrame:
        (source,) = testdata.sources(spark, root, ORDERS)
        path = new_folder(spark)
        store_keys(source, f"{path}/a")
        store_keys(Source(source.spec, testdata.next_load(source.raw)), f"{path}/b")
        made = stored(compare(spark, f"{path}/a", f"{path}/b"))
        files.delete(spark, path)
        return made

    return run


def _pk_uniqueness(star: Star) -> DataFrame:
    return union_all(profile.pk_uniqueness(s) for s in star.sources)


QUERIES: dict[str, Query] = {
    # model
    "dim_source_system": _on_star(_dim_source_system),
    "dim_customer": _on_star(lambda s: s.dim_customer),
    "dim_employee": _on_star(lambda s: s.dim_employee),
    "dim_product": _on_star(lambda s: s.dim_product),
    "dim_time": _on_star(lambda s: s.dim_time.orderBy("DateKey")),
    "fact_sales": _on_star(lambda s: s.fact_sales),
    "canonical_keys": _on_raw(_canonical_keys),
    "person_name": _on_raw(_person_name),
    "indirect_attribution": _on_star(
        lambda s: bi.indirect_attribution(
            filters.filter_sales(s.fact_sales, s.source_ids(["Events"])), s.dim_employee
        )
    ),
    "attribute_coverage": _on_star(lambda s: quality.attribute_coverage(s.sources)),
    # reports
    "revenue_by_source": _on_star(lambda s: bi.revenue_by_source(s.header_sales, s.dim_source_system)),
    "filtered_revenue": _on_star(lambda s: bi.revenue_by_source(_filtered(s, s.header_sales, "Orders"), s.dim_source_system)),
    "top_customers": _on_star(
        lambda s: bi.top_customers(s.header_sales, s.dim_customer, s.dim_source_system)
    ),
    "top_customers_split": _on_star(
        lambda s: bi.top_customers(
            s.header_sales, s.dim_customer, s.dim_source_system, split_by_source=True
        )
    ),
    "top_customers_per_source": _on_star(
        lambda s: bi.top_customers_per_source(s.header_sales, s.dim_customer, s.dim_source_system)
    ),
    "top_products": _on_star(lambda s: bi.top_products(s.fact_sales, s.dim_product)),
    "top_products_by_quantity": _on_star(
        lambda s: bi.top_products(s.fact_sales, s.dim_product, order_by="SalesQuantity")
    ),
    "top_products_by_source": _on_star(
        lambda s: bi.top_products(
            s.fact_sales, s.dim_product, dim_source_system=s.dim_source_system
        )
    ),
    "employee_performance": _on_star(
        lambda s: bi.employee_performance(s.fact_sales, s.dim_employee, s.dim_source_system)
    ),
    "employee_performance_split": _on_star(
        lambda s: bi.employee_performance(
            s.fact_sales, s.dim_employee, s.dim_source_system, split_by_source=True
        )
    ),
    "sales_by_period_day": _period("Day"),
    "sales_by_period_month": _period("Month"),
    "sales_by_period_quarter": _period("Quarter"),
    "sales_by_period_year": _period("Year"),
    "sales_by_period_source": _period("Month", split=True),
    "period_source_pivot": _on_star(
        lambda s: bi.period_source_pivot(
            s.header_sales, s.dim_time, s.dim_source_system, sorted(x.spec.name for x in s.sources)
        )
    ),
    "sales_by_year_month": _on_star(lambda s: bi.sales_by_year_month(s.header_sales, s.dim_time)),
    "sales_by_day_of_week": _on_star(lambda s: bi.sales_by_day_of_week(s.header_sales, s.dim_time)),
    "sales_by_day_of_month": _on_star(lambda s: bi.sales_by_day_of_month(s.header_sales, s.dim_time)),
    "source_system_comparison": _on_star(
        lambda s: bi.source_system_comparison(s.header_sales, s.dim_source_system)
    ),
    "revenue_share": _on_star(lambda s: bi.revenue_share(s.header_sales, s.dim_source_system)),
    "scale_gap": _on_star(_scale_gap),
    "totals_rollup": _on_star(lambda s: bi.totals_rollup(s.header_sales, s.dim_source_system)),
    "totals_check": _on_star(_totals_check),
    "totals_check_selected": _on_star(_selected_totals),
    "date_bounds": _on_star(lambda s: s.date_bounds()),
    "calendar_filter": _on_star(_calendar_filter),
    "sales_by_classification": _on_star(
        lambda s: bi.sales_by_classification(s.fact_sales, s.dim_product)
    ),
    "sales_by_title": _on_star(lambda s: bi.sales_by_title(s.fact_sales, s.dim_employee)),
    "fact_narrative": _on_star(lambda s: _narrate(s, s.named_sales("CustomerName"))),
    "picked_row_narrative": _on_star(
        lambda s: _narrate(s, narrate.nth_fact_row(_filtered(s, s.fact_sales, "Orders", "Events"), PICKED_ROW))
    ),
    "top_parents_by_children": _on_raw(
        lambda raw: bi.top_parents_by_children(
            raw.table("nation"),
            raw.table("supplier"),
            "n_nationkey",
            "n_name",
            "s_suppkey",
            "s_nationkey",
        )
    ),
    "parent_child_listing": _on_raw(
        lambda raw: bi.parent_child_listing(
            raw.table("nation"),
            raw.table("supplier"),
            "n_nationkey",
            "n_name",
            "s_nationkey",
            "s_name",
        )
    ),
    "employee_manager": _on_star(lambda s: hierarchy.employee_manager(s.dim_employee)),
    "manager_rollup": _on_star(lambda s: hierarchy.manager_rollup(s.fact_sales, s.dim_employee)),
    "line_measure": _on_raw(_line_measure),
    "header_reconciliation": _on_raw(_header_reconciliation),
    # quality
    "dq_key_nulls": _on_star(lambda s: quality.key_nulls(s.fact_sales), ORDERS, EVENTS, INTAKE),
    "dq_duplicate_lines": _each_source(quality.duplicate_lines),
    "dq_orphans": _on_star(lambda s: quality.orphans(_key_usage(s)), ORDERS, EVENTS, INTAKE),
    "key_consistency": _on_star(
        lambda s: quality.key_consistency(_key_usage(s)), ORDERS, EVENTS, INTAKE
    ),
    "dq_bad_dates": _each_source(quality.bad_dates),
    "dq_bad_measures": _each_source(quality.bad_measures),
    "quarantine": _each_source(
        lambda source: quality.triage(source).select("SourceSystemID", "LineKey", "Status", "Reason")
    ),
    "dq_violations": _each_source(quality.violations),
    "third_source": _third_source,
    "staged_load": _staged_load,
    "reports_after_reload": _reports_after_reload,
    "schema_drift": _schema_drift,
    "loads_together": _loads_together,
    "retained_load": _retained_load,
    "key_stability": _two_loads(stability),
    "key_changes": _two_loads(key_changes),
    "source_volume": _on_star(lambda s: quality.source_volume(s.sources), ORDERS, EVENTS, INTAKE),
    # profile
    "table_inventory": _on_star(lambda s: profile.table_inventory(s.sources)),
    "business_tables": _on_star(_business_tables),
    "source_inventory": _on_star(lambda s: profile.source_inventory(s.sources)),
    "profile_columns": _on_star(lambda s: profile.profile_columns(s.sources)),
    "pk_uniqueness": _on_star(_pk_uniqueness),
    "discovered_keys": _on_star(lambda s: keyfinder.discovered_keys(s.sources[0])),
    "source_foreign_keys": _on_star(lambda s: quality.source_foreign_keys(s.sources)),
}
