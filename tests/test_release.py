from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starmart import Source, Star
from starmart.operators import bi, quality
from starmart.plans import release as rel
from starmart.plans.release import ReleasedStar, clear, manifest, release, versions, withdraw
from starmart.schema import DIM_CUSTOMER
from tests.test_publish import plan, rows


@pytest.fixture(scope="module")
def released(spark, star, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("releases"))
    assert release(spark, star.sources, path) == 1
    return ReleasedStar(spark, path)


def test_released_tables_equal_the_star(star, released):
    for name, df in star.tables().items():
        read = released.tables()[name]
        assert read.columns == df.columns
        assert rows(read) == rows(df), name


def test_reports_and_filters_run_on_a_release(star, released):
    made = bi.source_system_comparison(released.header_sales, released.dim_source_system)
    assert rows(made) == rows(bi.source_system_comparison(star.header_sales, star.dim_source_system))
    chosen = (["Northwind"], date(2016, 7, 4), date(2016, 12, 31))
    made = released.sales(*chosen)
    assert rows(made) == rows(star.sales(*chosen))
    text = plan(made)
    filters = text[text.index("PartitionFilters") : text.index("PushedFilters")]
    assert "Year" in filters and "Status" in filters


def test_lines_not_loaded_are_kept_with_raw_values(star, food, released):
    kept = released.not_loaded.where("SourceSystemID = 2")
    _, rejected = quality.quarantine(food)
    columns = ["LineKey", "RawDate", "RawQuantity", "RawPrice", "CustomerID", "ProductID", "Reason"]
    assert rows(kept.where("Status = 'rejected'").select(columns)) == rows(rejected.select(columns))
    lost = kept.where("Status = 'lost'").collect()
    volume = {r.SourceSystemID: r for r in quality.source_volume(star.sources).collect()}
    assert len(lost) == volume[2].LostInJoins > 0
    assert all(r.Reason == "no header or customer" and r.RawQuantity is not None for r in lost)
    assert released._lines.where("Status = 'loaded' AND RawPrice IS NOT NULL").isEmpty()


def test_volumes_observed_while_writing_are_those_of_the_source(star, released):
    expected = rows(quality.source_volume(star.sources))
    assert rows(released.observed_volume()) == rows(released.stored_volume()) == expected


def test_lines_are_joined_once(food, no_broadcast):
    text = plan(quality.delivered_lines(food))
    assert text.count("SortMergeJoin") == 1


def test_readers_keep_the_old_release_if_a_load_fails_between_two_tables(spark, star, food, tmp_path, monkeypatch):
    path = str(tmp_path)
    release(spark, star.sources, path)
    before = ReleasedStar(spark, path)
    expected = {name: rows(df) for name, df in before.tables().items()}
    late = food.raw.table("Orders").where("OrderDate >= '2016-10'")
    reloaded = Source(food.spec, food.raw.replacing(Orders=late))

    real = rel._write_members

    def failing(df, folder, table, system_id):
        if table == "DimProduct":
            raise RuntimeError("the disk is full")
        real(df, folder, table, system_id)

    monkeypatch.setattr(rel, "_write_members", failing)
    with pytest.raises(RuntimeError):
        release(spark, [reloaded], path)
    assert versions(spark, path) == [1]
    again = ReleasedStar(spark, path)
    assert {name: rows(df) for name, df in again.tables().items()} == expected
    monkeypatch.undo()
    assert release(spark, [reloaded], path) == 2
    assert rows(ReleasedStar(spark, path).sales(["Northwind"])) == rows(Star(spark, [reloaded]).fact_sales)
    # A reader that has opened the first release still reads it, and it can be opened again.
    assert rows(before.fact_sales) == expected["FactSales"]
    assert rows(ReleasedStar(spark, path, 1).fact_sales) == expected["FactSales"]


def test_two_writers_at_once_both_get_in(spark, music, food, tmp_path, monkeypatch):
    path = str(tmp_path)
    real, raced = rel.files.put_if_absent, []

    def slow(spark, name, text, draft):
        if not raced:
            raced.append(name)
            monkeypatch.setattr(rel.files, "put_if_absent", real)
            assert release(spark, [food], path) == 1
        return real(spark, name, text, draft)

    monkeypatch.setattr(rel.files, "put_if_absent", slow)
    assert release(spark, [music], path) == 2
    assert {e["name"] for e in manifest(spark, path)["sources"].values()} == {"Chinook", "Northwind"}
    assert rows(ReleasedStar(spark, path).fact_sales) == rows(Star(spark, [music, food]).fact_sales)


def test_withdrawing_and_clearing(spark, star, music, tmp_path):
    path = str(tmp_path)
    assert manifest(spark, path) == {"version": 0, "sources": {}}
    release(spark, star.sources, path)
    release(spark, [music], path)
    assert withdraw(spark, path, 2) == 3
    now = ReleasedStar(spark, path)
    assert now.fact_sales.select("SourceSystemID").distinct().collect() == [(1,)]
    assert clear(spark, path, keep=1) == []  # too young: somebody may be writing them
    assert versions(spark, path) == [3]
    assert len(clear(spark, path, keep=1, idle_hours=0)) == 2
    assert rows(now.fact_sales) == rows(Star(spark, [music]).fact_sales)
    with pytest.raises(ValueError):
        clear(spark, path, keep=0)


def test_a_release_without_sources_has_no_rows(spark, tmp_path):
    empty = ReleasedStar(spark, str(tmp_path))
    assert empty.version == 0 and empty.fact_sales.count() == 0 and empty.dim_time.count() == 0


def test_id_changes_between_releases(spark, food, tmp_path):
    path = str(tmp_path)
    customers = food.raw.table("Customers")
    release(spark, [food], path)
    release(spark, [food], path)
    first, second = ReleasedStar(spark, path, 1), ReleasedStar(spark, path, 2)
    assert second.key_changes_since(first, 2).count() == 0
    new_id = F.when(F.col("CustomerID") == "VINET", "VINEX").otherwise(F.col("CustomerID"))
    moved = customers.withColumn("CustomerID", new_id)
    release(spark, [Source(food.spec, food.raw.replacing(Customers=moved))], path)
    third = ReleasedStar(spark, path)
    changes = Counter(tuple(r) for r in third.key_changes_since(second, 2).collect())
    assert changes == {("DimCustomer", "renamed", "NORTHWIND:VINET", "NORTHWIND:VINEX"): 1}
    totals = {r.Dimension: r for r in third.stability_since(second, 2).collect()}
    n = customers.count()
    assert (totals["DimCustomer"].KeysBefore, totals["DimCustomer"].Renamed, totals["DimCustomer"].Stable) == (n, 1, n - 1)
    assert totals["DimProduct"].Stable == totals["DimProduct"].KeysAfter > 0


def test_reports_from_stored_sums_equal_those_from_the_fact_after_a_reload(spark, star, food, tmp_path):
    path = str(tmp_path)
    release(spark, star.sources, path)
    before = ReleasedStar(spark, path)
    late = food.raw.table("Orders").where("OrderDate >= '2016-10'")
    reloaded = Source(food.spec, food.raw.replacing(Orders=late))
    release(spark, [reloaded], path)
    now, plain = ReleasedStar(spark, path), Star(spark, [star.sources[0], reloaded])
    for released, whole in ((before, star), (now, plain)):
        for report in (
            lambda s, f: bi.source_system_comparison(f, s.dim_source_system),
            lambda s, f: bi.totals_rollup(f, s.dim_source_system),
            lambda s, f: bi.top_customers(f, s.dim_customer, s.dim_source_system),
            lambda s, f: bi.sales_by_period(f, s.dim_time, s.dim_source_system, "Month", False),
        ):
            assert rows(report(released, released.header_sales)) == rows(report(whole, whole.header_sales))
    assert "Lines/" not in plan(now.header_sales)
    # The other source's sums are those of the first release.
    assert now.manifest["sources"]["1"] == before.manifest["sources"]["1"]


def test_a_release_tells_bounds_from_footers_and_prunes_by_calendar(star, released):
    assert rows(released.date_bounds()) == rows(star.date_bounds())
    assert released.fact_rows() == star.fact_sales.count()
    quarter = F.col("Quarter") == 3
    assert rows(released.sales_on(quarter)) == rows(star.sales_on(quarter))
    assert "dynamicpruning" in plan(released.sales_on(quarter))


def test_old_files_are_read_with_a_new_attribute(released):
    grown = StructType([*DIM_CUSTOMER.fields, StructField("Segment", StringType())])
    made = released._read("DimCustomer", grown)
    assert made.columns[-1] == "Segment" and made.where("Segment IS NOT NULL").isEmpty()
    assert made.count() == released.dim_customer.count() > 0
