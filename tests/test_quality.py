from dataclasses import replace

import pytest

from starmart import Source, Star
from starmart.operators import hierarchy, profile, quality
from starmart.schema import DIM_EMPLOYEE
from starmart.sources.spec import ForeignKey


def rows(df):
    return [tuple(r) for r in df.collect()]


def usage(star):
    return quality.key_usage(*star.tables().values())


def test_key_nulls(star):
    made = {(r.SourceSystemID, r.KeyColumn): r.NullRows for r in quality.key_nulls(star.fact_sales).collect()}
    assert made == {
        (1, "DateKey"): 1,
        (1, "CustomerID"): 0,
        (1, "EmployeeID"): 1,
        (1, "ProductID"): 0,
        (2, "DateKey"): 2,
        (2, "CustomerID"): 1,
        (2, "EmployeeID"): 1,
        (2, "ProductID"): 0,
    }


def test_duplicate_lines(spark, food):
    again = food.raw.table("Order Details").where("OrderID = 10248 and ProductID = 11")
    raw = food.raw.replacing(**{"Order Details": food.raw.table("Order Details").union(again)})
    assert rows(quality.duplicate_lines(Source(food.spec, raw))) == [(2, "10248|11", 2)]
    assert rows(quality.duplicate_lines(food)) == []


def test_orphans(star):
    assert sorted(rows(quality.orphans(usage(star)))) == [
        ("CustomerID", "NORTHWIND:GHOST", 1),
        ("EmployeeID", "NORTHWIND:9", 1),
        ("ProductID", "NORTHWIND:77", 1),
    ]


def test_key_consistency(star):
    made = {(r.ForeignKey, r.Namespace): r for r in quality.key_consistency(usage(star)).collect()}
    food = made["CustomerID", "NORTHWIND"]
    assert (food.UsedKeys, food.DefinedKeys, food.SharedKeys, food.OrphanKeys) == (3, 2, 2, 1)
    assert made["DateKey", ""].OrphanKeys == 0
    assert made["ReportsTo", "CHINOOK"].UsedKeys == 2
    assert sum(r.RepeatedMembers for r in made.values()) == 0


def test_repeated_members_show(spark, star, food):
    twice = food.raw.table("Customers").union(food.raw.table("Customers"))
    doubled = Star(spark, [star.sources[0], Source(food.spec, food.raw.replacing(Customers=twice))])
    made = {(r.ForeignKey, r.Namespace): r for r in quality.key_consistency(usage(doubled)).collect()}
    assert made["CustomerID", "NORTHWIND"].RepeatedMembers == 2


def test_bad_dates(music, food):
    assert sorted(rows(quality.bad_dates(food)), key=lambda r: r[1]) == [
        (2, "10250|42", "", "date missing"),
        (2, "10250|77", "", "date missing"),
        (2, "10251|11", None, "date missing"),
    ]
    assert rows(quality.bad_dates(music)) == [(1, "4", "junk", "date not readable")]


def test_bad_measures_and_quarantine(food):
    assert rows(quality.bad_measures(food)) == [(2, "10250|42", None, "3.00", "quantity missing", False)]
    loaded, rejected = quality.quarantine(food)
    assert loaded.count() == 6
    assert [(r.LineKey, r.Reason) for r in rejected.collect()] == [("10250|42", "quantity missing")]


@pytest.mark.parametrize(
    "quantity, price, reason, loaded",
    [
        ("1", "2.50", None, True),
        ("two", "2.50", "quantity not a number", False),
        (None, "2.50", "quantity missing", False),
        ("1", "free", "price not a number", False),
        ("1", None, "price missing", False),
        ("0", "2.50", "quantity not positive", True),
        ("-3", "2.50", "quantity not positive", True),
        ("1", "-1.00", "price negative", True),
        ("1", "1e30", "price not a number", False),
    ],
)
def test_measure_rules_on_text(spark, food, quantity, price, reason, loaded):
    line = spark.createDataFrame(
        [(10248, 11, price, quantity)], "OrderID bigint, ProductID bigint, UnitPrice string, Quantity string"
    )
    source = Source(food.spec, food.raw.replacing(**{"Order Details": line}))
    made = quality.bad_measures(source).collect()
    assert [(r.Reason, r.Loaded) for r in made] == ([] if reason is None else [(reason, loaded)])
    assert quality.triage(source).first().Status == ("loaded" if loaded else "rejected")
    assert Star(spark, [source]).fact_sales.count() == int(loaded)


def test_violations_lists_every_finding(food):
    again = food.raw.table("Order Details").where("OrderID = 10250 and ProductID = 42")
    raw = food.raw.replacing(**{"Order Details": food.raw.table("Order Details").union(again)})
    made = sorted(rows(quality.violations(Source(food.spec, raw))))
    assert made == [
        ("date", 2, "10250|42", "date missing"),
        ("date", 2, "10250|42", "date missing"),
        ("date", 2, "10250|77", "date missing"),
        ("date", 2, "10251|11", "date missing"),
        ("duplicate line", 2, "10250|42", "2 copies"),
        ("measure", 2, "10250|42", "quantity missing"),
        ("measure", 2, "10250|42", "quantity missing"),
    ]


def test_source_volume_accounts_for_every_line(star):
    made = {r.SourceSystemName: tuple(r)[2:] for r in quality.source_volume(star.sources).collect()}
    assert made == {"Chinook": (6, 2, 0, 4), "Northwind": (8, 1, 1, 6)}
    for delivered, lost, rejected, loaded in made.values():
        assert delivered == lost + rejected + loaded


def test_attribute_coverage(star):
    made = {
        (r.SourceSystemName, r.TargetTable, r.TargetColumn): r
        for r in quality.attribute_coverage(star.sources).collect()
    }
    assert len(made) == 2 * (7 + 7 + 9 + 6 + 6)
    email = made["Northwind", "DimCustomer", "Email"]
    assert (email.Rule, email.FilledRows, email.Holds) == ("unmapped", 0, True)
    assert made["Chinook", "DimProduct", "GenreName"].FilledRows == 1
    assert made["Chinook", "FactSales", "DateKey"].FilledRows == 3
    assert all(r.Holds for r in made.values())


def test_attribute_coverage_reports_a_broken_promise(spark, food):
    nameless = spark.createDataFrame([(11, None, 4, None, None)], food.raw.table("Products").schema)
    source = Source(food.spec, food.raw.replacing(Products=nameless))
    made = {r.TargetColumn: r.Holds for r in quality.attribute_coverage([source]).collect() if r.TargetTable == "DimProduct"}
    assert made["ProductName"] is False and made["ProductID"] is True


def test_source_foreign_keys(star):
    made = {(r.SourceSystem, r.ForeignKey): r for r in quality.source_foreign_keys(star.sources).collect()}
    lines = made["Chinook", "InvoiceLine(InvoiceId)"]
    assert (lines.ChildRows, lines.ChildKeys, lines.OrphanKeys, lines.OrphanRows) == (6, 5, 1, 1)
    managers = made["Northwind", "Employees(ReportsTo)"]
    assert (managers.ChildRows, managers.OrphanKeys) == (2, 0)
    assert made["Northwind", "Orders(CustomerID)"].OrphanRows == 1


def test_composite_foreign_key(spark, food):
    key = ForeignKey("Order Details", ("OrderID", "ProductID"), "Order Details", ("OrderID", "ProductID"))
    row = quality.foreign_key_usage(food, key).first()
    assert (row.ChildRows, row.ChildKeys, row.OrphanKeys) == (8, 8, 0)


def test_history_check(spark, star, music):
    third = Source(replace(music.spec, system_id=3, name="Third", prefix="THIRD"), music.raw)
    after = Star(spark, [*star.sources, third])
    made = {r.SourceSystemID: r for r in quality.history_check(quality.fingerprint(star.fact_sales), after.fact_sales, after.dim_source_system).collect()}
    assert [made[i].HistoryUnchanged for i in (1, 2, 3)] == [True, True, None]
    moved = after.fact_sales.withColumn("ProductID", after.fact_sales.CustomerID)
    changed = quality.history_check(quality.fingerprint(star.fact_sales), moved, after.dim_source_system).collect()
    assert {r.SourceSystemID: r.HistoryUnchanged for r in changed}[1] is False


def test_inventories(star):
    made = {(r.SourceSystem, r.TableName): (r.RecordCount, r.ColumnCount) for r in profile.table_inventory(star.sources).collect()}
    assert made["Northwind", "Order Details"] == (8, 5)
    assert len(made) == 24
    totals = {r.SourceSystem: tuple(r)[1:] for r in profile.source_inventory(star.sources).collect()}
    assert totals["Chinook"][0] == 11 and totals["Chinook"][3] == 11


def test_system_tables_are_left_out(spark, food):
    spec = replace(food.spec, tables=("Orders", "SQLITE_sequence"))
    raw = food.raw.replacing(SQLITE_sequence=spark.range(3))
    made = profile.table_inventory([Source(spec, raw)]).collect()
    assert [r.TableName for r in made] == ["Orders"]
    assert profile.system_tables(spec.tables) == ["SQLITE_sequence"]


def test_profile(food):
    made = {r.ColumnName: r for r in profile.profile_table("Orders", food.raw.table("Orders"), ["OrderID"]).collect()}
    assert (made["CustomerID"].FilledRows, made["CustomerID"].MissingRows) == (4, 1)
    assert made["OrderID"].DataType == "bigint" and made["OrderDate"].DataType == "string"
    assert [c for c, r in made.items() if r.IsPrimaryKey] == ["OrderID"]


def test_pk_uniqueness(spark, food):
    bad = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "CategoryID bigint, CategoryName string")
    source = Source(food.spec, food.raw.replacing(Categories=bad))
    made = {r.TableName: r for r in profile.pk_uniqueness(source).collect()}
    row = made["Categories"]
    assert (row.RecordCount, row.DistinctKeys, row.RepeatedKeys, row.NullKeyRows, row.IsPrimaryKey) == (3, 1, 1, 1, False)
    assert made["Order Details"].IsPrimaryKey and made["Order Details"].KeyColumns == "OrderID,ProductID"


def test_employee_manager(star):
    made = {r.EmployeeID: r.ManagerName for r in hierarchy.employee_manager(star.dim_employee).collect()}
    assert made["CHINOOK:3"] == "Nancy Edwards"
    assert made["CHINOOK:1"] is None and made["NORTHWIND:6"] == "Steven Buchanan"
    assert len(made) == 7


def test_employee_manager_without_broadcasts(star, no_broadcast):
    assert hierarchy.employee_manager(star.dim_employee).count() == 7


def staff(spark, managers):
    members = [(f"S:{e}", f"E{e}", None, None, None, None if m is None else f"S:{m}") for e, m in managers]
    return spark.createDataFrame(members, DIM_EMPLOYEE)


def test_manager_rollup(star):
    made = {r.EmployeeID: (r.PeopleBelow, str(r.OwnAmount), str(r.TeamAmount)) for r in hierarchy.manager_rollup(star.fact_sales, star.dim_employee).collect()}
    assert made == {
        "CHINOOK:1": (3, "0.00", "4.96"),
        "CHINOOK:2": (2, "0.00", "4.96"),
        "CHINOOK:3": (0, "2.97", "2.97"),
        "CHINOOK:4": (0, "1.99", "1.99"),
        "NORTHWIND:2": (2, "0.00", "316.00"),
        "NORTHWIND:5": (1, "286.00", "316.00"),
        "NORTHWIND:6": (0, "30.00", "30.00"),
    }


def test_manager_rollup_of_a_flat_staff(spark, star):
    made = hierarchy.manager_rollup(star.fact_sales, staff(spark, [(1, None), (2, None)]))
    assert {r.PeopleBelow for r in made.collect()} == {0}


def test_manager_rollup_refuses_a_cycle_and_who_is_below_it(spark, star):
    managers = [(1, 2), (2, 3), (3, 1), (4, 3), (5, None)]
    with pytest.raises(ValueError, match="cyclic.*S:1, S:2, S:3, S:4$"):
        hierarchy.manager_rollup(star.fact_sales, staff(spark, managers))


@pytest.mark.parametrize("levels", [101, 1000])
def test_manager_rollup_of_a_long_chain(spark, star, levels):
    chain = staff(spark, [(k, k - 1 if k else None) for k in range(levels)])
    made = hierarchy.manager_rollup(star.fact_sales, chain).collect()
    assert {r.EmployeeID: r.PeopleBelow for r in made} == {f"S:{k}": levels - 1 - k for k in range(levels)}


def test_a_self_report_heads_a_team_and_is_a_finding(spark, star):
    people = staff(spark, [(1, 1), (2, 1), (3, 99)])
    made = hierarchy.manager_rollup(star.fact_sales, people).collect()
    assert {r.EmployeeID: r.PeopleBelow for r in made} == {"S:1": 1, "S:2": 0, "S:3": 0}
    assert [r.EmployeeID for r in hierarchy.self_reports(people).collect()] == ["S:1"]
