from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmart import RawZone, Source, Star
from starmart.plans import drift
from starmart.plans.publish import retain_raw
from tests.test_publish import rows

S = StructType.fromDDL


@pytest.mark.parametrize(
    "one, two, both",
    [
        ("int", "bigint", "bigint"), ("smallint", "tinyint", "smallint"), ("float", "double", "double"),
        ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(10,2)", "int", "decimal(12,2)"),
        ("bigint", "decimal(5,3)", "decimal(22,3)"), ("decimal(38,10)", "decimal(38,0)", None),
        ("string", "int", None), ("double", "bigint", None), ("double", "decimal(4,2)", None), ("date", "date", "date"),
    ],
)
def test_wider_types_hold_both(one, two, both):
    a, b = S(f"x {one}")[0].dataType, S(f"x {two}")[0].dataType
    expected = S(f"x {both}")[0].dataType if both else None
    assert drift.wider(a, b) == drift.wider(b, a) == expected


def test_changes_of_columns():
    before = S("id int, name string, price decimal(10,2), gone date, Same string, n bigint, t string")
    after = S("id bigint, name string, price decimal(12,2), new double, SAME string, n int, t int")
    assert {c[:2] for c in drift.compared(before, after)} == {
        ("id", "widened"), ("price", "widened"), ("gone", "gone"), ("new", "added"), ("SAME", "renamed"),
        ("n", "narrowed"), ("t", "retyped"),
    }
    assert drift.compared(before, before) == []
    assert {c[1] for c in drift.compared(None, after)} == {"added"}
    assert {c[1] for c in drift.compared(before, None)} == {"gone"}


def test_merged_schema():
    merged = drift.merged_schema([S("a int, b string, c int"), S("A bigint, c string, d date")])
    assert merged.simpleString() == "struct<a:bigint,b:string,c:string,d:date>"


def changed(food):
    orders = food.raw.table("Orders").withColumn("Freight", F.lit(1.5)).withColumn("EmployeeID", F.col("EmployeeID").cast("int"))
    return Source(food.spec, food.raw.replacing(Orders=orders))


def test_loads_with_other_columns_are_read_together(spark, food, tmp_path):
    path, later = str(tmp_path), changed(food)
    retain_raw(food, path, "a")
    retain_raw(later, path, "b")
    made = drift.schema_drift(spark, path, "Northwind", food.spec.tables, "a", "b")
    assert Counter((r.TableName, r.ColumnName, r.Change) for r in made.collect()) == {
        ("Orders", "Freight", "added"): 1, ("Orders", "EmployeeID", "narrowed"): 1,
    }
    both = drift.read_loads(spark, path, "Northwind", "Orders", ["a", "b", "none"])
    n = food.raw.table("Orders").count()
    assert Counter((r.load, r.Freight) for r in both.collect()) == {("a", None): n, ("b", 1.5): n}
    assert dict(both.dtypes)["EmployeeID"] == "bigint"
    assert drift.read_loads(spark, path, "Northwind", "Nothing", ["a"]).count() == 0
    gone = drift.schema_drift(spark, path, "Northwind", ["Orders"], "b", "none").collect()
    assert {r.Change for r in gone} == {"gone"}


def test_an_old_load_still_makes_the_same_star(spark, food, tmp_path):
    path = str(tmp_path)
    retain_raw(food, path, "a")
    retain_raw(changed(food), path, "b")

    def read(load):
        return lambda name: drift.read_loads(spark, path, "Northwind", name, ["a", "b"]).where(F.col("load") == load)

    old, new = (Star(spark, [Source(food.spec, RawZone(read(load)))]).fact_sales for load in ("a", "b"))
    assert rows(old) == rows(new) == rows(Star(spark, [food]).fact_sales)
