from collections import Counter

import pytest
from pyspark.sql import functions as F

from starmart import Source
from starmart.plans import stability


def write(spark, path, members):
    """A load of customers given as (id, name)."""
    rows = [("DimCustomer", k, name) for k, name in members]
    keys = spark.createDataFrame(rows, "Dimension string, KeyValue string, Identity string")
    keys = keys.withColumn("Leaf", F.pmod(F.xxhash64("KeyValue"), F.lit(stability.LEAVES)).cast("int"))
    keys.write.parquet(f"{path}/keys")
    stability.checksum_tree(keys).write.parquet(f"{path}/tree")
    return str(path)


OLD = [(f"A:{i}", f"n{i}") for i in range(200)] + [("A:x", None), ("A:t1", "twin"), ("A:t2", "twin"), ("A:d", "p"), ("A:d", "q")]


@pytest.fixture(scope="module")
def loads(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("loads")
    changed = [(k, n) for k, n in OLD if k not in ("A:1", "A:2", "A:3", "A:x", "A:t1", "A:d")]
    changed = [(k, "other" if k == "A:7" else n) for k, n in changed]
    changed += [("A:900", "n2"), ("A:901", "brand new"), ("A:y", None), ("A:t3", "twin"), ("A:d", "p")]
    changed += [("A:b1", "n3"), ("A:b2", "n3")]
    return write(spark, root / "a", OLD), write(spark, root / "b", changed)


EXPECTED = {
    ("gone", "A:1", None), ("renamed", "A:2", "A:900"), ("added", None, "A:901"), ("gone", "A:x", None),
    ("added", None, "A:y"), ("renamed", "A:t1", "A:t3"), ("reassigned", "A:7", "A:7"), ("reassigned", "A:d", "A:d"),
    ("gone", "A:3", None), ("added", None, "A:b1"), ("added", None, "A:b2"),
}


def test_changes_are_told_apart(spark, loads):
    made = stability.key_changes(spark, *loads).collect()
    assert Counter(tuple(r)[1:] for r in made) == Counter(EXPECTED)
    (total,) = stability.stability(spark, *loads).collect()
    assert total.asDict() == {
        "Dimension": "DimCustomer", "KeysBefore": 204, "KeysAfter": 205, "Added": 4, "Gone": 3,
        "Renamed": 2, "Reassigned": 2, "Stable": 197,
    }


def test_only_unequal_leaves_are_read(spark, loads):
    trees = [stability.source_tree(spark, x) for x in loads]
    leaves = stability.unequal_leaves(*trees)
    changed = {k for change in EXPECTED for k in change[1:] if k}
    frame = spark.createDataFrame([(k,) for k in changed], "k string")
    owned = {r[0] for r in frame.select(F.pmod(F.xxhash64("k"), F.lit(stability.LEAVES)).cast("int")).collect()}
    assert set(leaves["DimCustomer"]) == owned and len(owned) < stability.LEAVES / 100
    assert stability.unequal_leaves(trees[0], trees[0]) == {}
    plan = stability.key_changes(spark, *loads)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan or "In(Leaf" in plan


def test_a_tree_adds_up(spark, loads):
    rows = stability.source_tree(spark, loads[0]).collect()
    by_level = {}
    for r in rows:
        by_level.setdefault(r.Level, []).append(r)
    sums = {level: (sum(r.Keys for r in found), sum(r.Checksum for r in found)) for level, found in by_level.items()}
    assert sums[0] == sums[1] == sums[2] and sums[0][0] == 204
    assert {r.Node // stability.FANOUT for r in by_level[2]} == {r.Node for r in by_level[1]}


def test_the_first_load_adds_all_and_none_removes_all(spark, loads):
    assert Counter(r.Change for r in stability.key_changes(spark, None, loads[0]).collect()) == {"added": 204}
    assert Counter(r.Change for r in stability.key_changes(spark, loads[0], None).collect()) == {"gone": 204}
    assert stability.key_changes(spark, None, None).count() == 0


def test_loads_of_a_source(spark, food, tmp_path):
    stability.store_keys(food, f"{tmp_path}/a")
    products = food.raw.table("Products").withColumn("ProductID", F.col("ProductID") + 1000)
    stability.store_keys(Source(food.spec, food.raw.replacing(Products=products)), f"{tmp_path}/b")
    made = stability.stability(spark, f"{tmp_path}/a", f"{tmp_path}/b").collect()
    by_dimension = {r.Dimension: r for r in made}
    assert by_dimension["DimProduct"].Renamed == by_dimension["DimProduct"].KeysBefore > 0
    assert by_dimension["DimCustomer"].Stable == by_dimension["DimCustomer"].KeysAfter > 0
