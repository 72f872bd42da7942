"""Whether ids stay what they are from one load of a source to the next.

Every load keeps the canonical ids of its members, each with a digest of what it
stands for, in order of their bucket, and a tree of checksums over the buckets. Two
loads are compared from the root down: under a node that is equal in both nothing
has changed and nothing is read. Only ids in unequal leaves are read and compared,
so the check costs what has changed, not what there is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.operators.dims import customers_of, employees_of, products_of
from starmart.sources.spec import Source, union_all

#: Children of a node of the tree, and levels below the root.
FANOUT = 64
LEVELS = 2
LEAVES = FANOUT**LEVELS

#: What tells one member from another apart from its id.
IDENTITY = {
    "DimCustomer": ("CustomerName", "CompanyName", "Email"),
    "DimEmployee": ("EmployeeName", "Title"),
    "DimProduct": ("ProductName", "CategoryName", "GenreName"),
}
_KEY = {"DimCustomer": "CustomerID", "DimEmployee": "EmployeeID", "DimProduct": "ProductID"}
_BUILD = {"DimCustomer": customers_of, "DimEmployee": employees_of, "DimProduct": products_of}


def _digest(columns: Sequence[str]) -> Column:
    """MD5 of some attributes, NULLs told from empty texts; NULL if there is none at all."""
    return F.when(F.coalesce(*columns).isNotNull(), F.md5(F.to_json(F.struct(*columns)).cast("binary")))


def keys_of(source: Source, identity: Mapping[str, Sequence[str]] = IDENTITY) -> DataFrame:
    """Dimension, KeyValue, Identity and Leaf of every member of a source; equal rows are one."""
    parts = []
    for dimension, build in _BUILD.items():
        members = build(source)
        parts.append(
            members.select(
                F.lit(dimension).alias("Dimension"),
                F.col(_KEY[dimension]).alias("KeyValue"),
                _digest(identity[dimension]).alias("Identity"),
            )
        )
    leaf = F.pmod(F.xxhash64("KeyValue"), F.lit(LEAVES)).cast("int")
    return union_all(parts).distinct().withColumn("Leaf", leaf)


def checksum_tree(keys: DataFrame) -> DataFrame:
    """Dimension, Level, Node, Keys, Checksum: the root is level 0, a node's parent is Node / FANOUT.

    A checksum is the sum of its rows' hashes: it does not depend on their order, and
    that of a node is the sum of its children's.
    """
    row = F.xxhash64("KeyValue", "Identity").cast("decimal(38,0)")
    ids = keys.groupBy("Dimension", "Leaf", "KeyValue").agg(F.sum(row).alias("Checksum"))
    leaves = ids.groupBy("Dimension", "Leaf").agg(F.count(F.lit(1)).alias("Keys"), F.sum("Checksum").alias("Checksum"))
    levels = F.transform(
        F.sequence(F.lit(0), F.lit(LEVELS)),
        lambda k: F.struct(
            k.alias("Level"),
            F.floor(F.col("Leaf") / F.pow(F.lit(FANOUT), F.lit(LEVELS) - k)).cast("int").alias("Node"),
        ),
    )
    nodes = leaves.select("Dimension", F.inline(levels), "Keys", "Checksum")
    return nodes.groupBy("Dimension", "Level", "Node").agg(
        F.sum("Keys").alias("Keys"), F.sum("Checksum").cast("decimal(38,0)").alias("Checksum")
    )


def store_keys(source: Source, path: str) -> None:
    """Keep a load's ids and their tree below ``path``.

    Ids are sorted by leaf: the files' statistics let a reader of some leaves skip
    the rest.
    """
    ordered = keys_of(source).repartitionByRange("Dimension", "Leaf").sortWithinPartitions("Dimension", "Leaf")
    ordered.write.mode("overwrite").parquet(f"{path}/keys")
    stored = source_keys(ordered.sparkSession, path)
    # At most one row per node and dimension.
    checksum_tree(stored).coalesce(1).write.mode("overwrite").parquet(f"{path}/tree")


_KEYS = "Dimension string, KeyValue string, Identity string, Leaf int"
_TREE = "Dimension string, Level int, Node int, Keys bigint, Checksum decimal(38,0)"


def source_keys(spark: SparkSession, path: str | None) -> DataFrame:
    """The ids of a stored load; no rows for no load."""
    return spark.createDataFrame([], _KEYS) if path is None else spark.read.schema(_KEYS).parquet(f"{path}/keys")


def source_tree(spark: SparkSession, path: str | None) -> DataFrame:
    return spark.createDataFrame([], _TREE) if path is None else spark.read.schema(_TREE).parquet(f"{path}/tree")


def unequal_leaves(before: DataFrame, after: DataFrame) -> dict[str, list[int]]:
    """Leaves under which two trees differ, by dimension, found from the root down.

    A level brings at most FANOUT rows per unequal node above it to the driver.
    """
    open_nodes: dict[str, list[int]] = {}
    for level in range(LEVELS + 1):
        under = F.lit(level == 0)
        for dimension, nodes in open_nodes.items():
            parent = F.floor(F.col("Node") / FANOUT)
            under = under | ((F.col("Dimension") == dimension) & parent.isin(nodes))
        both = [
            df.where((F.col("Level") == level) & under).select("Dimension", "Node", "Keys", "Checksum")
            for df in (before, after)
        ]
        found: dict[tuple[str, int], list] = {}
        for df in both:
            for r in df.collect():
                found.setdefault((r.Dimension, r.Node), []).append((r.Keys, r.Checksum))
        open_nodes = {}
        for (dimension, node), sums in sorted(found.items()):
            if len(sums) != 2 or sums[0] != sums[1]:
                open_nodes.setdefault(dimension, []).append(node)
        if not open_nodes:
            break
    return open_nodes


def _in_leaves(keys: DataFrame, leaves: Mapping[str, Sequence[int]]) -> DataFrame:
    chosen = F.lit(False)
    for dimension, nodes in leaves.items():
        chosen = chosen | ((F.col("Dimension") == dimension) & F.col("Leaf").isin(list(nodes)))
    return keys.where(chosen)


def key_changes(spark: SparkSession, before: str | None, after: str | None) -> DataFrame:
    """Dimension, Change, OldKey, NewKey between two stored loads of a source, named by their paths.

    added, gone: the id is in one load only. renamed: what one id stood for is what
    another, new one stands for; only if no other id that went or came stands for
    the same. reassigned: the id is in both and stands for something else, or for a
    different number of things.
    """
    leaves = unequal_leaves(source_tree(spark, before), source_tree(spark, after))
    sides = []
    for path, name in ((before, "Old"), (after, "New")):
        rows = _in_leaves(source_keys(spark, path), leaves)
        sides.append(rows.select("Dimension", "KeyValue", "Identity", F.lit(name).alias("Side")))
    per_key = (
        union_all(sides)
        .groupBy("Dimension", "KeyValue")
        .agg(
            *[
                f(F.when(F.col("Side") == name, value)).alias(f"{name}{label}")
                for name in ("Old", "New")
                for f, value, label in (
                    (F.count, F.lit(1), "Rows"),
                    (F.min, F.col("Identity"), "First"),
                    (F.sum, F.xxhash64("Identity").cast("decimal(38,0)"), "Sum"),
                )
            ]
        )
    )
    old, new = F.col("OldRows") > 0, F.col("NewRows") > 0
    same = (F.col("OldRows") == F.col("NewRows")) & (F.col("OldSum") == F.col("NewSum"))
    change = F.when(~old, "added").when(~new, "gone").when(~same, "reassigned")
    single = F.when(F.col("OldRows") + F.col("NewRows") == 1, F.coalesce("OldFirst", "NewFirst"))
    changed = per_key.select("Dimension", "KeyValue", change.alias("Change"), single.alias("Identity")).where(
        F.col("Change").isNotNull()
    )
    # An identity that one id that went and one that came share makes a pair. Ids without an
    # identity, or that stand for several things, stay by themselves.
    alone = F.col("Identity").isNull() | (F.col("Change") == "reassigned")
    pairing = F.when(alone, F.concat(F.lit("key "), "KeyValue")).otherwise(F.concat(F.lit("identity "), "Identity"))
    went, came = F.col("Change") == "gone", F.col("Change") == "added"
    counted = changed.withColumn("Pairing", pairing)
    pairs = counted.groupBy("Dimension", "Pairing").agg(
        F.count_if(went).alias("Went"),
        F.count_if(came).alias("Came"),
        F.min(F.when(went, F.col("KeyValue"))).alias("OldKey"),
        F.min(F.when(came, F.col("KeyValue"))).alias("NewKey"),
    )
    renamed = pairs.where("Went = 1 AND Came = 1").select(
        "Dimension", "Pairing", F.lit("renamed").alias("Change"), "OldKey", "NewKey"
    )
    # Pairs are among what has changed only; both sides are dealt out by what they stand for.
    rest = counted.join(renamed.select("Dimension", "Pairing"), ["Dimension", "Pairing"], "left_anti").select(
        "Dimension",
        "Change",
        F.when(F.col("Change") != "added", F.col("KeyValue")).alias("OldKey"),
        F.when(F.col("Change") != "gone", F.col("KeyValue")).alias("NewKey"),
    )
    return rest.unionByName(renamed.drop("Pairing"))


def stability(spark: SparkSession, before: str | None, after: str | None) -> DataFrame:
    """Per dimension: ids before and after, how many are as they were, and changes by kind."""
    roots = [
        source_tree(spark, path).where("Level = 0").select("Dimension", F.col("Keys").alias(name))
        for path, name in ((before, "KeysBefore"), (after, "KeysAfter"))
    ]
    kinds = {"added": "Added", "gone": "Gone", "renamed": "Renamed", "reassigned": "Reassigned"}
    counts = key_changes(spark, before, after).groupBy("Dimension").agg(
        *[F.count_if(F.col("Change") == kind).alias(name) for kind, name in kinds.items()]
    )
    numbers = ["KeysBefore", "KeysAfter", *kinds.values()]
    # One row per dimension on each side.
    both = union_all([roots[0].unionByName(roots[1], allowMissingColumns=True)]).unionByName(
        counts, allowMissingColumns=True
    )
    summed = both.groupBy("Dimension").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in numbers])
    stable = F.col("KeysBefore") - F.col("Gone") - F.col("Renamed") - F.col("Reassigned")
    return summed.select("Dimension", *numbers, stable.alias("Stable"))
