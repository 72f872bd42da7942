"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starmart.scratch import discard, gathered, stored

#: Edges that a task takes at least.
EACH = 50_000


def redealt(column: str) -> Column:
    """The same number under an expression Spark does not see through.

    A side that was grouped by its key keeps its partitions in a join on that key,
    and a join can only split a hot key if both sides are dealt out for it. Joining
    on this makes Spark deal the (small) grouped side out once more.
    """
    return F.col(column).bitwiseXOR(F.lit(0).cast("bigint"))


def _jumped(parents: DataFrame, n: int) -> DataFrame:
    """Every node of ``n`` edges with the root of its tree, by doubling the way each pointer goes."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        longer = parents.join(up, "parent", "left").select(
            "node",
            F.coalesce("grand", "parent").alias("parent"),
            (F.col("grand") != F.col("parent")).alias("moved"),
        )
        longer = stored(gathered(longer, n, EACH))
        discard(parents)
        parents = longer
        if parents.where("moved").isEmpty():
            return parents.select("node", "parent")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, of every node of ``edges`` (a, b).

    Each round hangs every node below its smallest neighbour, shortens the trees to
    stars and keeps the edges between stars, until there are none. Nodes are bigint.
    """
    edges = stored(gathered(edges.where("a != b").select("a", "b").distinct(), edges.count(), EACH))
    labels = None
    while n := edges.count():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        parents = (
            both.groupBy("node")
            .agg(F.min("other").alias("least"))
            .select("node", F.least("node", "least").alias("parent"))
        )
        parents = _jumped(stored(gathered(parents, n, EACH)), n)
        root = lambda side: parents.select(
            F.col("node").alias(side), F.col("parent").alias(f"root_{side}")
        )
        rest = (
            edges.join(root("a"), "a")
            .join(root("b"), "b")
            .where("root_a != root_b")
            .select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b"))
            .distinct()
        )
        rest = stored(gathered(rest, n, EACH))
        if labels is None:
            labels = parents.withColumnRenamed("parent", "label")
        else:
            moved = parents.select(F.col("node").alias("label"), "parent")
            labels = stored(
                labels.join(moved, "label", "left").select(
                    "node", F.coalesce("parent", "label").alias("label")
                )
            )
        discard(edges)
        edges = rest
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
