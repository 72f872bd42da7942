"""How corpus filters interact: what each removes at every step of every order of them.

A row is the set of filters it fails, a mask. Orders are numbered by their Lehmer
rank, so the orders that begin alike are an interval of ranks. A row goes at the
first filter of an order that it fails: at step k in just those intervals whose
first k - 1 filters it passes and whose k-th it fails. So the rows are counted by
part and mask, each count is added at the beginning of its intervals and taken off
at their ends, and a running sum over the ranks gives what every order removes.

Nothing is evaluated per order: the rows are read once, and what comes after has at
most 2**n masks a part. Tables over orders depend on the number of filters alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from starmart.scratch import discard, stored

#: More would make tables of over 5,040 orders.
MOST_FILTERS = 7


def lehmer(prefix: Sequence[int], n: int) -> int:
    """The least rank, among the permutations of 0 to n-1 in order, of those that begin so."""
    left, rank = list(range(n)), 0
    for k, x in enumerate(prefix):
        rank += left.index(x) * factorial(n - 1 - k)
        left.remove(x)
    return rank


def intervals(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, end rank): the orders in which rows of that mask go at that step."""
    out = []
    for step in range(1, n + 1):
        for prefix in permutations(range(n), step):
            *passed, failed = prefix
            free = [x for x in range(n) if x not in prefix]
            first = lehmer(prefix, n)
            for size in range(len(free) + 1):
                for more in combinations(free, size):
                    mask = sum(1 << x for x in (failed, *more))
                    out.append((mask, step, first, first + factorial(n - step)))
    return out


def _orders(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """rank, step, place (number of the filter there) and the whole order as text."""
    rows = [
        (rank, step, place, "".join(names[x] for x in order))
        for rank, order in enumerate(permutations(range(len(names))))
        for step, place in enumerate(order, 1)
    ]
    return spark.createDataFrame(rows, "rank int, step int, place int, filter_order string")


def audit(
    rows: DataFrame,
    part: Column,
    fails: Mapping[str, Column],
    tallies: Mapping[str, Column] | None = None,
    times: Column | None = None,
) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    ``fails`` has for each filter whether a row fails it, ``tallies`` conditions that
    are also counted among the rows removed; a null condition is false. ``times`` is
    how many rows a row stands for, one by default. The names of the filters are
    joined to ``filter_order``. ``step`` counts from 1. Counts of rows within the part: ``kept`` after the step,
    ``removed`` at it, ``redundant`` (failing its filter, gone before),
    ``unique_fails`` (failing its filter only), ``<tally>_lost`` (of the removed),
    ``shapley`` (removed by its filter, summed over all orders and steps).

    A null part is the empty string's. Repeated rows count as often as they stand
    there. No rows give no rows. Columns of ``rows`` never meet names used here.
    """
    tallies = dict(tallies or {})
    names, n = list(fails), len(fails)
    if not 0 < n <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters, not {n}")
    yes = [F.coalesce(x, F.lit(False)).cast("int") for x in fails.values()]
    mask = sum((x * (1 << k) for k, x in enumerate(yes)), F.lit(0))
    times = F.lit(1) if times is None else times
    counts = [f"tally_{k}" for k in range(len(tallies))]
    sums = ["n", *counts]
    masks = stored(
        rows.select(
            F.coalesce(part, F.lit("")).alias("part"),
            mask.alias("mask"),
            times.cast("bigint").alias("n"),
            *[F.when(x, times).otherwise(0).cast("bigint").alias(k) for k, x in zip(counts, tallies.values())],
        )
        .groupBy("part", "mask")
        .agg(*[F.sum(k).alias(k) for k in sums])
    )
    spark = rows.sparkSession
    # Both tables have a row per order and step, or fewer: bounded by the number of filters.
    covers = F.broadcast(spark.createDataFrame(intervals(n), "mask int, step int, first int, end int"))
    orders = F.broadcast(_orders(spark, names))
    edges = masks.join(covers, "mask").select(
        "part",
        "step",
        F.inline(
            F.array(
                F.struct(F.col("first").alias("rank"), *sums),
                F.struct(F.col("end").alias("rank"), *[(-F.col(k)).alias(k) for k in sums]),
            )
        ),
    )
    spine = masks.select("part").distinct().crossJoin(orders.select("step", "rank"))
    zeros = spine.select("part", "step", "rank", *[F.lit(0).cast("bigint").alias(k) for k in sums])
    deltas = (
        edges.where(F.col("rank") < factorial(n))
        .unionByName(zeros)
        .groupBy("part", "step", "rank")
        .agg(*[F.sum(k).alias(k) for k in sums])
    )
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    gone = deltas.select("part", "step", "rank", *[F.sum(k).over(along).alias(k) for k in sums])
    bit = F.call_function("shiftleft", F.lit(1), F.col("place"))
    alone = (
        masks.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        .groupBy("part", "place")
        .agg(
            F.sum("n").alias("all_rows"),
            F.sum(F.when(F.col("mask").bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias("failing"),
            F.sum(F.when(F.col("mask") == bit, F.col("n")).otherwise(0)).alias("unique_fails"),
        )
    )
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return (
        gone.join(orders, ["rank", "step"])
        .join(alone, ["part", "place"])
        .select(
            "part",
            "filter_order",
            "step",
            (F.col("all_rows") - F.sum("n").over(so_far)).alias("kept"),
            F.col("n").alias("removed"),
            (F.col("failing") - F.col("n")).alias("redundant"),
            "unique_fails",
            *[F.col(k).alias(f"{name}_lost") for k, name in zip(counts, tallies)],
            F.sum("n").over(Window.partitionBy("part", "place")).alias("shapley"),
        )
    )


# Fixed values of the query's filters.
LEAST_WORDS = 100
LEAST_DISTINCT = 80
MOST_CAPITALS = 10
BREAKS = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = r"[#$%&*|]"


def text_failures(text: Column) -> dict[str, Column]:
    """Filters A to D on one text: few words, few distinct words, capitals, marks."""
    words = F.filter(F.split(text, BREAKS), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * capitals > MOST_CAPITALS * F.length(text),
        "D": text.rlike(MARKS),
    }


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E by lang, with tallies good and toxic.

    ``docs`` has doc_id, text and lang, ``labels`` doc_id, quality and toxic. A null
    text is the empty one. E: some smaller doc_id has the same text; texts are told
    apart by SHA-256. A null doc_id is neither smaller nor greater than another, and
    has no label. A document is good (toxic) if any label of its id is 1. Very long
    texts are split into words within one task, row by row. Equal rows count each;
    neither is the other's copy. Other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    tests = text_failures(text)
    digests = stored(
        docs.select(
            "doc_id",
            F.coalesce("lang", F.lit("")).alias("lang"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
            *[x.alias(k) for k, x in tests.items()],
        )
    )
    first = (
        digests.groupBy("digest")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most")
        # An expression Spark does not see through: this side is dealt out anew, so that
        # the other one's rows of a text that very many share can be split.
        .select(F.concat("digest", F.lit(b"")).alias("digest"), "least")
    )
    # Summed by id before the labels are met, so an id that many rows share is a few rows.
    failed = (
        digests.join(first, "digest", "left")
        .withColumn("E", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)))
        .groupBy("doc_id", "lang", *tests, "E")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    marked = (
        labels.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max((F.col("quality") == 1)).alias("good"), F.max((F.col("toxic") == 1)).alias("toxic"))
    )
    counted = failed.join(marked, "doc_id", "left")
    fails = {k: F.col(k) for k in (*tests, "E")}
    tallies = {k: F.col(k) for k in ("good", "toxic")}
    out = audit(counted, F.col("lang"), fails, tallies, F.col("times"))
    discard(digests)
    return out
