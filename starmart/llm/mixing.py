"""Sources mixed to target weights by Poisson replication, with DataFrame functions only.

A document of a source with n of N documents and weight w is wanted
``epochs * N * w / n`` times on average. Its count is that Poisson distribution,
inverted at a uniform number that is a hash of the seed and the document's id and text,
so, once the rates are known, any part of the corpus can be replicated by itself, and
again with the same result.
Copies are dealt out by a second hash and sorted by it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.rows import others, packed

SEED = 20
TEMPERATURE = 0.5
EPOCHS = 1.0
#: Distribution functions of up to so many numbers in all (32 MB) are broadcast; more are joined by a shuffle.
BROADCAST_ENTRIES = 1 << 22
#: Tasks that rows drawn alike are dealt out over.
SALTS = 64


def _hashed(digits: int, *parts: Column) -> Column:
    """The first hexadecimal digits of the MD5 of some text, as a number."""
    text = F.concat_ws(":", *parts).cast("binary")
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def _last(rate: Column) -> Column:
    """Up to where a double tells a Poisson distribution function from 1."""
    return F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")


def _cumulated(rate: Column) -> Column:
    """The Poisson distribution function at 0, 1, 2, ..."""
    last = _last(rate)
    chance = F.exp(-rate)
    start = F.struct((-rate).alias("log"), chance.alias("sum"), F.array(chance).alias("sums"))

    def add(so_far: Column, k: Column) -> Column:
        log = so_far["log"] + F.ln(rate) - F.ln(k.cast("double"))
        total = so_far["sum"] + F.exp(log)
        return F.struct(
            log.alias("log"), total.alias("sum"), F.array_append(so_far["sums"], total).alias("sums")
        )

    summed = F.aggregate(F.sequence(F.lit(1), last), start, add, lambda x: x["sums"])
    return F.when(rate > 0, summed).otherwise(F.array(F.lit(1.0)))


def rates(
    docs: DataFrame, weights: Mapping[str, float] | None = None, temperature: float = TEMPERATURE, epochs: float = EPOCHS
) -> DataFrame:
    """``of_source``, ``n`` and ``rate``, the mean number of copies, of every source.

    ``weights`` are relative; a source that is not named has weight 0. Without them
    a source of n documents weighs n ** temperature.
    """
    sized = docs.groupBy(F.col("source").alias("of_source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("of_source") == name, F.lit(float(value))).otherwise(weight)
    sized = sized.withColumn("weight", weight)
    every = sized.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    scale = float(epochs) * (every["n"] or 0) / every["weight"] if every["weight"] else 0.0
    return sized.select("of_source", "n", (F.lit(scale) * F.col("weight") / F.col("n")).alias("rate"))


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    temperature: float = TEMPERATURE,
    epochs: float = EPOCHS,
    seed: int = SEED,
    marked: bool = True,
) -> DataFrame:
    """The rows of ``docs``, each as often as drawn, with ``copy`` (from 1) and ``shuffle_key``.

    ``docs`` has doc_id, source and text; columns copy and shuffle_key are replaced, all
    others are kept, whatever their names. Not ``marked``, all columns of ``docs`` are
    kept and none is added. Rows are dealt out by shuffle_key, so that every partition
    is a random part of the whole, and are sorted by it within.

    A row is drawn by the seed, its id and its text, a null of either told from any
    value: rows without an id, or with one that others have, are drawn by their texts.
    Only rows equal in both are drawn alike; they are dealt out over SALTS tasks. A null
    source is a source of its own. A very long text is hashed whole. No rows give no rows.
    """
    columns = others(docs.columns, "copy", "shuffle_key") if marked else docs.columns
    rated = rates(docs, weights, temperature, epochs)
    entries = rated.agg(F.sum(_last(F.col("rate")) + 1)).first()[0] or 0
    known = rated.select(
        # An expression Spark does not see through: this side is dealt out anew, so that the
        # rows of a hot source can be split.
        F.concat(F.col("of_source"), F.lit("")).alias("of_source"),
        _cumulated(F.col("rate")).alias("sums"),
    )
    if entries <= BROADCAST_ENTRIES:
        known = F.broadcast(known)
    rows = docs.select(
        packed(columns),
        # Numbered as read, so that a task that is run again deals its rows out as before.
        (F.monotonically_increasing_id() % SALTS).alias("salt"),
        F.col("source").alias("in_source"),
        F.concat_ws(
            ":",
            F.when(F.col("doc_id").isNull(), "null").otherwise("id"),
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null")),
        ).alias("name"),
    )
    uniform = _hashed(13, F.lit(f"count {seed}"), F.col("name")) / F.lit(float(16**13))
    counted = (
        rows.join(known, F.col("in_source").eqNullSafe(F.col("of_source")))
        .withColumn("u", uniform)
        .withColumn("n", F.size(F.filter("sums", lambda x: x <= F.col("u"))))
        .where("n > 0")
    )
    copies = counted.select("row", "salt", "name", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    key = _hashed(15, F.lit(f"order {seed}"), F.col("name"), F.col("copy").cast("string"))
    keyed = copies.select("row", "salt", "copy", key.alias("shuffle_key"))
    dealt = keyed.repartition("shuffle_key", "salt").sortWithinPartitions("shuffle_key", "copy")
    return dealt.select("row.*", "copy", "shuffle_key") if marked else dealt.select("row.*")
