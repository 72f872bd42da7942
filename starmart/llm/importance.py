"""Importance resampling towards a target: documents whose features are the target's are likelier drawn.

A text's features are all runs of 1 to ``n`` words, hashed into buckets. A bucket's
gain is the logarithm of its share of the target over its share of the corpus, a
document's weight the mean gain of its features. The weight plus a Gumbel variate
made from the id is the score, so the highest scores are a draw without replacement
in proportion to exp(weight / 1000).

Texts are taken apart by Arrow kernels, many rows at a time: lower-cased, split,
flattened and dictionary-encoded; a run of words is a pair of the run before and
the next word's index, and only distinct pairs are hashed. Gains are taken by
bucket and summed by document. Python sees distinct words alone.

The corpus is read twice, for counts of buckets (at most ``buckets`` from a task,
and in all) and for scores. Scores are ranked by a sort by range over the drawn
part only, and each task's first rank comes from the counts of the tasks before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.llm.rows import others, packed
from starmart.scratch import stored

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
PERCENT = 10
LEAST_WORDS = 20
#: What no word holds, as Arrow's regular expressions write it.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows taken apart at once.
SLICE = 1024
#: Neighbouring scores counted together while the least drawn one is looked for.
BAND = 1024


def _crc_of(words: pa.Array) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) for w in words.cast(pa.binary()).to_pylist()), np.int64, len(words))


def features(texts: pa.Array, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, and of every feature its text's index, in order, and its bucket."""
    # Lowered, then widened: of a slice that was widened first the kernel takes other rows' bytes.
    lowered = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    lists = pc.split_pattern_regex(lowered, BREAKS)
    words, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.not_equal(words, "")
    coded = words.filter(full).dictionary_encode()
    of = parents.filter(full).to_numpy(zero_copy_only=False).astype(np.int64)
    spelled, index = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.bincount(of, minlength=len(texts))
    run, crcs = index, _crc_of(spelled)
    found, owners = [crcs[run] % buckets], [of]
    tails = [b" " + w for w in spelled.cast(pa.binary()).to_pylist()] if n > 1 else []
    for length in range(2, n + 1):
        # Runs one longer: those whose first and last word are of one text, as (run, next word) pairs.
        whole = of[: len(of) - length + 1] == of[length - 1 :]
        pairs = run[: len(whole)] * len(spelled) + index[length - 1 :]
        distinct, inverse = np.unique(pairs[whole], return_inverse=True)
        before, last = np.divmod(distinct, max(1, len(spelled)))
        crcs = np.fromiter(
            (zlib.crc32(tails[w], int(crcs[r])) for r, w in zip(before, last)), np.int64, len(distinct)
        )
        run = np.zeros(len(whole), dtype=np.int64)
        run[whole] = inverse
        found.append(crcs[inverse] % buckets)
        owners.append(of[: len(whole)][whole])
    if n == 1:
        return counts, of, found[0]
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return counts, owner[order], np.concatenate(found)[order]


def _counter(n: int, buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                _, _, found = features(batch.column(0).slice(start, SLICE), n, buckets)
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return count


def bucket_counts(texts: DataFrame, n: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; a null text has none."""
    counted = texts.select("text").mapInArrow(_counter(n, buckets), "bucket bigint, n bigint")
    total = np.zeros(buckets, dtype=np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        total[r["bucket"]] = r["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log) of each bucket's smoothed share of the target over that of the corpus."""
    k = len(corpus)
    below, above = float(int(target.sum()) + k), float(int(corpus.sum()) + k)
    shares = ((t + 1) * above / ((s + 1) * below) for s, t in zip(corpus.tolist(), target.tolist()))
    return np.array([floor(1000 * log(x)) for x in shares], dtype=np.int64)


def weigh(text: Column, gain: np.ndarray, n: int = LONGEST) -> Column:
    """n_words, n_features and weight (floored mean gain, 0 without features) of a text."""

    @F.arrow_udf("struct<n_words:bigint,n_features:bigint,weight:bigint>")
    def weighed(texts: pa.Array) -> pa.Array:
        columns: list[list[np.ndarray]] = [[], [], []]
        for start in range(0, len(texts), SLICE):
            part = texts.slice(start, SLICE)
            words, of, found = features(part, n, len(gain))
            ends = np.searchsorted(of, np.arange(len(part) + 1))
            sums = np.concatenate([[0], np.cumsum(gain[found])])
            size = np.diff(ends)
            total = sums[ends[1:]] - sums[ends[:-1]]
            for column, made in zip(columns, (words, size, total // np.maximum(size, 1))):
                column.append(made)
        arrays = [pa.array(np.concatenate(c) if c else [], type=pa.int64()) for c in columns]
        return pa.StructArray.from_arrays(arrays, ["n_words", "n_features", "weight"])

    return weighed(text)


def gumbel(key: Column, seed: int = SEED) -> Column:
    """floor(-1000 * ln(-ln(u))) with u in (0, 1) from the key's SHA-256; a null key is the empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def _least_drawn(scores: DataFrame, n: int) -> int:
    """The n-th highest score, from counts of bands of scores and then of the scores in one band.

    Scores lie within some ten thousands: both counts are short lists.
    """

    def walk(counts: dict[int, int], left: int) -> tuple[int, int]:
        for value in sorted(counts, reverse=True):
            if counts[value] >= left:
                return value, left
            left -= counts[value]
        raise ValueError("fewer scores than that")

    band = F.floor(F.col("score") / BAND)
    bands = scores.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n")).collect()
    found, left = walk({r["band"]: r["n"] for r in bands}, n)
    inside = scores.where(band == found).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()
    return walk({r["score"]: r["n"] for r in inside}, left)[0]


def _ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows with ``rank`` from 1 in a global order, with no task that sees them all."""
    numbered = stored(rows.orderBy(*order).withColumn("place", F.monotonically_increasing_id()))
    task = F.shiftright("place", 33)
    counts = numbered.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n"))
    # One row per task of the sort.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(F.col("task").alias("of_task"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    joined = numbered.join(F.broadcast(firsts), task == F.col("of_task"))
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn("rank", F.col("before") + inside + 1).drop("place", "of_task", "before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    n: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    with_text: bool = True,
) -> DataFrame:
    """All rows of ``docs`` with ``n_features``, ``weight``, ``score`` and ``rank``, null where not drawn.

    ``docs`` has doc_id and text, ``target`` text. Of the N rows with at least
    ``least_words`` words, floor(percent * N / 100) are drawn, those of the highest
    scores, ties to the smaller doc_id and a null one last. Other columns are kept,
    with_text=False leaves the text out; columns of the four names are replaced.

    A null text has no words: weight 0, not drawn. A very long text is taken apart
    whole, beside at most SLICE - 1 others. Rows of one id have one Gumbel variate;
    equal rows are ranked side by side, each counts. Without a target all gains are
    those of buckets it does not have. No rows give no rows.
    """
    corpus, wanted = bucket_counts(docs, n, buckets), bucket_counts(target, n, buckets)
    gain = gains(corpus, wanted)
    made = ("n_features", "weight", "score", "rank")
    kept = others(docs.columns, *made) if with_text else others(docs.columns, *made, "text")
    scored = stored(
        docs.select(
            packed(kept),
            F.col("doc_id").alias("id"),
            weigh(F.col("text"), gain, n).alias("w"),
            gumbel(F.col("doc_id"), seed).alias("noise"),
        ).select(
            "row",
            "id",
            F.col("w.n_words") >= least_words,
            "w.n_features",
            "w.weight",
            (F.col("w.weight") + F.col("noise")).alias("score"),
        ).toDF("row", "id", "fits", "n_features", "weight", "score")
    )
    size = scored.where("fits").count() * percent // 100
    columns = ["row.*", "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint").alias("rank")
    if not size:
        return scored.select(*columns, none)
    least = _least_drawn(scored.where("fits"), size)
    high = F.col("fits") & (F.col("score") >= least)
    # The number of the row as last key, so that equal rows can be cut into several ranges.
    drawn = _ranked(
        scored.where(high).withColumn("nth", F.monotonically_increasing_id()),
        F.desc("score"),
        F.asc_nulls_last("id"),
        F.asc("nth"),
    )
    rank = F.when(F.col("rank") <= size, F.col("rank")).alias("rank")
    return drawn.select(*columns, rank).unionByName(scored.where(~high).select(*columns, none))
