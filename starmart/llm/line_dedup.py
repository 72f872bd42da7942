"""Repeated runs of lines, by a suffix array over line ids.

Every document is a sequence of line ids (blank lines left out). A suffix's rank
among all suffixes by their first line is the rank of its line; ranks by the first
2 * k lines come from sorting pairs of ranks (of the suffix, of the one k lines on),
as in prefix doubling. Only suffixes whose first lines occur more than once are kept:
they are the suffixes in intervals of the suffix array whose common prefix is that
long. All levels are tables, and each round is a join, a sort and a join.

A repeated run counts from ``min_words`` words on. Every such run is covered by its
shortest parts with that many words, from each of its lines forwards and back, and
two parts are equal if they are as long and their ranks by the greatest power of two
are equal at their first lines and at that many lines before their ends. So doubling
can stop at ``min_words`` lines: a longer prefix order deletes the same lines.
The first copy, by document and line, stays; lines of later ones go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.components import redealt
from starmart.llm.rows import others, packed
from starmart.scratch import discard, stored

MIN_WORDS = 50
SLICE = 256

_LINES = "doc bigint, text_hash bigint, at int, line binary, ends int, begins int"
_KEY = ["doc", "text_hash", "at"]


def _parts(counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line the last line of the shortest part from it on, and the first of the one up to it.

    -1 where the rest has too few words.
    """
    n = len(counts)
    sums = np.concatenate([[0], np.cumsum(counts)])
    ends = np.searchsorted(sums, sums[:-1] + least, side="left") - 1
    ends = np.where(ends >= n, -1, ends)
    begins = np.searchsorted(sums, sums[1:] - least, side="right") - 1
    return ends, np.where(sums[1:] >= least, begins, -1)


def _lines_of(least: int):
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                part = whole.slice(start, SLICE)
                columns: list[list] = [[] for _ in range(6)]
                docs, hashes = part.column("doc").to_pylist(), part.column("text_hash").to_pylist()
                for doc, text_hash, text in zip(docs, hashes, part.column("text").to_pylist()):
                    lines = [x for x in (text or "").split("\n") if x.strip()]
                    if not lines:
                        continue
                    counts = np.array([max(1, len(x.split())) for x in lines])
                    ends, begins = _parts(counts, least)
                    n = len(lines)
                    # A part found from its end is left out if it is also found from its start.
                    again = (begins >= 0) & (ends[begins] == np.arange(n))
                    columns[0] += [doc] * n
                    columns[1] += [text_hash] * n
                    columns[2] += range(n)
                    columns[3] += [
                        xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in lines
                    ]
                    columns[4] += ends.tolist()
                    columns[5] += np.where(again, -1, begins).tolist()
                types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(columns, types)],
                    ["doc", "text_hash", "at", "line", "ends", "begins"],
                )

    return listed


def _position() -> Column:
    return F.struct(*_KEY)


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with a number ``order`` that grows with them.

    After a sort by range a row's number (task, then place) is in order; it is
    written down at once, as it need not be the same if a task ran again.
    """
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return stored(groups.orderBy(*keys).withColumn("order", F.monotonically_increasing_id()))


def _first_level(lines: DataFrame) -> DataFrame:
    """Suffixes whose first line is repeated, with its rank."""
    names = _repeated(lines, "line")
    level = stored(lines.join(names, "line").drop("line").withColumnRenamed("order", "rank").distinct())
    discard(names)
    return level


def _next_level(level: DataFrame, step: int) -> DataFrame:
    """From ranks by the first ``step`` lines those by twice as many, of suffixes where these are repeated."""
    on = level.select("doc", "text_hash", (F.col("at") - step).alias("at"), F.col("rank").alias("next"))
    pairs = stored(level.join(on, _KEY))
    names = _repeated(pairs, "rank", "next")
    longer = stored(pairs.join(names, ["rank", "next"]).select(*_KEY, F.col("order").alias("rank")))
    discard(pairs, names)
    return longer


def _later_copies(parts: DataFrame, level: DataFrame, step: int) -> DataFrame:
    """Those of some parts, of ``step`` to 2 * step - 1 lines, that have an earlier copy."""
    named = parts.join(level.withColumnRenamed("rank", "head"), _KEY)
    if step > 1:
        last = level.select("doc", "text_hash", F.col("at").alias("last"), F.col("rank").alias("tail"))
        named = named.withColumn("last", F.col("until") - step + 1)
        named = named.join(last, ["doc", "text_hash", "last"])
    else:
        named = named.withColumn("tail", F.col("head"))
    named = stored(named.select(*_KEY, "until", "head", "tail", (F.col("until") - F.col("at")).alias("size")))
    groups = (
        named.groupBy("head", "tail", "size")
        .agg(F.min(_position()).alias("first"), F.max(_position()).alias("last"))
        .where("first != last")
        .select(redealt("head").alias("head"), "tail", "size", "first")
    )
    copies = named.join(groups, ["head", "tail", "size"]).where(_position() > F.col("first"))
    copies = stored(copies.select(*_KEY, "until"))
    discard(named)
    return copies


def repeated_parts(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc``, ``text_hash``, ``at``, ``until``: ranges of lines (blank ones not counted) to delete.

    ``docs`` has doc bigint, text_hash bigint and text string.
    """
    lines = stored(docs.select("doc", "text_hash", "text").mapInArrow(_lines_of(min_words), _LINES))
    level = _first_level(lines)
    discard(lines)
    # A part is repeated only if all its lines are, its first and last among them.
    forwards = level.where("ends >= 0").select(*_KEY, F.col("ends").alias("until"))
    back = level.where("begins >= 0").select(
        "doc", "text_hash", F.col("begins").alias("at"), F.col("at").alias("until")
    )
    parts = stored(forwards.unionAll(back).withColumn("lines", F.col("until") - F.col("at") + 1))
    longest = parts.agg(F.max("lines")).first()[0] or 0
    level = level.select(*_KEY, "rank")
    found, step = parts.select(*_KEY, "until").limit(0), 1
    while step <= longest:
        here = parts.where((F.col("lines") >= step) & (F.col("lines") < 2 * step)).drop("lines")
        found = found.unionAll(_later_copies(here, level, step))
        if 2 * step <= longest:
            level = _next_level(level, step)
        step *= 2
    return found


def _without(text: str | None, ranges) -> tuple[str | None, int, int]:
    """A text without the ranges of its lines, and how many lines it had and lost, blank ones not counted."""
    if text is None:
        return None, 0, 0
    lines = text.split("\n")
    full = np.array([bool(x.strip()) for x in lines])
    place = np.flatnonzero(full)
    if ranges is None or not len(ranges):
        return text, len(place), 0
    edge = np.zeros(len(lines) + 1, dtype=np.int64)
    for r in ranges:
        edge[place[r["at"]]] += 1
        edge[place[r["until"]] + 1] -= 1
    gone = np.cumsum(edge)[:-1] > 0
    kept = "\n".join(x for x, out in zip(lines, gone) if not out)
    return kept, len(place), int((gone & full).sum())


def remove_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` less the later copies of repeated runs, and ``n_lines``, ``n_deleted``.

    ``docs`` has doc_id bigint and text string; columns n_lines and n_deleted (lines
    before and deleted, blank ones not counted) are replaced, others are kept, whatever
    their names. A very long text is taken apart in one task, and its ranges meet in one row.

    The first copy is that of the least (doc_id, text hash, line); a null id counts
    as 0. Copies may overlap: lines that repeat one after another keep their first period. Blank lines
    go only with the lines around them. A line without words other than control
    characters counts as one word. Rows equal in doc_id and text are one document:
    neither is the other's copy, and both get the same text. A null text stays null,
    one that is all copies becomes empty; no row goes. No rows give no rows.
    """
    text_hash = F.xxhash64(F.col("doc_id").isNull(), F.col("text").isNull(), "text")
    doc = F.coalesce("doc_id", F.lit(0)).cast("bigint")
    columns = others(docs.columns, "text", "n_lines", "n_deleted")
    keyed = docs.select(packed(columns), doc.alias("doc"), text_hash.alias("text_hash"), "text")
    parts = repeated_parts(keyed.select("doc", "text_hash", "text"), min_words)
    ranges = parts.groupBy("doc", "text_hash").agg(F.collect_set(F.struct("at", "until")).alias("ranges"))

    @F.pandas_udf("text string, n_lines long, n_deleted long")
    def cut(texts: pd.Series, all_ranges: pd.Series) -> pd.DataFrame:
        rows = [_without(t, r) for t, r in zip(texts, all_ranges)]
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_deleted"])

    done = keyed.join(ranges, ["doc", "text_hash"], "left").withColumn("cut", cut("text", "ranges"))
    return done.select("row.*", "cut.text", "cut.n_lines", "cut.n_deleted")
