"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``virtual`` points on a ring of CELLS cells; a row belongs to the
first point at or after the cell of its key. A shard takes no more rows than its
share, which is the mean, rounded up for as many of the first shards as it takes
to hold all rows; what does not fit goes on clockwise to the next point whose
shard has room. So counts are at most one apart, and only what overflows moves.

Only counts per cell go through the driver, CELLS at most. The walk over the ring
turns them into intervals of ranks (within a cell) with a shard and a first slot,
and these are broadcast: at most CELLS plus one per filled shard and cell.

Rows of a cell are ranked in PARTS parts by a hash of the whole row, each from the
number of rows in the parts before it, so a key that a third of all rows share is
ranked by many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.llm.rows import named, others, packed
from starmart.scratch import stored

CELLS = 1 << 14
VIRTUAL = 128
#: Parts that the rows of a cell are ranked in.
PARTS = 64
#: Repetitions of a row written out at once.
STEP = 4096


def cell(key: Column) -> Column:
    """The key's cell, from the first hexadecimal digits of its MD5; a null is the empty key."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % CELLS


def ring(shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """(cell, shard) of every point, by cell; a shard's points do not depend on how many shards there are."""
    points = []
    for shard in range(shards):
        for k in range(virtual):
            digest = hashlib.md5(f"shard {shard} point {k}".encode()).hexdigest()
            points.append((int(digest[:8], 16) % CELLS, shard))
    return sorted(points)


def walk(counts: dict[int, int], shards: int, virtual: int = VIRTUAL) -> Iterator[tuple[int, int, int, int, int]]:
    """(cell, first rank, end rank, shard, first slot) for counts of rows by cell.

    First every cell fills its own shard, clockwise from cell 0; then what is left
    over goes on, in the same order.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    slots = [0] * shards
    points = ring(shards, virtual)

    def take(at: int, rank: int, end: int, shard: int):
        n = min(end - rank, room[shard])
        room[shard] -= n
        slots[shard] += n
        return (at, rank, rank + n, shard, slots[shard] - n), rank + n

    left, k = [], 0
    for at in sorted(counts):
        while k < len(points) and points[k][0] < at:
            k += 1
        own = k % len(points)
        placed, rank = take(at, 0, counts[at], points[own][1])
        if rank:
            yield placed
        if rank < counts[at]:
            left.append((at, rank, counts[at], own))
    for at, rank, end, own in left:
        step = own
        while rank < end:
            step = (step + 1) % len(points)
            if room[points[step][1]]:
                placed, rank = take(at, rank, end, points[step][1])
                yield placed


def shard_rows(docs: DataFrame, shards: int, key: str = "doc_id", virtual: int = VIRTUAL) -> DataFrame:
    """The rows of ``docs`` with ``shard`` (from 0) and ``slot``, gapless from 0 within a shard.

    Columns of those names are replaced, all others kept, whatever their names and
    types. Rows equal in all columns are counted before they are dealt out and written
    out again after, STEP at a time: a row that repeats a billion times is one row on
    the way, and no array is longer than what it repeats divided by STEP. Maps are
    compared by their entries in order, so equal maps in another order are two rows,
    each with its own place. A null key is the empty key. A very long text is hashed
    whole. No rows give no rows.
    """
    columns = others(docs.columns, "shard", "slot")
    kinds = dict(docs.dtypes)
    maps = [c for c in columns if "map<" in kinds[c]]
    plain = [c for c in columns if c not in maps]
    # Maps can't be compared or hashed: their text stands for them.
    entries = F.to_json(packed(maps)) if maps else F.lit(None).cast("string")
    carried = packed(maps).alias("maps") if maps else F.lit(None).cast("string").alias("maps")
    rows = docs.select(
        packed(plain), entries.alias("entries"), carried, named(key).alias("key"), cell(named(key)).alias("cell")
    )
    hashed = F.xxhash64("row", "entries")
    celled = rows.withColumn("part", F.pmod(hashed, F.lit(PARTS)).cast("int"))
    parts = stored(celled.groupBy("cell", "part").agg(F.count(F.lit(1)).alias("n")))
    counts = parts.groupBy("cell").agg(F.sum("n").alias("n")).collect()
    placed = list(walk({r["cell"]: r["n"] for r in counts}, shards, virtual))
    fields = ["of", "start", "end", "shard", "first"]
    plan = docs.sparkSession.createDataFrame(
        pd.DataFrame(placed, columns=fields).astype("int64"), ", ".join(f"{name} bigint" for name in fields)
    )
    earlier = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("cell", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # Rows that differ in any column differ in the second hash, but for chance: then any order will do.
    order = Window.partitionBy("cell", "part").orderBy("key", hashed)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.count(F.lit(1)).alias("n"), *([F.first("maps").alias("maps")] if maps else [])]
    grouped = celled.groupBy("cell", "part", "key", "row", "entries").agg(*sums)
    within = grouped.withColumn("within", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # The window has dealt the rows out by cell and part: this join shuffles only the offsets.
    ranked = within.join(offsets, ["cell", "part"]).withColumn("rank", F.col("before") + F.col("within"))
    meets = (F.col("cell") == F.col("of")) & (F.col("rank") < F.col("end")) & (F.col("rank") + F.col("n") > F.col("start"))
    low = F.greatest("rank", "start") - F.col("start")
    high = F.least(F.col("rank") + F.col("n"), F.col("end")) - 1 - F.col("start")
    # The plan has at most CELLS rows and one for each point a filled cell goes on to.
    out = (
        ranked.join(F.broadcast(plan), meets)
        .withColumns({"low": low, "high": high})
        .withColumn("low", F.explode(F.sequence("low", "high", F.lit(STEP).cast("bigint"))))
        .withColumn("at", F.explode(F.sequence("low", F.least(F.col("low") + STEP - 1, F.col("high")))))
    )
    back = [F.col("maps" if c in maps else "row").getField(c).alias(c) for c in columns]
    return out.select(*back, F.col("shard").cast("int").alias("shard"), (F.col("first") + F.col("at")).alias("slot"))
