"""Benchmark items in documents, by SimHash of item-sized windows.

For an item of n words every window of n words of a document that shares a shingle
with the item gets a SimHash of BITS bits over its shingles, each weighed by how
often it occurs in the window. Items lie in a multi-index: BITS / 8 blocks of 8
bits, and a window asks in every block for the items within RADIUS * 8 // BITS bits
there; by the pigeonhole principle that is every item within RADIUS bits of the
whole fingerprint. Candidates are verified by the exact weighted similarity, the
sum of the lesser weights over the sum of the greater, on five-word shingles.

If all shingles differ from each other, fingerprints at the threshold of 0.75 differ
in 22 of 128 bits on average, with a deviation of 4.3, so RADIUS = 44 leaves out one
in some million windows there, and neighbouring windows are further chances. Where a
shingle repeats, in the item or the window, one shingle can decide many bits, and a
fingerprint says little. Such pairs are not asked for by fingerprint: all items are
taken whose shingles, as often as they stand in the document, could reach the
threshold at all, and of these all windows with enough places that hold one of the
item's shingles. Both bounds are exact, so no such hit is lost. A window without a
shared shingle has similarity 0 and is not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmart.llm import words
from starmart.llm.rows import packed

BITS = 128
RADIUS = 44
THRESHOLD = 0.75
#: Items held by a task at once; larger benchmarks are worked off in parts of about this many.
PART = 20_000
SLICE = 256
#: Places of a document whose windows are worked off at once, and (window, item) pairs held at once.
SPAN, PAIRS = 1 << 14, 1 << 20
#: Counters of bits held at once.
COUNTS = 1 << 21
_BLOCKS = BITS // 8
_ONES = np.array([bin(x).count("1") for x in range(256)], dtype=np.uint8)
#: Whether two values of a block are near enough.
_NEAR = _ONES[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= RADIUS // _BLOCKS


def fingerprints(shingles: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash, as BITS / 8 bytes, of the windows of ``width`` shingles from some places on.

    As many of the bits at once as keep to about COUNTS counters, eight at least.
    """
    both = np.stack([words.mix(shingles), words.mix(shingles ^ np.uint64(0x5851F42D4C957F2D))], axis=1)
    hashed = both.view(np.uint8).reshape(len(shingles), _BLOCKS)
    out = np.empty((len(starts), _BLOCKS), dtype=np.uint8)
    step = min(_BLOCKS, max(1, COUNTS // (8 * len(shingles) + 8)))
    for b in range(0, _BLOCKS, step):
        bits = np.unpackbits(hashed[:, b : b + step], axis=1)
        ones = np.zeros((len(bits) + 1, bits.shape[1]), dtype=np.int32)
        np.cumsum(bits, axis=0, out=ones[1:])
        # A bit is set if more than half of the shingles have it.
        out[:, b : b + step] = np.packbits(2 * (ones[starts + width] - ones[starts]) > width, axis=1)
    return out


@dataclass
class Length:
    """The items of one length in words."""

    words: int
    shingle: int
    ids: list[int] = field(default_factory=list)
    sets: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    prints: list[np.ndarray] = field(default_factory=list)
    near: np.ndarray | None = None
    #: Which items have a shingle twice or more.
    repeats: np.ndarray | None = None
    #: The items' shingles, ascending, with the item and the weight of each.
    entries: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def index(self) -> None:
        """For each block and value of it, the items that are near; for each shingle, its items."""
        every = np.stack(self.prints)
        self.near = np.stack([_NEAR[:, every[:, b]] for b in range(_BLOCKS)])
        self.repeats = np.array([bool((counts > 1).any()) for _, counts in self.sets])
        values = np.concatenate([v for v, _ in self.sets])
        order = np.argsort(values, kind="stable")
        owner = np.repeat(np.arange(len(self.sets)), [len(v) for v, _ in self.sets])
        self.entries = values[order], owner[order], np.concatenate([c for _, c in self.sets])[order]

    def within_reach(self, every: np.ndarray, width: int) -> np.ndarray:
        """Items that some window of ``width`` shingles of a document could match, by their weights in all of it."""
        values, owner, weight = self.entries
        own, counts = np.unique(every, return_counts=True)
        first = np.searchsorted(values, own, side="left")
        sizes = np.searchsorted(values, own, side="right") - first
        at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        common = np.minimum(weight[at], np.repeat(counts, sizes))
        return np.flatnonzero(np.bincount(owner[at], common, len(self.sets)) >= self.least_common(width))

    def least_common(self, width: int) -> float:
        """What a window and an item must share for THRESHOLD; a little less, for rounding."""
        size = self.words - self.shingle + 1
        return THRESHOLD / (1 + THRESHOLD) * (width + size) - 1e-6

    def candidates(self, prints: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, item) within RADIUS bits, by window."""
        own = np.stack(self.prints)
        step = max(1, PAIRS // len(own))
        for first in range(0, len(prints), step):
            part = prints[first : first + step]
            some = self.near[0][part[:, 0]].copy()
            for b in range(1, _BLOCKS):
                some |= self.near[b][part[:, b]]
            window, item = np.nonzero(some)
            near = _ONES[part[window] ^ own[item]].sum(axis=1) <= RADIUS
            yield from zip((first + window[near]).tolist(), item[near].tolist())


@dataclass
class Index:
    """All items of a part by length, and for each shingle the lengths (by position) it occurs in."""

    lengths: list[Length]
    #: By shingle length: the shingles, ascending, and the position in ``lengths`` of each.
    anchors: dict[int, tuple[np.ndarray, np.ndarray]]


def _weighted(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingles, return_counts=True)


def similarity(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the lesser over the sum of the greater weights of two weighted sets."""
    _, a, b = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(one[1][a], two[1][b]).sum())
    return common / (int(one[1].sum()) + int(two[1].sum()) - common)


def build(ids: list[int], texts: list[str | None]) -> Index:
    """Items without words are in no index."""
    lengths: dict[int, Length] = {}
    anchors: dict[int, list[tuple[np.ndarray, int]]] = {}
    for first, hashes, bounds in words.hashed_words(texts):
        for k in range(len(bounds) - 1):
            own = hashes[bounds[k] : bounds[k + 1]]
            n = len(own)
            if not n:
                continue
            here = lengths.setdefault(n, Length(n, min(n, words.SHINGLE)))
            shingles = words.runs(own, here.shingle)
            here.ids.append(ids[first + k])
            here.sets.append(_weighted(shingles))
            here.prints.append(fingerprints(shingles, np.zeros(1, dtype=np.int64), len(shingles))[0])
    listed = sorted(lengths.values(), key=lambda x: x.words)
    for at, here in enumerate(listed):
        here.index()
        every = np.unique(np.concatenate([s for s, _ in here.sets]))
        anchors.setdefault(here.shingle, []).append((every, at))
    joined = {}
    for shingle, parts in anchors.items():
        values = np.concatenate([v for v, _ in parts])
        places = np.repeat([at for _, at in parts], [len(v) for v, _ in parts])
        order = np.argsort(values, kind="stable")
        joined[shingle] = values[order], places[order]
    return Index(listed, joined)


def _touched(index: Index, shingle: int, every: np.ndarray) -> dict[int, np.ndarray]:
    """Places of a document's shingles that occur in items, by position of the items' length."""
    values, places = index.anchors[shingle]
    first = np.searchsorted(values, every, side="left")
    hit = np.flatnonzero(values[np.minimum(first, len(values) - 1)] == every)
    if not len(hit):
        return {}
    last = np.searchsorted(values, every[hit], side="right")
    counts = last - first[hit]
    at = np.repeat(hit, counts)
    entry = np.repeat(first[hit] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    return {int(p): at[places[entry] == p] for p in np.unique(places[entry])}


def _repeating(every: np.ndarray, width: int) -> np.ndarray:
    """For each window of some shingles whether one stands in it twice or more."""
    order = np.argsort(every, kind="stable")
    again = np.flatnonzero(every[order[1:]] == every[order[:-1]])
    before = np.full(len(every), -1, dtype=np.int64)
    before[order[again + 1]] = order[again]
    latest = np.maximum.accumulate(before)
    return latest[width - 1 :] >= np.arange(len(every) - width + 1)


def _exact_pairs(here: Length, every: np.ndarray, width: int, repeating: np.ndarray) -> Iterator[tuple[int, int]]:
    """(window, item) that could match, of those where the window or the item repeats a shingle."""
    if not (repeating.any() or here.repeats.any()):
        return
    for item in here.within_reach(every, width).tolist():
        values = here.sets[item][0]
        place = np.minimum(np.searchsorted(values, every), len(values) - 1)
        held = np.concatenate([[0], np.cumsum(values[place] == every)])
        enough = held[width:] - held[:-width] >= here.least_common(width)
        if not here.repeats[item]:
            enough &= repeating
        for start in np.flatnonzero(enough).tolist():
            yield start, item


def matches(index: Index, hashes: np.ndarray) -> list[tuple[int, float, int, int]]:
    """(item, similarity, first word, windows) of the items found in a document.

    A document that is shorter than an item is one window.
    """
    found = []
    for shingle in index.anchors:
        every = words.runs(hashes, shingle)
        for at, hits in _touched(index, shingle, every).items() if len(every) else ():
            here = index.lengths[at]
            width = min(here.words - shingle + 1, len(every))
            # The windows that hold a hit: those that start up to width - 1 before one.
            edge = np.zeros(len(every) + 1, dtype=np.int64)
            np.add.at(edge, np.maximum(hits - width + 1, 0), 1)
            np.add.at(edge, hits + 1, -1)
            starts = np.flatnonzero(np.cumsum(edge)[: len(every) - width + 1])
            if not len(starts):
                continue
            best: dict[int, list] = {}

            def judge(start: int, item: int) -> None:
                value = similarity(_weighted(every[start : start + width]), here.sets[item])
                if value >= THRESHOLD:
                    known = best.setdefault(here.ids[item], [value, start, 0])
                    known[2] += 1
                    if (value, -start) > (known[0], -known[1]):
                        known[:2] = value, start

            repeating = _repeating(every, width)
            for start, item in _exact_pairs(here, every, width, repeating):
                judge(start, item)
            starts = starts[~repeating[starts]]
            for some in np.split(starts, np.flatnonzero(np.diff(starts // SPAN)) + 1):
                if not len(some):
                    continue
                low = some[0]
                prints = fingerprints(every[low : some[-1] + width], some - low, width)
                for window, item in here.candidates(prints):
                    if not here.repeats[item]:
                        judge(int(some[window]), item)
            found += [(item, *values) for item, values in best.items()]
    return found


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``similarity`` of the best window, its ``first_word``, and ``windows``.

    ``docs`` has doc_id bigint and text string, ``benchmark`` item_id bigint and text
    string; other columns are not read. One row per row of ``docs`` and item with a
    window at THRESHOLD or above; of equally good windows the first counts.

    Null texts and texts without words match nothing. Of a very long text all windows
    are looked at, SPAN places at once, in one task. An item of fewer than five
    words is one shingle. Items that share an id are one item. Ids may be null. A
    benchmark of any size is split into parts of about PART items, and only one part
    at a time is sent to the tasks.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    parts = max(1, -(-items.count() // PART))
    of_part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    schema = "doc_id bigint, item_id bigint, similarity double, first_word bigint, windows bigint"

    def part(number: int) -> DataFrame:
        # About PART items, whatever the benchmark's size.
        rows = items.where(of_part == number).distinct().toArrow()
        index = build(rows.column("item_id").to_pylist(), rows.column("text").to_pylist())
        shared = spark.sparkContext.broadcast(index)

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, SLICE):
                    batch = whole.slice(at, SLICE)
                    ids, texts = (batch.column(c).to_pylist() for c in ("doc_id", "text"))
                    rows = []
                    for first, hashes, bounds in words.hashed_words(texts):
                        for k in range(len(bounds) - 1):
                            own = matches(shared.value, hashes[bounds[k] : bounds[k + 1]])
                            rows += [(ids[first + k], *x) for x in own]
                    columns = list(zip(*rows)) if rows else [[]] * 5
                    types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=t) for c, t in zip(columns, types)],
                        ["doc_id", "item_id", "similarity", "first_word", "windows"],
                    )

        return docs.select("doc_id", "text").mapInArrow(found, schema)

    out = part(0)
    for number in range(1, parts):
        out = out.unionAll(part(number))
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no item; the columns are those of ``docs``.

    A row is left out by its own text: rows that share its id, or have none, are
    judged by theirs. Columns may have any names.
    """
    text_hash = F.xxhash64(docs["text"].isNull(), docs["text"]).alias("text_hash")
    keyed = docs.select(text_hash.alias("doc_id"), "text")
    bad = contaminations(keyed, benchmark).select(F.col("doc_id").alias("text_hash")).distinct()
    rows = docs.select(packed(docs.columns), text_hash)
    return rows.join(bad, "text_hash", "left_anti").select("row.*")
