"""Repeated byte strings removed from a corpus, by suffix arrays of shards.

Every byte goes that lies in a string of ``least`` bytes which also starts
elsewhere, in the same text or another. So all that matters of a position is
whether its window, the ``least`` bytes from it on, is some other position's too.

Anchors. The hash of each run of ``gram`` bytes is a fixed number, and a window's
anchor is the run with the least one in it, the leftmost of equals. Equal windows
have equal anchors in the same place, so all copies of a window meet under their
anchor's hash. Neighbouring windows share an anchor and travel together as one
segment. An anchor whose hash stands in one place only has no repeated window and
is dropped before any text moves.

Shards. Different segments are dealt out by anchor hash, and equal ones are counted
before. A task takes whole anchors up to BLOCK bytes, joins their segments to one
string, builds its suffix array by induced sorting and carries the common prefixes
along each segment: a window is repeated if its suffix shares ``least`` bytes with
the one before or after it, or if its segment stands for several.

An anchor with more than ``most`` different segments is no shard's: its windows are
told apart by 128-bit hashes, in a grouping that Spark spreads and sums ahead.

Texts are told apart by 64-bit hashes, segments by MD5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.components import redealt
from starmart.llm.rows import others, packed
from starmart.llm.suffix_array import repeated_windows, suffix_array
from starmart.llm.words import mix
from starmart.scratch import discard, stored

LEAST = 200
#: Different segments of one anchor that go into one shard.
MOST = 8192
#: Bytes of segments in one suffix array, or one anchor's if those are more.
BLOCK = 1 << 19
#: Bytes of texts hashed at once: the arrays of a piece fit into a cache.
PIECE = 1 << 17
#: Bytes of segments that a task of the shards takes, about.
TASK = 8 << 20
#: Bytes of segments handed on at once.
ROWS = 1 << 20

_PLACE = np.uint64((1 << 24) - 1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64))
_SPAN = "struct<from:int,until:int>"


def gram_of(least: int) -> int:
    """Bytes of an anchor: the greatest power of two that is at most a third of a window."""
    return 1 << max(0, (least // 3).bit_length() - 1)


def _anchors(data: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each run of bytes, and the place of each window's anchor."""
    gram = gram_of(least)
    hashes = _BYTES[data]
    step = 1
    while step < gram:
        hashes = hashes[:-step] * _FACTOR + hashes[step:]
        hashes ^= hashes >> np.uint64(32)
        step *= 2
    hashes = mix(hashes)
    # The leading bits with the place below: the least one is the leftmost of the least hashes.
    low = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    width, span = least - gram + 1, 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: span - width], low[width - span :])
    return hashes, (low & _PLACE).astype(np.int64)


def _pieces(texts: list[bytes], least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of some texts side by side, with the first window, windows and offset of each, and its index.

    A text longer than a piece comes in several, which overlap by less than a window.
    """
    data, rows = [], []
    filled = 0
    for k, text in enumerate(texts):
        for offset in range(0, len(text) - least + 1, PIECE):
            part = text[offset : offset + PIECE + least - 1]
            data.append(part)
            rows.append((filled, len(part) - least + 1, offset, k))
            filled += len(part)
            if filled >= PIECE:
                yield np.frombuffer(b"".join(data), np.uint8), *np.array(rows).T
                data, rows, filled = [], [], 0
    if rows:
        yield np.frombuffer(b"".join(data), np.uint8), *np.array(rows).T


def _binary(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _anchored(least: int):
    """(key, text_key, spot) of each anchor with windows; spot packs the first window's place and their number."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a text that stands several times in a task is looked at once
        for batch in batches:
            keys, texts, new = batch.column("text_key").to_pylist(), batch.column("text"), []
            for k, key in enumerate(keys):
                if key not in seen:
                    seen.add(key)
                    new.append(k)
            keys = np.array([keys[k] for k in new], dtype=np.int64)
            for data, firsts, windows, offsets, owner in _pieces(_binary(texts.take(pa.array(new, pa.int64()))), least):
                hashes, anchor = _anchors(data, least)
                inside = np.zeros(len(data) + 1, dtype=np.int64)
                np.add.at(inside, firsts, 1)
                np.add.at(inside, firsts + windows, -1)
                places = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
                anchor = anchor[places]
                edge = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
                count = np.diff(np.concatenate([edge, [len(anchor)]]))
                at = np.searchsorted(firsts, places[edge], side="right") - 1
                spot = (places[edge] - firsts[at] + offsets[at]) << 16 | count
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[anchor[edge]].view(np.int64)), pa.array(keys[owner[at]]), pa.array(spot)],
                    ["key", "text_key", "spot"],
                )

    return found


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _segmented(least: int):
    """(text_key, places, key, segment) of anchors given as lists by text; equal segments of a text are one row."""

    fields = [("text_key", pa.int64()), ("places", pa.list_(pa.int32())), ("key", pa.int64()), ("segment", pa.binary())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        rows: list[tuple[int, list[int], int, bytes]] = []
        filled = 0
        for batch in batches:
            ids = batch.column("text_key").to_pylist()
            texts, lists = batch.column("text").cast(pa.binary()), batch.column("anchors")
            for k, text_key in enumerate(ids):
                if text_key in seen:
                    continue
                seen.add(text_key)
                text, anchors = texts[k].as_py(), lists[k].values
                spots, first = np.unique(anchors.field("spot").to_numpy(), return_index=True)
                keys = anchors.field("key").to_numpy()[first]
                places: dict[tuple[int, bytes], list[int]] = {}
                for key, spot in zip(keys.tolist(), spots.tolist()):
                    at, count = spot >> 16, spot & 0xFFFF
                    places.setdefault((key, text[at : at + count + least - 1]), []).append(at)
                rows += [(text_key, at, key, segment) for (key, segment), at in places.items()]
                filled += sum(len(segment) for _, segment in places)
                if filled >= ROWS:
                    yield _batch(rows, fields)
                    rows, filled = [], 0
        yield _batch(rows, fields)

    return cut


def _spans(flags: np.ndarray, least: int) -> list[dict[str, int]]:
    """Ranges of bytes of the windows that are set."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [{"from": int(a), "until": int(b) + least - 1} for a, b in zip(edges[::2], edges[1::2])]


def shard_windows(segments: list[bytes], least: int) -> list[np.ndarray]:
    """Which windows of some segments stand in them more than once.

    The segments are one string, each with an end mark that is below all bytes.
    """
    sizes = np.array([len(x) for x in segments])
    starts = np.cumsum(sizes + 1) - sizes - 1
    joined = np.zeros(len(segments) + int(sizes.sum()) + 1, dtype=np.int32)
    body = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    joined[:-1] = body.astype(np.int32) + 2
    joined[starts + sizes] = 1
    windows = sizes - least + 1
    flags = repeated_windows(joined, suffix_array(joined, 258), starts, windows, least)
    return [flags[a : a + n] for a, n in zip(starts.tolist(), windows.tolist())]


def _sharded(least: int, block: int):
    """(segment's digest, spans) from rows sorted by key: suffix arrays of whole keys, some at a time."""

    span = pa.struct([("from", pa.int32()), ("until", pa.int32())])
    fields = [("digest", pa.binary()), ("spans", pa.list_(span))]

    def judged(waiting: list[tuple[bytes, bytes, int]], alone: list[tuple[bytes, bytes, int]]) -> pa.RecordBatch:
        rows = [(digest, [{"from": 0, "until": len(segment)}]) for digest, segment, n in alone if n > 1]
        if waiting:
            for (digest, segment, n), flags in zip(waiting, shard_windows([x[1] for x in waiting], least)):
                if n > 1:
                    flags = np.ones(len(flags), dtype=bool)
                if flags.any():
                    rows.append((digest, _spans(flags, least)))
        return _batch(rows, fields)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[bytes, bytes, int]] = []
        alone: list[tuple[bytes, bytes, int]] = []
        own: list[tuple[bytes, bytes, int]] = []
        filled, last = 0, None

        def close() -> int:
            """The rows of one key are complete; a single segment needs no order."""
            (alone if len(own) == 1 else waiting).extend(own)
            size = sum(len(x[1]) for x in own) if len(own) > 1 else 0
            own.clear()
            return size

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "digest", "segment", "n")]
            for key, digest, segment, n in zip(*columns):
                if key != last:
                    filled += close()
                    last = key
                    if filled >= block or len(alone) >= 4096:
                        yield judged(waiting, alone)
                        waiting, alone, filled = [], [], 0
                own.append((digest, segment, n))
        close()
        yield judged(waiting, alone)

    return shards


def _listed(least: int):
    """(digest, place, window's hash, n) of every window of some segments."""

    fields = [("digest", pa.binary()), ("place", pa.int32()), ("window", pa.binary()), ("n", pa.int64())]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                columns = [part.column(c).to_pylist() for c in ("digest", "segment", "n")]
                rows = [
                    (digest, k, xxhash.xxh3_128_digest(segment[k : k + least]), n)
                    for digest, segment, n in zip(*columns)
                    for k in range(len(segment) - least + 1)
                ]
                yield _batch(rows, fields)

    return windows


def _crowded_spans(segments: DataFrame, least: int) -> DataFrame:
    """digest and spans, for anchors with too many segments for one task: their windows are counted one by one."""
    windows = segments.select("digest", "segment", "n").mapInArrow(
        _listed(least), "digest binary, place int, window binary, n bigint"
    )
    counted = windows.groupBy("window").agg(F.sum("n").alias("times")).where("times > 1")
    found = windows.join(counted.select(F.concat("window", F.lit(b"")).alias("window")), "window", "left_semi")
    span = F.struct(F.col("place").alias("from"), (F.col("place") + least).alias("until"))
    return found.groupBy("digest").agg(F.collect_list(span).alias("spans"))


def repeated_spans(texts: DataFrame, least: int = LEAST, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """``text_key`` and ``spans`` (ranges of bytes, may overlap) of texts that hold repeated strings.

    ``texts`` has text_key bigint, equal for equal texts, and text binary, and as many
    rows as there are documents.
    """
    anchors = texts.mapInArrow(_anchored(least), "key bigint, text_key bigint, spot bigint")
    # A key is of use if its rows differ; a key that very many rows share is one row per task here.
    ends = [f(c).alias(f"{c}_{name}") for c in ("text_key", "spot") for name, f in (("least", F.min), ("most", F.max))]
    keys = (
        anchors.groupBy("key")
        .agg(*ends)
        .where("text_key_least != text_key_most OR spot_least != spot_most")
        .select(redealt("key").alias("key"))
    )
    shared = anchors.join(keys, "key", "left_semi")
    lists = shared.groupBy("text_key").agg(F.collect_list(F.struct("key", "spot")).alias("anchors"))
    held = texts.join(lists.select(redealt("text_key").alias("text_key"), "anchors"), "text_key")
    cut = stored(held.mapInArrow(_segmented(least), "text_key bigint, places array<int>, key bigint, segment binary"))
    digest = F.unhex(F.md5("segment")).alias("digest")
    different = stored(
        cut.groupBy("key", "segment").agg(F.sum(F.size("places")).cast("bigint").alias("n")).select("key", "segment", "n", digest)
    )
    crowded = different.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > most).select("key")
    crowded = stored(crowded)
    size = different.agg(F.sum(F.length("segment"))).first()[0] or 0
    tasks = max(texts.sparkSession.sparkContext.defaultParallelism, size // TASK)
    fitting = different.join(crowded, "key", "left_anti").repartition(tasks, "key").sortWithinPartitions("key")
    made = fitting.mapInArrow(_sharded(least, block), f"digest binary, spans array<{_SPAN}>")
    made = made.unionByName(_crowded_spans(different.join(crowded, "key", "left_semi"), least))
    made = stored(made)
    discard(different, crowded)
    places = cut.select("text_key", "places", digest).join(made, "digest")
    moved = places.select("text_key", "spans", F.explode("places").alias("at")).select(
        "text_key", "at", F.explode("spans").alias("span")
    )
    span = F.struct((F.col("at") + F.col("span.from")).alias("from"), (F.col("at") + F.col("span.until")).alias("until"))
    # A text that stands several times is a copy from end to end.
    whole = (
        texts.where(F.length("text") >= least)
        .groupBy("text_key")
        .agg(F.count(F.lit(1)).alias("rows"), F.max(F.length("text")).alias("size"))
        .where("rows > 1")
        .select("text_key", F.array(F.struct(F.lit(0).alias("from"), F.col("size").alias("until"))).alias("spans"))
    )
    parts = moved.groupBy("text_key").agg(F.collect_list(span).alias("spans"))
    return stored(parts.unionByName(whole).groupBy("text_key").agg(F.flatten(F.collect_list("spans")).alias("spans")))


def cut_out(text: Column, spans: Column) -> Column:
    """kept (binary), n_bytes, n_removed and n_spans (runs) of a binary text without some ranges of it."""

    @F.arrow_udf("struct<kept:binary,n_bytes:bigint,n_removed:bigint,n_spans:bigint>")
    def cut(texts: pa.Array, lists: pa.Array) -> pa.Array:
        kept, counts = [], []
        for text, ranges in zip(texts, lists):
            text = text.as_py()
            if not ranges.is_valid or not len(ranges.values):
                kept.append(text)
                counts.append((len(text), 0, 0))
                continue
            fields = ranges.values
            starts, ends = fields.field("from").to_numpy(), fields.field("until").to_numpy()
            order = np.argsort(starts, kind="stable")
            starts, ends = starts[order], np.maximum.accumulate(ends[order])
            # A run begins where all ranges before have ended before.
            first = np.concatenate([[True], starts[1:] > ends[:-1]])
            begin, end = starts[first], ends[np.concatenate([first[1:], [True]])]
            inside = [text[a:b] for a, b in zip(np.concatenate([[0], end]), np.concatenate([begin, [len(text)]]))]
            kept.append(b"".join(inside))
            counts.append((len(text), int((end - begin).sum()), len(begin)))
        columns = [pa.array(c, pa.int64()) for c in zip(*counts)] or [pa.array([], pa.int64())] * 3
        return pa.StructArray.from_arrays(
            [pa.array(kept, pa.binary()), *columns], ["kept", "n_bytes", "n_removed", "n_spans"]
        )

    return cut(text, spans)


def remove_repeated_bytes(docs: DataFrame, least: int = LEAST, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """``docs`` with ``kept`` (binary: the text's UTF-8 bytes that stay), ``n_bytes``, ``n_removed``, ``n_spans``.

    ``docs`` has a string ``text``; columns of the four names are replaced, all
    others, the text too, are kept. Every copy of a repeated string goes, the first
    one too, also where copies overlap; what is repeated is judged on the input. A
    null text is the empty one. Rows equal in text are copies of each other, equal
    rows included: with ``least`` bytes or more nothing of them stays. Texts of fewer
    bytes are never touched. A very long text is hashed in pieces; its ranges meet in
    one row, at most one per byte, and it is cut in one task. No rows give no rows.
    """
    made = ("kept", "n_bytes", "n_removed", "n_spans")
    text = F.coalesce("text", F.lit("")).cast("binary")
    columns = others(docs.columns, *made)
    # The text travels once, beside the other columns.
    rest = [c for c in columns if c != "text"]
    keyed = docs.select(packed(rest), F.xxhash64(text).alias("text_key"), "text")
    spans = repeated_spans(keyed.select("text_key", text.alias("text")), least, most, block)
    out = keyed.join(spans, "text_key", "left").withColumn("cut", cut_out(text, F.col("spans")))
    back = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns]
    return out.select(*back, "cut.*")
