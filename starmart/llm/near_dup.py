"""Near-duplicate documents by MinHash with tensored banding.

A text is the set of its distinct five-word shingles; two texts are linked if
100 * intersection >= 75 * union. A bucket key is a pair (i, j) of one of SIDE
half keys of a first collection and one of SIDE of a second, each made of ROWS
minimum hashes: SIDE * SIDE tables of 2 * ROWS hashes from only
2 * SIDE * ROWS hash functions. Texts at similarity s share a bucket with
probability (1 - (1 - s**ROWS)**SIDE)**2: 0.9995 at 0.75, 0.99993 at 0.8.

Every pair of texts that share a bucket is either compared on the full sets or
already in one component, so no link is lost within the buckets: first each
text with the least of its buckets' first members, then with the other first
members, then whatever is still in different components. That last comparison
leaves out pairs whose sizes or whose parity bitmaps (each shingle flips one of
BITS bits, so two bitmaps differ in no more bits than the sets in shingles) rule
a link out, and lists a pair only in the first bucket it shares.

Equal shingle sets are one node (a 64-bit hash of the set) from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmart.llm import words
from starmart.llm.components import components, redealt
from starmart.llm.rows import packed
from starmart.scratch import discard, gathered, stored

SIDE = 10
ROWS = 2
#: A link needs 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
#: Texts turned into Python strings at once.
SLICE = 256
BITS = 1024
#: Pairs, and nodes with their texts or bucket keys, that a task takes at least.
EACH = 2_000

_BIT_COLUMNS = [f"bits_{k}" for k in range(BITS // 64)]
_SEEDS = words.mix(np.arange(1, 2 * SIDE * ROWS + 1, dtype=np.uint64))
_FACTORS = words.mix(np.arange(1001, 1001 + 2 * SIDE * ROWS, dtype=np.uint64)) | np.uint64(1)


def _half_keys(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """2 * SIDE half keys of each of some non-empty sets that follow each other."""
    keys = np.empty((len(starts), 2 * SIDE), dtype=np.uint64)
    for half in range(2 * SIDE):
        key = np.full(len(starts), half, dtype=np.uint64)
        for k in range(half * ROWS, (half + 1) * ROWS):
            least = np.minimum.reduceat((sets ^ _SEEDS[k]) * _FACTORS[k], starts)
            key = words.mix(key * np.uint64(0xA0761D6478BD642F) + least)
        keys[:, half] = key
    return keys


def _set_hashes(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each set, from two sums over its members, which have no order."""
    one = np.add.reduceat(words.mix(sets ^ np.uint64(0x5851F42D4C957F2D)), starts)
    two = np.add.reduceat(words.mix(sets ^ np.uint64(0x14057B7EF767814F)), starts)
    return words.mix(one ^ words.mix(two))


def _parities(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each set BITS bits as BITS / 64 numbers: whether an odd number of members falls on a bit."""
    place = np.repeat(np.arange(len(sizes)) * BITS, sizes) + (sets % np.uint64(BITS)).astype(np.int64)
    odd = (np.bincount(place, minlength=len(sizes) * BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(len(sizes), BITS // 64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            batch = whole.slice(at, SLICE)
            n = batch.num_rows
            counts = np.zeros(n, dtype=np.int64)
            nodes = np.zeros(n, dtype=np.int64)
            halves = np.zeros((n, 2 * SIDE), dtype=np.int64)
            bits = np.zeros((n, BITS // 64), dtype=np.int64)
            for first, sets, bounds in words.shingle_sets(batch.column("text").to_pylist()):
                sizes = np.diff(bounds)
                bits[first : first + len(sizes)] = _parities(sets, sizes)
                counts[first : first + len(sizes)] = sizes
                full = np.flatnonzero(sizes)
                if len(full):
                    starts = bounds[:-1][full]
                    nodes[first + full] = _set_hashes(sets, starts).view(np.int64)
                    halves[first + full] = _half_keys(sets, starts).view(np.int64)
            offsets = np.concatenate([[0], np.cumsum(np.where(counts > 0, 2 * SIDE, 0))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(counts),
                    pa.array(nodes, mask=counts == 0),
                    pa.ListArray.from_arrays(
                        pa.array(offsets, type=pa.int32()), pa.array(halves[counts > 0].ravel())
                    ),
                    *(pa.array(x) for x in bits.T.copy()),
                ],
                ["doc_id", "text_hash", "n_shingles", "node", "halves", *_BIT_COLUMNS],
            )


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of texts whose full shingle sets are similar enough."""
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            batch = whole.slice(at, SLICE)
            texts: dict[int, str] = {}
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            for ids, name in ((a, "text_a"), (b, "text_b")):
                column = batch.column(name)
                for i, node in enumerate(ids):
                    if node not in texts:
                        texts[node] = column[i].as_py()
            order = list(texts)
            sets = {}
            for first, values, bounds in words.shingle_sets([texts[x] for x in order]):
                for k in range(len(bounds) - 1):
                    sets[order[first + k]] = values[bounds[k] : bounds[k + 1]]
            keep = []
            for x, y in zip(a, b):
                one, two = sets[x], sets[y]
                together = len(np.unique(np.concatenate([one, two])))
                common = len(one) + len(two) - together
                keep.append(100 * common >= THRESHOLD * together)
            yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that hold on the full sets."""
    side = lambda name: texts.select(
        F.col("node").alias(name), F.col("text").alias(f"text_{name}")
    )
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return stored(gathered(both, pairs.count(), EACH).mapInArrow(_linked, "a bigint, b bigint"))


def _text_hash() -> F.Column:
    return F.xxhash64(F.col("text").isNull(), "text")


def _relabelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets with the label of their component, a node of its own its own label."""
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _split_buckets(members: DataFrame) -> DataFrame:
    """The members of the buckets that still hold more than one component."""
    split = (
        members.groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low != high")
        .select(redealt("key").alias("key"))
    )
    return members.join(split, "key", "left_semi")


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``node``, half keys and bitmap of each row."""
    return docs.select("doc_id", _text_hash().alias("text_hash"), "text").mapInArrow(
        _signatures,
        "doc_id bigint, text_hash bigint, n_shingles bigint, node bigint, halves array<bigint>, "
        + ", ".join(f"{x} bigint" for x in _BIT_COLUMNS),
    )


def _open_pairs(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b), a > b, of nodes that share a bucket but no component and may be linked."""
    halves = [F.slice("halves", 1, SIDE).alias("firsts"), F.slice("halves", SIDE + 1, SIDE).alias("seconds")]
    full = stored(
        members.select("key", "node", "label").join(
            nodes.select("node", "n_shingles", *halves, *_BIT_COLUMNS), "node"
        )
    )
    a, b = full.alias("a"), full.alias("b")
    differing = " + ".join(f"bit_count(a.{x} ^ b.{x})" for x in _BIT_COLUMNS)
    # A similarity of t leaves (1 - t) / (1 + t) of the summed sizes outside the intersection.
    may_link = f"""
        a.label != b.label AND a.node > b.node
        AND 100 * least(a.n_shingles, b.n_shingles) >= {THRESHOLD} * greatest(a.n_shingles, b.n_shingles)
        AND {100 + THRESHOLD} * ({differing}) <= {100 - THRESHOLD} * (a.n_shingles + b.n_shingles)
        AND a.key = xxhash64(
            get(array_intersect(a.firsts, b.firsts), 0), get(array_intersect(a.seconds, b.seconds), 0)
        )"""
    return a.join(b, (F.col("a.key") == F.col("b.key")) & F.expr(may_link)).select(
        F.col("a.node").alias("a"), F.col("b.node").alias("b")
    )


def _bucket_members(nodes: DataFrame, n: int) -> DataFrame:
    """``key``, ``node`` and the bucket's least node, of the buckets with two nodes or more.

    A half key that only one node has is in no such bucket; it goes before the
    keys are paired.
    """
    halves = nodes.select("node", F.posexplode("halves").alias("place", "half"))
    common = (
        halves.groupBy("half")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .where("low != high")
        .select(redealt("half").alias("half"))
    )
    of = lambda first: F.collect_list(
        F.when((F.col("place") < SIDE) == F.lit(first), F.col("half"))
    )
    paired = (
        halves.join(common, "half", "left_semi")
        .groupBy("node")
        .agg(of(True).alias("firsts"), of(False).alias("seconds"))
        .select("node", F.explode("firsts").alias("first"), "seconds")
        .select("node", "first", F.explode("seconds").alias("second"))
    )
    keyed = stored(gathered(paired.select(F.xxhash64("first", "second").alias("key"), "node"), n, EACH))
    buckets = (
        keyed.groupBy("key")
        .agg(F.min("node").alias("pivot"), F.max("node").alias("high"))
        .where("pivot != high")
        .select(redealt("key").alias("key"), "pivot")
    )
    members = stored(gathered(keyed.join(buckets, "key"), n, EACH))
    discard(keyed)
    return members


def _texts(docs: DataFrame, nodes: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """One text of each node that shares a bucket."""
    wanted = members.select("node").distinct().join(nodes, "node")
    wanted = wanted.select("node", F.col("least.doc_id").alias("doc_id"), F.col("least.text_hash"))
    texts = docs.select("doc_id", "text", _text_hash().alias("text_hash"))
    same = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["text_hash"] == wanted["text_hash"])
    found = texts.join(wanted, same).select("node", "text")
    return stored(gathered(found.dropDuplicates(["node"]), n, EACH))


def links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Confirmed links (a, b) that connect the nodes of each component."""
    n = nodes.count()
    members = _bucket_members(nodes, n)
    texts = _texts(docs, nodes, members, n)

    first = members.where("node != pivot").groupBy("node").agg(F.min("pivot").alias("b"))
    tried = stored(gathered(first.select(F.col("node").alias("a"), "b"), n, EACH))
    found = _confirmed(tried, texts)
    labels = components(found)

    open_members = stored(gathered(_split_buckets(_relabelled(members, labels)), n, EACH))
    pivots = labels.select(F.col("node").alias("pivot"), F.col("label").alias("pivot_label"))
    second = (
        open_members.where("node != pivot")
        .select("node", "pivot", "label")
        .distinct()
        .join(pivots, "pivot", "left")
        .where(F.col("label") != F.coalesce("pivot_label", "pivot"))
        .select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        .join(tried, ["a", "b"], "left_anti")
    )
    second = stored(gathered(second, n, EACH))
    more = _confirmed(second, texts)
    found, tried = found.unionAll(more), tried.unionAll(second)
    labels = components(found)

    rest = _split_buckets(_relabelled(open_members.drop("label"), labels))
    third = stored(_open_pairs(rest, nodes).join(tried, ["a", "b"], "left_anti"))
    return found.unionAll(_confirmed(third, texts))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Each row's component of near-duplicates.

    ``docs`` has doc_id bigint and text string; other columns are not read. Returns
    one row per row: doc_id, text_hash, n_shingles, component_id (least doc_id
    reachable, the own one included), kept (doc_id = component_id) and stays,
    which holds for one document of each component even if ids repeat.

    A null text and one without words have no shingles and no links: their
    component is their own doc_id. A null doc_id counts as larger than any other;
    component_id is null only where all ids of a component are. A very long text is taken
    apart whole, in pieces, and has one signature. Rows equal in
    doc_id and text get the same result. No rows give no rows.
    """
    rows = stored(signatures(docs))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    nodes = (
        rows.where("n_shingles > 0")
        .groupBy("node", "n_shingles", "halves", *_BIT_COLUMNS)
        .agg(F.min(order).alias("least"))
    )
    nodes = stored(gathered(nodes, rows.count(), EACH))
    labels = components(links(docs, nodes))
    of_node = nodes.join(labels, "node", "left").select(
        "node", F.coalesce("label", "node").alias("label"), "least"
    )
    least = of_node.groupBy("label").agg(F.min("least").alias("first"))
    named = of_node.select("node", "label").join(
        least.select(redealt("label").alias("label"), "first"), "label"
    )
    named = named.select(F.col("node").alias("named"), "first")
    out = rows.drop("halves", *_BIT_COLUMNS).join(named, F.col("node") == F.col("named"), "left")
    own = F.col("node").isNull()
    return out.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(own, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        (own | F.col("doc_id").eqNullSafe(F.col("first.doc_id"))).alias("kept"),
        (
            own
            | (
                F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
                & (F.col("text_hash") == F.col("first.text_hash"))
            )
        ).alias("stays"),
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without all but one document of each component.

    Documents without words stay. Of rows equal in doc_id and text one stays.
    Columns are those of ``docs``, whatever their names.
    """
    results = stored(near_duplicates(docs))
    stays = stored(
        results.where("stays")
        .groupBy(F.col("doc_id").alias("keep_id"), F.col("text_hash").alias("keep_hash"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    marked = docs.select(packed(docs.columns), F.col("doc_id").alias("own_id"), _text_hash().alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("keep_id")) & (F.col("own_hash") == F.col("keep_hash"))
    single = marked.join(stays.where("copies = 1"), same).select("row.*")
    several = stays.where("copies > 1")
    if several.isEmpty():
        return single
    again = marked.join(several, same).dropDuplicates(["keep_id", "keep_hash"]).select("row.*")
    return single.unionAll(again)
