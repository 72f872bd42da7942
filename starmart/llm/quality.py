"""Text quality by histogram gradient-boosted trees over document statistics.

The statistics are computed in the tasks, one row of numbers per text. The trees
are grown on the driver from at most ``max_rows`` rows of statistics, never from
texts, and flattened into arrays that every task walks for a whole slice of
documents at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm import words

#: Labelled rows a model is fitted on at most; those with the least hashes of their ids are taken.
MAX_TRAINING_ROWS = 20_000
FEATURES = 26
SLICE = 256

_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("a") : ord("z") + 1] = 3
_CLASS[ord("0") : ord("9") + 1] = 4
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 5
_CLASS[[ord(c) for c in "!"]] = 6
_CLASS[[ord(c) for c in "#$%&*+/<=>@\\^_`{|}~[]"]] = 7
_CLASS[128:] = 8
_MARKED = re.compile(rb"[^\sA-Za-z0-9\x80-\xff.,;:?'\"()-](?=\s|$)")


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def _of_text(data: bytes, hashes: np.ndarray) -> list[float]:
    """The statistics of a text from its UTF-8 bytes and the hashes of its words."""
    n = len(data)
    letters = np.frombuffer(data, dtype=np.uint8)
    kinds = np.bincount(_CLASS[letters], minlength=9)
    values = np.bincount(letters, minlength=256)
    chance = values[values > 0] / max(n, 1)
    count = len(hashes)
    _, seen = np.unique(hashes, return_counts=True)
    pairs = words.runs(hashes, 2)
    triples = words.runs(hashes, 5)
    lines = [x for x in data.split(b"\n") if x.strip()]
    closed = sum(x.rstrip()[-1:] in b".!?" for x in lines)
    same = np.count_nonzero(hashes[1:] == hashes[:-1]) if count > 1 else 0
    letters_only = kinds[2] + kinds[3] + kinds[8]
    return [
        np.log1p(n),
        np.log1p(count),
        _share(n - kinds[1], count),
        _share(kinds[1], n),
        _share(kinds[2], letters_only),
        _share(kinds[4], n),
        _share(kinds[5], n),
        _share(kinds[6], count),
        _share(kinds[7], n),
        _share(kinds[7], count),
        _share(kinds[8], n),
        float(-(chance * np.log2(chance)).sum()) if n else 0.0,
        _share(len(seen), count),
        _share(seen.max(initial=0), count),
        _share(len(np.unique(pairs)), len(pairs)),
        _share(len(np.unique(triples)), len(triples)),
        _share(same, count),
        np.log1p(len(lines)),
        _share(count, len(lines)),
        _share(len(set(lines)), len(lines)),
        _share(closed, len(lines)),
        _share(len(_MARKED.findall(data)), count),
        _share(values[ord("|")], count),
        _share(data.count(b"http"), count),
        np.log1p(seen.max(initial=0)),
        _share(values[ord(".")] + values[ord(",")], count),
    ]


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of FEATURES statistics per text; a null counts as an empty text."""
    out = np.zeros((len(texts), FEATURES))
    for first, hashes, bounds in words.hashed_words(texts):
        for k in range(len(bounds) - 1):
            data = (texts[first + k] or "").encode("utf-8", "surrogatepass")
            out[first + k] = _of_text(data, hashes[bounds[k] : bounds[k + 1]])
    return out


@dataclass
class Forest:
    """Trees as arrays: node i of a tree goes to 2i+1 if its statistic is at most the cut, else to 2i+2."""

    start: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node]
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    least_rows: int = 20,
    ridge: float = 1.0,
) -> Forest:
    """Boosted trees for the log-odds of y = 1. Without rows, or with one label only, a constant."""
    nodes = 2 ** (depth + 1) - 1
    n = len(x)
    mean = (y.sum() + 1) / (n + 2)
    start = float(np.log(mean / (1 - mean)))
    none = Forest(start, np.zeros((0, nodes), int), np.zeros((0, nodes)), np.zeros((0, nodes)), depth)
    if n == 0 or y.min() == y.max():
        return none
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(FEATURES)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    slot = binned + np.arange(FEATURES) * bins
    total = np.full(n, start)
    grown = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, curve = y - p, p * (1 - p)
        feature, cut, value = np.zeros(nodes, int), np.full(nodes, np.inf), np.zeros(nodes)
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            shape = (width, FEATURES, bins)
            cell = ((at - first)[:, None] * FEATURES * bins + slot).ravel()
            sums = lambda w: np.bincount(
                cell, np.repeat(w, FEATURES), minlength=width * FEATURES * bins
            ).reshape(shape)
            g, h, c = (sums(w).cumsum(axis=2) for w in (slope, curve, np.ones(n)))
            g_all, h_all, c_all = (s[:, :1, -1:] for s in (g, h, c))
            gain = (
                g**2 / (h + ridge)
                + (g_all - g) ** 2 / (h_all - h + ridge)
                - g_all**2 / (h_all + ridge)
            )
            gain[(c < least_rows) | (c_all - c < least_rows)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                    feature[first + k], cut[first + k] = f, edges[f][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > cut[at])
        leaves = np.arange(nodes) >= 2**depth - 1
        up = np.bincount(at, slope, minlength=nodes)
        down = np.bincount(at, curve, minlength=nodes)
        value[leaves] = rate * (up / (down + ridge))[leaves]
        total += value[at]
        grown.append((feature, cut, value))
    return Forest(start, *(np.stack(x) for x in zip(*grown)), depth)


def remainder(column: str, of: int) -> Column:
    """crc32 of an id's text, modulo ``of``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % of


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            batch = whole.slice(at, SLICE)
            values = statistics(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), *(pa.array(v) for v in values.T.copy())],
                ["label", *(f"f{k}" for k in range(FEATURES))],
            )


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_TRAINING_ROWS) -> Forest:
    """A model of ``label`` (0 or 1) from the texts of labelled documents.

    ``labels`` has doc_id and the label; rows with a null or another value are left
    out, and the label of an id that has both values is 1. At most ``max_rows``
    labelled ids are used, each with one of its texts, the same in every run.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    # max_rows ids and labels are small, whatever the corpus. Of the texts of one id the one with
    # the least hash counts, so that an id that very many rows share is one row of the sample.
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    least = F.min_by("text", F.xxhash64(F.col("text").isNull(), "text")).alias("text")
    texts = labelled.groupBy("doc_id", "label").agg(least).select("label", "text")
    schema = "label int, " + ", ".join(f"f{k} double" for k in range(FEATURES))
    measured = texts.mapInArrow(_measured, schema)
    rows = measured.toPandas().sort_values(measured.columns).to_numpy(dtype=float)
    return fit(rows[:, 1:], rows[:, 0])


def score(docs: DataFrame, model: Forest, into: str = "score") -> DataFrame:
    """``docs`` with the column ``into``, from 0 to 1; higher means label 1 is likelier.

    A null text is scored as an empty one, a very long one whole, SLICE texts at a time. A column of that name is replaced, others
    are kept. A model fitted on no rows gives every text a half. No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        parts = [
            shared.value.score(statistics(list(texts.iloc[at : at + SLICE])))
            for at in range(0, len(texts), SLICE)
        ]
        return pd.Series(np.concatenate(parts) if parts else [], dtype=float)

    return docs.withColumn(into, scored(F.col("text")))
