"""Languages by multinomial naive Bayes over hashed character n-grams.

Counts of the n-grams of 1 to GRAMS characters, hashed to BUCKETS numbers, are
added up over all labelled texts. The matrix of log probabilities (languages by
buckets) is broadcast; a slice of texts is scored by adding up the rows of the
matrix that its n-grams name. Case is folded and digits are one character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BUCKETS = 1 << 15
GRAMS = 3
#: Characters handled at once; longer texts come in pieces that overlap by GRAMS - 1.
PIECE = 1 << 18
SLICE = 256
UNDETERMINED = "und"
#: Languages of a model at most: 262 MB of counts on the driver, half of that in a task.
MOST_LANGUAGES = 1_000
_FACTORS = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    codes[(codes >= 48) & (codes <= 57)] = 48
    codes[(codes >= 9) & (codes <= 13)] = 32
    return codes


def _grams(codes: np.ndarray, old: int = 0) -> list[np.ndarray]:
    """Buckets of the 1-, 2- and 3-grams that end after the first ``old`` characters."""
    out = []
    total = np.zeros(len(codes), dtype=np.uint32)
    for k in range(GRAMS):
        total = total[: len(codes) - k] * np.uint32(31) + codes[k:] * _FACTORS[k]
        if len(codes) <= k:
            break
        value = (total + np.uint32(k)) * np.uint32(0x85EBCA6B)
        out.append((value ^ (value >> np.uint32(15)))[max(0, old - k) :] % np.uint32(BUCKETS))
    return out


def _pieces(text: str) -> Iterator[np.ndarray]:
    for at in range(0, len(text), PIECE):
        start = max(0, at - GRAMS + 1)
        yield from _grams(_codes(text[start : at + PIECE]), at - start)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task by language and bucket."""
    counts: dict[str, np.ndarray] = {}
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            part = whole.slice(at, SLICE)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                have = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                for grams in _pieces(text or ""):
                    if len(grams) < BUCKETS // 4:
                        np.add.at(have, grams, 1)
                    else:
                        have += np.bincount(grams, minlength=BUCKETS)
    for lang, have in counts.items():
        used = np.flatnonzero(have)
        used = used if len(used) else np.zeros(1, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used), type=pa.string()), pa.array(used), pa.array(have[used])],
            ["lang", "bucket", "n"],
        )


@dataclass
class Model:
    languages: list[str]
    #: One row per bucket, one column per language.
    log_chance: np.ndarray
    log_prior: np.ndarray


def train(docs: DataFrame, smoothing: float = 0.5, most: int = MOST_LANGUAGES) -> Model:
    """A model from all rows with a language; their texts are counted whole, in the tasks.

    The driver receives BUCKETS numbers per language, so the model knows at most the
    ``most`` languages that most rows have (ties to the first by name); rows of others
    teach nothing. Languages have equal priors. Without labelled rows the model knows
    no language.
    """
    sizes = docs.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    known = [r["lang"] for r in sizes.orderBy(F.desc("n"), "lang").limit(most).collect()]
    rows = (
        docs.where(F.col("lang").isin(known))
        .select("lang", "text")
        .mapInArrow(_counted, "lang string, bucket bigint, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((BUCKETS, len(languages)))
    place = {lang: k for k, lang in enumerate(languages)}
    counts[rows["bucket"].to_numpy(int), rows["lang"].map(place).to_numpy(int)] = rows["n"].to_numpy(float)
    chance = (counts + smoothing) / (counts.sum(axis=0) + smoothing * BUCKETS)
    prior = np.full(len(languages), -np.log(max(1, len(languages))))
    return Model(languages, np.log(chance).astype(np.float32), prior)


def _scores(model: Model, texts: list[str | None]) -> np.ndarray:
    """Log posterior, up to a constant, of each language for each text."""
    out = np.tile(model.log_prior, (len(texts), 1))
    if not model.languages:
        return out
    group: list[np.ndarray] = []
    owners: list[int] = []
    size = 0

    def add_up():
        sums = np.add.reduceat(
            model.log_chance[np.concatenate(group)],
            np.cumsum([0] + [len(x) for x in group[:-1]]),
            axis=0,
            dtype=np.float64,
        )
        np.add.at(out, owners, sums)

    for k, text in enumerate(texts):
        for grams in _pieces(text or ""):
            if len(grams):
                group.append(grams)
                owners.append(k)
                size += len(grams)
            if size >= PIECE:
                add_up()
                group, owners, size = [], [], 0
    if group:
        add_up()
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (the posterior, 0 to 1) of each row.

    A null text, a text without a letter, and any text under a model without
    languages is UNDETERMINED with score 0. Ties go to the first language by name. A very
    long text is scored whole, in pieces.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                part = whole.slice(at, SLICE)
                texts = part.column("text").to_pylist()
                names, chances = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                if known.languages:
                    logs = _scores(known, texts)
                    best = logs.argmax(axis=1)
                    top = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                    for k, text in enumerate(texts):
                        if has_letter(text):
                            names[k], chances[k] = known.languages[best[k]], top[k]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, type=pa.string()), pa.array(chances)],
                    ["doc_id", "lang_pred", "score"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        predicted, "doc_id bigint, lang_pred string, score double"
    )
