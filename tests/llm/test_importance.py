import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from starmart.llm import importance
from tests.llm import data


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text)) if w]


def grams(text, n):
    own = words_of(text)
    return [" ".join(own[i : i + k]) for k in range(1, n + 1) for i in range(len(own) - k + 1)]


def brute_force(rows, target, n, buckets, percent, least):
    def bucket(x):
        return zlib.crc32(x.encode()) % buckets

    s = Counter(bucket(g) for r in rows for g in grams(r[1], n))
    t = Counter(bucket(g) for x in target for g in grams(x, n))
    big_s, big_t = s.total(), t.total()
    out = []
    for k, r in enumerate(rows):
        own = grams(r[1], n)
        gain = [
            math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
            for b in map(bucket, own)
        ]
        weight = sum(gain) // len(gain) if gain else 0
        digest = hashlib.sha256(f"2024:{'' if r[0] is None else r[0]}".encode()).hexdigest()
        u = (int(digest[:8], 16) + 0.5) / 4294967296
        out.append((r[0], len(own), weight, weight + math.floor(-1000 * math.log(-math.log(u)))))
    fits = [x for x, r in zip(out, rows) if len(words_of(r[1])) >= least]
    fits.sort(key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    drawn = {}
    for k, x in enumerate(fits[: percent * len(fits) // 100], 1):
        drawn.setdefault(x, []).append(k)
    return sorted(map(str, out)), sorted((str(x), k) for x, ks in drawn.items() for k in ks)


@pytest.mark.parametrize("n, percent", [(1, 10), (2, 35), (3, 100)])
def test_resampling_is_the_definition(spark, n, percent):
    rows = data.corpus(4, 5)
    target = [rows[0][1], "w1 w2 W3 é! über-Größe", None, "", rows[2][1]]
    df = spark.createDataFrame(rows, data.DOCUMENT).repartition(5)
    df = data.with_clashes(df, "row", "id", "fits", "w", "noise", "nth", "place", "before", "of_task", "rank", "score", "weight")
    want = spark.createDataFrame([(x, 1) for x in target], "text string, row int")
    out = importance.resample(df, want, n=n, buckets=500, percent=percent, least_words=20)
    assert set(out.columns) == set(df.columns) | {"n_features"}
    got = out.collect()
    every, drawn = brute_force(rows, target, n, 500, percent, 20)
    key = lambda r: str((r.doc_id, r.n_features, r.weight, r.score))
    assert sorted(map(key, got)) == every
    assert sorted((key(r), r["rank"]) for r in got if r["rank"] is not None) == drawn
    assert drawn and all(r.row == "row" and r.place == "place" for r in got)
    assert sorted(str(r.text) for r in got) == sorted(str(r[1]) for r in rows)


def test_many_rows_of_one_id_are_ranked_by_many_tasks(spark):
    df = spark.range(0, 4000, 1, 8).selectExpr("if(id % 2 = 0, null, id % 5) AS doc_id", "repeat('some words ', 20) AS text")
    want = spark.createDataFrame([("some text",)], "text string")
    out = importance.resample(df, want, percent=50, with_text=False)
    assert "text" not in out.columns
    got = out.collect()
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == list(range(1, 2001))
    scores = [r.score for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])]
    assert scores == sorted(scores, reverse=True)


def test_runs_do_not_cross_texts():
    counts, of, found = importance.features(pa.array(["a B", None, "", "c-d e", "b"]), 2, 1 << 32)
    assert counts.tolist() == [2, 0, 0, 3, 1]
    got = list(zip(of.tolist(), found.tolist()))
    expected = [(0, "a"), (0, "b"), (0, "a b"), (3, "c"), (3, "d"), (3, "e"), (3, "c d"), (3, "d e"), (4, "b")]
    assert sorted(got) == sorted((k, zlib.crc32(x.encode())) for k, x in expected)


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("null", [False, True])
def test_features_of_a_slice_are_those_of_its_texts(kind, null):
    texts = [f"A{k}-b{k % 3} " * (k % 4) + "É" for k in range(40)]
    if null:
        texts[9] = None
    whole = pa.array(texts, kind)
    for start, size in ((0, 40), (3, 20), (8, 5), (39, 1)):
        part = texts[start : start + size]
        counts, of, found = importance.features(whole.slice(start, size), 2, 1 << 32)
        assert counts.tolist() == [len(words_of(x)) for x in part]
        expected = [(k, zlib.crc32(g.encode())) for k, x in enumerate(part) for g in grams(x, 2)]
        assert sorted(zip(of.tolist(), found.tolist())) == sorted(expected)


def test_batches_of_several_slices_without_nulls(spark):
    rows = [(k, f"W{k % 50} x{k % 7}, Y{k % 11} " * (2 + k % 12)) for k in range(2 * importance.SLICE + 100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    target = ["w1 x1 y1", "w2 x2"]
    out = importance.resample(df, spark.createDataFrame([(x,) for x in target], "text string"), buckets=500)
    every, drawn = brute_force(rows, target, 1, 500, 10, 20)
    got = out.collect()
    key = lambda r: str((r.doc_id, r.n_features, r.weight, r.score))
    assert sorted(map(key, got)) == every
    assert drawn and sorted((key(r), r["rank"]) for r in got if r["rank"] is not None) == drawn


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    some = spark.createDataFrame([(1, "a b c " * 10)], "doc_id bigint, text string")
    assert importance.resample(none, some).count() == 0
    (row,) = importance.resample(some, none, percent=100).collect()
    assert row["rank"] == 1 and row.n_features == 30
