import math
import random

import numpy as np
from pyspark.sql import functions as F

from starmart.llm import topk


def brute_force(rows, asked, k):
    out = {}
    for q in asked:
        scores = [(-sum(a * b for a, b in zip(rows[q], rows[c])), c) for c in rows if c != q]
        out[q] = [(c, -s) for s, c in sorted(scores)[:k]]
    return out


def test_best_of_vectors_with_ties_and_unusable_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 60)
    monkeypatch.setattr(topk, "QUERIES", 2)
    rng = random.Random(4)
    vectors = {i: [rng.gauss(0, 1) for _ in range(5)] for i in range(400)}
    for i in range(300, 400):
        vectors[i] = vectors[7]
    rows = [(i, v, 1) for i, v in vectors.items()]
    rows += [(1000, None, 1), (1100, [1.0, None, 1.0, 1.0, 1.0], 1), (1200, [math.nan] * 5, 1),
             (1300, [math.inf] * 5, 1), (None, [9.0] * 5, 1), rows[3]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank int")
    df = df.select("vec_id", topk.quantised(F.col("embedding")).alias("vector"), "rank")
    found = {}
    for r in topk.top_k(df, df.where("vec_id % 100 = 0"), 10).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in vectors.items()}
    assert found == brute_force(whole, [0, 100, 200, 300], 10)


def test_bounds_end_reading_early_on_peaked_vectors():
    rng = np.random.default_rng(1)
    rows = rng.integers(-5, 5, (500, 8))
    rows[:6, 0] = 1000
    found = topk.search(np.array([3]), np.array([[900, 0, 0, 0, 0, 0, 0, 1]]), np.arange(500), rows, 4)
    scores = rows @ np.array([900, 0, 0, 0, 0, 0, 0, 1])
    best = sorted((x for x in range(500) if x != 3), key=lambda x: (-scores[x], x))[:4]
    assert found[1].tolist() == best


def test_scores_come_from_the_lists(monkeypatch):
    """Peaked vectors leave few rows to resolve; lists of flat ones are read to the end and leave none."""
    rng = np.random.default_rng(2)
    resolved = []

    def counted(rows, query, exact=topk._exact):
        resolved.append(len(rows))
        return exact(rows, query)

    monkeypatch.setattr(topk, "_exact", counted)
    flat = rng.integers(-1024, 1024, (1024, 32))
    peaked = rng.integers(-3, 3, (1024, 32))
    peaked[np.arange(1024), rng.integers(0, 32, 1024)] = rng.integers(500, 1024, 1024)
    for rows, early in ((flat, False), (peaked, True)):
        resolved.clear()
        asked = np.arange(0, 1024, 100)
        found = topk.search(asked, rows[asked], np.arange(1024), rows, 5)
        expected = brute_force(dict(enumerate(rows.tolist())), asked.tolist(), 5)
        for q in asked:
            own = found[0] == q
            assert list(zip(found[1][own].tolist(), found[2][own].tolist())) == expected[q]
        assert all(x <= topk.FEW * 5 for x in resolved)
        assert len(resolved) == (len(asked) if early else 0)


def test_huge_short_and_few(spark):
    rows = [(0, [2**62, 2**62]), (1, [2**62, 2**62]), (2, [-(2**62)]), (3, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>")
    found = [tuple(r) for r in topk.top_k(df, df.where("vec_id = 0")).orderBy("rank").collect()]
    assert found == [(0, 1, 1, 2**63 - 1), (0, 2, 3, 0), (0, 3, 2, -(2**63))]
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
