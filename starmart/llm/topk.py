"""Exact top-k inner products by sorted lists without random access.

Every block of candidates has one list per dimension, sorted by value. A query
reads the lists of its positive components from the top and those of its negative
ones from the bottom, all to the same depth. What has been read gives each
candidate a lower bound (unread values at their worst) and an upper bound (unread
values at the last one read). Once few candidates can still reach the k-th lower
bound the rest is out, and the scores of those few are resolved. Depths double, and
all queries of a block read together; only entries not read before are added. Lists
read to their ends make both bounds the score, so nothing is left to resolve.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.scratch import stored

SCALE = 1024
BLOCK = 2048
QUERIES = 256
#: Reading ends when no more than this many times k candidates are left.
FEW = 4
#: Doubles hold integers below this exactly.
EXACT = 2**53


def quantised(vector: Column) -> Column:
    """floor(SCALE * x) of every component; null if the vector or a component is null or not finite."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < math.inf)
    )
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


def _exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products, held at the ends of bigint if they pass them."""
    if float(np.abs(rows).max(initial=0)) * float(np.abs(query).max(initial=0)) * max(1, len(query)) < 2**62:
        return rows @ query
    products = rows.astype(object) @ query.astype(object)
    return np.array([min(max(int(x), -(2**63)), 2**63 - 1) for x in products], dtype=np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores.astype(object) if len(scores) and scores.min() == -(2**63) else -scores))[:k]


def search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """(query id, id, score) of the best k rows for each query, its own row left out."""
    n, dims = rows.shape
    size = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, dims)
    active = np.arange(len(queries))
    candidates: dict[int, np.ndarray] = {}
    scored: dict[int, np.ndarray] = {}
    if size < EXACT and dims and n > k:
        order = np.argsort(rows, axis=0, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(n)[:, None], axis=0)
        lists = np.take_along_axis(rows, order, axis=0).astype(float)
        values = rows.astype(float)
        read = np.zeros((len(queries), n))
        before, depth = 0, max(k + 1, n // 16)
        while len(active) and before < n:
            depth = min(depth, n)
            high, low = place >= n - depth, place < depth
            new_high, new_low = high & (place < n - before), low & (place >= before)
            up, down = np.maximum(queries[active], 0).astype(float), np.minimum(queries[active], 0).astype(float)
            read[active] += up @ (values * new_high).T + down @ (values * new_low).T
            lower, upper = read[active], read[active]
            if depth < n:
                unread_up, unread_down = (~high).T.astype(float), (~low).T.astype(float)
                lower += (up * lists[0]) @ unread_up + (down * lists[-1]) @ unread_down
                upper += (up * lists[n - depth - 1]) @ unread_up + (down * lists[depth]) @ unread_down
            own = query_ids[active][:, None] == ids[None, :]
            lower[own], upper[own] = -math.inf, -math.inf
            bar = np.partition(lower, n - k, axis=1)[:, n - k]
            possible = (upper >= bar[:, None]) & ~own
            for i, query in enumerate(active):
                candidates[query] = np.flatnonzero(possible[i])
                if depth == n:
                    scored[query] = read[query, candidates[query]].astype(np.int64)
            active = active[possible.sum(axis=1) > FEW * k]
            before, depth = depth, depth * 2
    out = []
    for i in range(len(queries)):
        # Without bounds (short lists, huge values) every row is a candidate.
        left = candidates.get(i)
        if left is None:
            left = np.flatnonzero(ids != query_ids[i])
        scores = scored[i] if i in scored else _exact(rows[left], queries[i])
        best = _best(scores, ids[left], k)
        out.append((np.full(len(best), query_ids[i]), ids[left][best], scores[best]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 3


def _matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), dtype=np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the k best rows for each query.

    Both inputs have vec_id bigint and vector array<bigint>. A row is compared with
    all rows of other ids; ties go to the smaller id. Null ids and null vectors take
    no part; of rows with one id the least vector counts. A shorter vector ends in
    zeros. Scores past the ends of bigint are held there. Queries and candidates meet
    in blocks of about QUERIES and BLOCK rows, and only the k best of each block go on.
    """

    def one_each(df: DataFrame) -> DataFrame:
        known = df.where("vec_id IS NOT NULL AND vector IS NOT NULL")
        return stored(known.groupBy("vec_id").agg(F.min("vector").alias("vector")))

    rows, asked = one_each(vectors), one_each(queries)
    blocks = lambda df, size: max(1, math.ceil(df.count() / size))
    n_rows, n_asked = blocks(rows, BLOCK), blocks(asked, QUERIES)
    dealt = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("vec_id", "vector", dealt(n_rows, 1).alias("rows"), every(n_asked).alias("asked"))
    right = asked.select("vec_id", "vector", every(n_rows).alias("rows"), dealt(n_asked, 2).alias("asked"))

    def block(some: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        dims = max((len(v) for v in [*some["vector"], *ask["vector"]]), default=0)
        found = search(
            ask["vec_id"].to_numpy(np.int64),
            _matrix(ask["vector"], dims),
            some["vec_id"].to_numpy(np.int64),
            _matrix(some["vector"], dims),
            k,
        )
        return pd.DataFrame(dict(zip(["query_id", "vec_id", "score"], found)))

    best = (
        left.groupBy("rows", "asked")
        .cogroup(right.groupBy("rows", "asked"))
        .applyInPandas(block, "query_id bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
