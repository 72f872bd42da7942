import random
from collections import Counter

import numpy as np
import pytest

from starmart.llm import suffix_array, suffix_dedup
from tests.llm import data


@pytest.mark.parametrize("repeats", [0.5, 2, 16, 1000])
def test_suffixes_are_in_order(monkeypatch, repeats):
    monkeypatch.setattr(suffix_array, "REPEATS", repeats)
    rng = random.Random(int(repeats))
    for _ in range(200):
        symbols = rng.choice((1, 2, 3, 30, 150))
        body = [rng.randrange(1, symbols + 1) for _ in range(rng.randrange(200))]
        if rng.random() < 0.3:
            body = (body[: rng.randrange(1, 6)] * 100)[: len(body)]
        s = np.array([*body, 0])
        order = suffix_array.suffix_array(s, symbols + 1)
        whole = s.tolist()
        assert order.tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])


def repeats_of(texts, least):
    """Every byte in a string that starts more than once, by the definition."""
    starts = Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - least + 1):
            if starts[t[i : i + least]] > 1:
                gone[i : i + least] = True
        out.append(gone)
    return out


def expected(texts, least):
    texts = [(t or "").encode() for t in texts]
    out = []
    for t, gone in zip(texts, repeats_of(texts, least)):
        runs = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) > 0).sum())
        out.append((bytes(b for b, x in zip(t, gone) if not x), len(t), int(gone.sum()), runs))
    return out


def test_shards_find_all_repeated_windows():
    rng = random.Random(8)
    for least in (1, 2, 5):
        segments = [bytes(rng.choice(b"ab") for _ in range(least + rng.randrange(12))) for _ in range(20)]
        counts = Counter(x[i : i + least] for x in segments for i in range(len(x) - least + 1))
        for segment, flags in zip(segments, suffix_dedup.shard_windows(segments, least)):
            assert flags.tolist() == [counts[segment[i : i + least]] > 1 for i in range(len(segment) - least + 1)]


@pytest.mark.parametrize("seed, least, most, block", [(1, 24, 8192, 1 << 20), (2, 10, 2, 300), (3, 3, 8192, 100), (4, 24, 0, 50)])
def test_bytes_removed_are_those_of_the_definition(spark, monkeypatch, seed, least, most, block):
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abé字 ") for _ in range(rng.randrange(5, 60))) for _ in range(25)]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(8))) + str(rng.random()) for _ in range(80)]
    texts += [None, None, "", "", "x" * 400, "xy" * 150, "abc" * 90, "z" * (least - 1), "z" * (least - 1)]
    texts += ["own " + "".join(rng.choice("abcdefgh") for _ in range(3000)), texts[0], texts[0], texts[3][:-1]]
    texts += [texts[5][7:] + texts[6]] * 3
    ids = [None, None, *range(2, len(texts) - 2), 4, 4]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string").repartition(5)
    df = data.with_clashes(df, "row", "text_key", "spans", "cut", "kept", "key", "spot", "digest", "places")
    out = suffix_dedup.remove_repeated_bytes(df, least, most, block)
    assert set(out.columns) == set(df.columns) | {"n_bytes", "n_removed", "n_spans"}
    rows = out.collect()
    got = [(str(r.doc_id), str(r.text), bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in rows]
    want = [(str(i), str(t), *e) for i, t, e in zip(ids, texts, expected(texts, least))]
    assert sorted(got) == sorted(want)
    assert any(0 < r.n_removed < r.n_bytes for r in rows) and all(r.row == "row" and r.digest == "digest" for r in rows)


def test_query_on_a_small_table(spark, tmp_path):
    import hashlib

    from starmart.llm.queries import QUERIES

    rows = data.corpus(6, 6)
    spark.createDataFrame(rows, data.DOCUMENT).write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op13_suffix_dedup"](spark, str(tmp_path))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect())
    # All but the two very long texts by the definition; those are one run of words of their own and one byte.
    short = [r for r in rows if r[1] is None or len(r[1]) < 100_000]
    want = [(str(r[0]), n, gone, runs, hashlib.sha256(kept).hexdigest())
            for r, (kept, n, gone, runs) in zip(short, expected([r[1] for r in short], 200))]
    (z,) = [r for r in rows if r[1] and r[1].startswith("zzz")]
    want.append((str(z[0]), 700_000, 700_000, 1, hashlib.sha256(b"").hexdigest()))
    assert sorted(want) == [g for g in got if g[1] < 100_000 or g[1] == 700_000]
    assert len(got) == len(rows) == len(want) + 1


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert suffix_dedup.remove_repeated_bytes(none).count() == 0
