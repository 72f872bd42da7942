import random

import pytest

from starmart.llm import line_dedup
from tests.llm import data


def brute_force(docs, least):
    """Kept lines of each of some (id, lines), all ids distinct and lines not blank."""
    order = [(d, k) for d, lines in sorted(docs.items()) for k in range(len(lines))]
    gone = set()
    seen = set()
    runs = {}
    for d, k in order:
        lines = docs[d]
        for end in range(k, len(lines)):
            run = tuple(lines[k : end + 1])
            if sum(len(x.split()) for x in run) >= least:
                first = runs.setdefault(run, (d, k))
                if first != (d, k):
                    gone |= {(d, j) for j in range(k, end + 1)}
    return {d: [x for k, x in enumerate(lines) if (d, k) not in gone] for d, lines in docs.items()}


@pytest.mark.parametrize("seed", range(3))
def test_runs_deleted_are_those_of_all_runs(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join("ab"[rng.randrange(2)] for _ in range(rng.randrange(1, 5))) for _ in range(6)]
    docs = {i: [rng.choice(pool) if rng.random() < 0.9 else f"own {i} {k}" for k in range(rng.randrange(1, 14))]
            for i in range(30)}
    df = spark.createDataFrame([(i, "\n".join(x)) for i, x in docs.items()], "doc_id bigint, text string")
    expected = brute_force(docs, 7)
    for r in line_dedup.remove_repeated_lines(df, min_words=7).collect():
        assert [x for x in r.text.split("\n") if x] == expected[r.doc_id], r.doc_id
        assert (r.n_lines, r.n_deleted) == (len(docs[r.doc_id]), len(docs[r.doc_id]) - len(expected[r.doc_id]))
    assert any(len(expected[i]) < len(docs[i]) for i in docs)


def test_awkward_rows(spark):
    run = "one two three\n\nfour five six\nseven"
    rows = [
        (1, f"head\n{run}\ntail", "k"),
        (2, run, "k"),
        (3, f"x {run}\n\nfour five six", "k"),
        (4, None, "k"),
        (5, "", "k"),
        (None, run, None),
        (7, "a b c\n" * 5, "k"),
        (8, "long " * 100_000, "k"),
        (9, "unique words only here and there", "k"),
        (9, "unique words only here and there", "k"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    df = data.with_clashes(df, "doc", "at", "rank", "n_lines", "run", "ends", "row", "text_hash", "ranges", "cut", "run_key", "a.b")
    out = line_dedup.remove_repeated_lines(df, min_words=6)
    assert set(out.columns) == set(df.columns) | {"n_deleted"}
    found = {}
    for r in out.collect():
        found.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.n_deleted))
    # A null id counts as 0, so its copy is the first.
    assert found[None] == [(run, 3, 0)]
    assert found[1] == [("head\ntail", 5, 3)]
    assert found[2] == [("", 3, 3)]
    assert found[4] == [(None, 0, 0)] and found[5] == [("", 0, 0)]
    assert found[7] == [("a b c\n", 5, 4)]
    assert found[8][0][2] == 0
    assert found[9] == [(rows[-1][1], 1, 0)] * 2


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.remove_repeated_lines(none).count() == 0
