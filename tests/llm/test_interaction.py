import random
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from starmart.llm import interaction
from tests.llm import data

LETTERS = "ABCDE"


def test_ranks_are_lexicographic():
    for rank, order in enumerate(permutations(range(4))):
        assert interaction.lehmer(order, 4) == rank
        assert interaction.lehmer(order[:3], 4) == rank
    assert interaction.lehmer((2,), 4) == 12


def test_intervals_cover_each_mask_once():
    for n in (1, 3, 5):
        orders = list(permutations(range(n)))
        seen = Counter()
        for mask, step, first, end in interaction.intervals(n):
            for rank in range(first, end):
                seen[mask, rank] += 1
                order = orders[rank]
                assert step == 1 + min(order.index(x) for x in range(n) if mask >> x & 1)
        assert seen == Counter({(m, r): 1 for m in range(1, 1 << n) for r in range(len(orders))})


def failures(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    return "".join(
        letter
        for letter, fails in (
            ("A", len(words) < 100),
            ("B", 100 * len(set(words)) < 80 * len(words)),
            ("C", 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text)),
            ("D", any(c in "#$%&*|" for c in text)),
        )
        if fails
    )


def brute_force(rows, labels):
    """All orders, step by step, on (doc_id, text, lang) rows."""
    good = {d for d, q, t in labels if q == 1 and d is not None}
    toxic = {d for d, q, t in labels if t == 1 and d is not None}
    least = {}
    for d, text, _ in rows:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    parts = {}
    for d, text, lang in rows:
        text = text or ""
        fails = failures(text) + ("E" if d is not None and least[text] < d else "")
        parts.setdefault(lang or "", []).append((fails, d in good, d in toxic))
    out, shapley = {}, Counter()
    for part, members in parts.items():
        for order in permutations(LETTERS):
            left = members
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[0]]
                stay = [m for m in left if f not in m[0]]
                redundant = sum(f in m[0] for m in members) - len(gone)
                unique = sum(m[0] == f for m in members)
                out[part, "".join(order), step] = (
                    len(stay), len(gone), redundant, unique, sum(m[1] for m in gone), sum(m[2] for m in gone),
                )
                shapley[part, f] += len(gone)
                left = stay
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


def test_audit_is_that_of_all_orders(spark):
    rng = random.Random(3)
    rows = []
    for i in range(150):
        words = [f"w{rng.randrange(rng.choice((20, 2000)))}" for _ in range(rng.choice((5, 130)))]
        text = " ".join(words) + rng.choice(("", " #", "\n|"))
        rows.append((i, rng.choice((text, text.upper(), rows[0][1] if rows else text)), rng.choice(("en", "de", None, ""))))
    rows += [(None, rows[0][1], "en"), (None, None, None), (5, None, "xx"), (6, "", "xx"), rows[0], rows[9], rows[9]]
    rows.append((900, "Long words " * 60_000, "en"))
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 150, 4)] + [(0, 0, 0), (0, None, None), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame([(d, q, None if t is None else int(t)) for d, q, t in labels],
                                  "doc_id bigint, quality int, toxic int")
    docs = data.with_clashes(docs, "part", "mask", "n", "rank", "step", "digest", "least", "A", "E", "good", "times")
    marks = data.with_clashes(marks, "part", "good", "E", "text")
    assert found(interaction.audit_documents(docs, marks)) == brute_force(rows, labels)


def test_other_filters_and_weights(spark):
    df = spark.createDataFrame([("p", True, False, 3), ("p", True, True, 2), ("p", None, True, 1), (None, None, None, 4)],
                               "part string, x boolean, y boolean, n int")
    out = interaction.audit(df, F.col("part"), {"x": F.col("x"), "y": F.col("y")}, {"both": F.col("x") & F.col("y")}, F.col("n"))
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.both_lost, r.shapley)
           for r in out.collect()}
    assert got == {
        ("p", "xy", 1): (1, 5, 0, 3, 2, 8), ("p", "xy", 2): (0, 1, 2, 1, 0, 4),
        ("p", "yx", 1): (3, 3, 0, 1, 2, 4), ("p", "yx", 2): (0, 3, 2, 3, 0, 8),
        ("", "xy", 1): (4, 0, 0, 0, 0, 0), ("", "xy", 2): (4, 0, 0, 0, 0, 0),
        ("", "yx", 1): (4, 0, 0, 0, 0, 0), ("", "yx", 2): (4, 0, 0, 0, 0, 0),
    }
    with pytest.raises(ValueError):
        interaction.audit(df, F.col("part"), {})


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert interaction.audit_documents(none, labels).count() == 0
