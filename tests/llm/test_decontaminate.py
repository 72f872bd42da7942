import random

import numpy as np

from starmart.llm import decontaminate as dc, words
from tests.llm import data


def weighted(own, n):
    from collections import Counter

    return Counter(tuple(own[i : i + n]) for i in range(len(own) - n + 1))


def best(text, item):
    own, asked = (text or "").lower().split(), (item or "").lower().split()
    if not own or not asked:
        return 0
    n = min(5, len(asked))
    two = weighted(asked, n)
    top = 0
    for start in range(max(1, len(own) - len(asked) + 1)):
        one = weighted(own[start : start + len(asked)], n)
        if one:
            top = max(top, sum((one & two).values()) / sum((one | two).values()))
    return top


def cases():
    rng = random.Random(9)
    items = [" ".join(data.words(rng, rng.randrange(14, 50))) for _ in range(12)] + ["same same same same same same same", "only three words"]
    rows = []
    for i, item in enumerate(items):
        for edits in (0, 1, 2, 4, 8):
            own = item.split()
            for _ in range(edits):
                own[rng.randrange(len(own))] = f"y{rng.randrange(10**6)}"
            rows.append(" ".join(data.words(rng, rng.randrange(0, 60)) + own + data.words(rng, 20)))
        rows.append(item.upper())
        rows.append(" ".join(item.split()[:-2]))
    return items, rows + [None, "", "   ", "w1 " * 20_000]


def test_hits_are_those_of_all_windows(spark):
    items, texts = cases()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, similarity string")
    bench = spark.createDataFrame(list(enumerate(items)) + [(90, None), (91, "")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.similarity for r in dc.contaminations(docs, bench).collect()}
    expected = {}
    for d, text in enumerate(texts[:-1]):
        for i, item in enumerate(items):
            value = best(text, item)
            if value >= dc.THRESHOLD:
                expected[d, i] = value
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - expected[k]) < 1e-9 for k in found)
    odd = data.with_clashes(docs, "row", "text_hash", "bad_hash", "item_id")
    clean = dc.without_contaminated(odd, bench)
    assert clean.columns == odd.columns
    left = {r.doc_id for r in clean.collect() if r.row == "row" and r.bad_hash == "bad_hash"}
    assert left == set(range(len(texts))) - {d for d, _ in expected}


def repeated_cases(rng):
    """Pairs (text, item) at or near the threshold in which shingles repeat."""
    word = lambda: f"w{rng.randrange(10**6)}"
    for _ in range(25):
        # One word stands 14 times after 88 words that are kept.
        item = [word() for _ in range(102)]
        yield [*item[:88], *[word()] * 14], item
        yield item, [*item[:88], *[word()] * 14]
        # The majority passes from one repeated run of five words to another.
        one, two = [word() for _ in range(5)], [word() for _ in range(5)]
        yield one * 23 + two * 22, one * 22 + two * 23
        # Two shingles in nearly equal weight.
        a, b = word(), word()
        yield [a] * rng.randrange(20, 30) + [b] * rng.randrange(20, 30), [a] * 25 + [b] * 25
        period = [word() for _ in range(rng.randrange(1, 9))]
        item = (period * 60)[: rng.randrange(20, 60)]
        text = list(item)
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = word()
        yield text, item


def test_no_hit_is_lost_where_shingles_repeat():
    rng = random.Random(4)
    hits = 0
    for text, item in repeated_cases(rng):
        around = [f"z{rng.randrange(10**6)}" for _ in range(30)]
        whole = " ".join([*around[:15], *text, *around[15:]])
        index = dc.build([0], [" ".join(item)])
        ((_, hashes, _),) = words.hashed_words([whole])
        found = {i: value for i, value, *_ in dc.matches(index, hashes)}
        expected = best(whole, " ".join(item))
        assert (0 in found) == (expected >= dc.THRESHOLD), (text, item)
        if found:
            hits += 1
            assert abs(found[0] - expected) < 1e-9
    assert hits > 60


def test_repeated_and_plain_items_of_one_length(monkeypatch):
    """Windows with and without repeats over one index give the windows of the definition, each once."""
    rng = random.Random(5)
    items = [" ".join(rng.choice("abcdefgh") for _ in range(12)) for _ in range(30)]
    items += [" ".join(f"v{rng.randrange(40)}" for _ in range(12)) for _ in range(10)]
    index = dc.build(list(range(len(items))), items)
    for _ in range(20):
        text = " ".join(rng.choice(items) for _ in range(4)) + " x " + items[-1]
        own = text.split()
        ((_, hashes, _),) = words.hashed_words([text])
        found = {i: (round(value, 9), first, n) for i, value, first, n in dc.matches(index, hashes)}
        expected = {}
        for i, item in enumerate(items):
            values = [best(" ".join(own[k : k + 12]), item) for k in range(len(own) - 11)]
            good = [v for v in values if v >= dc.THRESHOLD]
            if good:
                expected[i] = round(max(good), 9), values.index(max(good)), len(good)
        assert found == expected


def test_parts_of_a_large_benchmark(spark, monkeypatch):
    items, texts = cases()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    whole = sorted(map(tuple, dc.contaminations(docs, bench).collect()))
    monkeypatch.setattr(dc, "PART", 4)
    assert sorted(map(tuple, dc.contaminations(docs, bench).collect())) == whole


def test_multi_index_gives_all_within_the_radius(monkeypatch):
    rng = np.random.default_rng(2)
    here = dc.Length(9, 5)
    here.prints = list(rng.integers(0, 256, (200, 16), dtype=np.uint8))
    here.sets = [(np.array([k], dtype=np.uint64), np.array([1])) for k in range(200)]
    here.index()
    asked = np.stack(here.prints)[:50].copy()
    flips = rng.random((50, 128)) < 0.33
    asked ^= np.packbits(flips, axis=1)
    distance = np.array([[sum(bin(a ^ b).count("1") for a, b in zip(x, y)) for y in here.prints] for x in asked])
    expected = set(map(tuple, np.argwhere(distance <= dc.RADIUS).tolist()))
    assert set(here.candidates(asked)) == expected
    monkeypatch.setattr(dc, "PAIRS", 700)
    assert set(here.candidates(asked)) == expected


def test_long_documents_in_spans(monkeypatch):
    items, texts = cases()
    index = dc.build(list(range(len(items))), items)
    text = " ".join(t for t in texts if t)
    ((_, hashes, _),) = words.hashed_words([text])
    whole = sorted(dc.matches(index, hashes))
    assert len(whole) > len(items) / 2
    for span in (1, 7, 64):
        monkeypatch.setattr(dc, "SPAN", span)
        assert sorted(dc.matches(index, hashes)) == whole


def test_fingerprints_by_majority(monkeypatch):
    rng = np.random.default_rng(3)
    shingles = rng.integers(0, 2**63, 40, dtype=np.uint64)
    starts = np.array([0, 3, 29])
    hashed = np.stack([words.mix(shingles), words.mix(shingles ^ np.uint64(0x5851F42D4C957F2D))], axis=1)
    bits = np.unpackbits(hashed.view(np.uint8).reshape(40, 16), axis=1)
    expected = [np.packbits(bits[s : s + 11].sum(axis=0) > 5.5) for s in starts]
    for counts in (1, 5 * 8 * 41, 1 << 21):
        monkeypatch.setattr(dc, "COUNTS", counts)
        assert (dc.fingerprints(shingles, starts, 11) == np.stack(expected)).all()


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    one = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    assert dc.contaminations(docs, bench).count() == 0
    assert dc.contaminations(one, bench).count() == 0
    assert dc.without_contaminated(one, bench).count() == 1
