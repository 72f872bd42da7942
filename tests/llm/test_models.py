import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import language, queries, quality
from tests.llm import data

ROOT = "/root/testdata/sf0.01"
here = pytest.mark.skipif(not Path(ROOT).exists(), reason="the driver's tables are not here")


@here
def test_held_out_quality(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{ROOT}/labels.parquet").collect()}
    rows = queries.quality_scores(spark, ROOT).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in judged) >= 0.97 * len(judged)


@here
def test_held_out_languages(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    rows = [r for r in queries.languages(spark, ROOT).collect() if r.held_out]
    assert rows and sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.97 * len(rows)


def test_quality_of_awkward_rows(spark):
    rows = data.corpus(2, 2)
    df = spark.createDataFrame(rows, data.DOCUMENT).withColumn("score", F.lit("kept"))
    labels = [(i, i % 2, None) for i in range(10)] + [(3, None, 0), (None, 1, 0), (4, 7, 0), (3, 1, 1)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = quality.train(df, labels)
    found = quality.score(df, model, into="made").collect()
    assert len(found) == len(rows)
    assert all(0 <= r.made <= 1 and r.score == "kept" for r in found)
    empty = {r.made for r in found if not r.text}
    assert len(empty) == 1
    unknown = quality.train(df, labels.limit(0))
    assert {r.made for r in quality.score(df, unknown, into="made").collect()} == {0.5}
    assert quality.score(df.limit(0), unknown).count() == 0


def test_trees_as_arrays_follow_each_cut():
    rng = np.random.default_rng(0)
    x = rng.random((600, quality.FEATURES))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.3)).astype(float)
    model = quality.fit(x, y)

    def slow(row):
        total = model.start
        for feature, cut, value in zip(model.feature, model.cut, model.value):
            node = 0
            for _ in range(model.depth):
                node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
            total += value[node]
        return 1 / (1 + np.exp(-total))

    fast = model.score(x)
    assert np.allclose(fast, [slow(r) for r in x])
    assert ((fast > 0.5) == y).mean() > 0.97


def test_languages_of_awkward_rows(spark, monkeypatch):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"),
            (4, "", None), (5, "123 !?", "de"), (6, "the dog", None), (None, "die katze", None),
            (6, "the dog", None), (8, "the cat and " * 60_000, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit(1))
    model = language.train(df)
    found = language.predict(df, model).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert by_id[3] == by_id[4] == by_id[5] == ("und", 0.0)
    assert by_id[6][0] == by_id[8][0] == "en" and by_id[None][0] == "de"
    none = language.train(df.limit(0))
    assert {r.lang_pred for r in language.predict(df, none).collect()} == {"und"}


def test_pieces_hold_the_grams_of_the_whole(monkeypatch):
    text = "Zwölf Boxkämpfer jagen 12 Viktor " * 20
    whole = np.sort(np.concatenate(list(language._pieces(text))))
    monkeypatch.setattr(language, "PIECE", 17)
    assert (np.sort(np.concatenate(list(language._pieces(text)))) == whole).all()


def test_a_labelled_id_with_many_texts_is_one_row_of_the_sample(spark, monkeypatch):
    texts = [(7, f"junk number {i}") for i in range(3000)] + [(i, f"own text {i}") for i in range(10, 60)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(6)
    labels = spark.createDataFrame([(i, i % 2) for i in (7, *range(10, 60))], "doc_id bigint, quality int")
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda x, y: fitted.append((x, y)))
    quality.train(docs, labels, max_rows=40)
    quality.train(docs.repartition(3), labels, max_rows=40)
    (x, y), (again, _) = fitted
    assert len(x) == len(y) == 40 and (x == again).all()


def grams_by_hand(text):
    """Buckets of all 1-, 2- and 3-grams, one at a time."""
    codes = [48 if "0" <= c <= "9" else 32 if "\t" <= c <= "\r" else ord(c) for c in text.lower()]
    out = []
    for size in (1, 2, 3):
        for i in range(len(codes) - size + 1):
            h = 0
            for j in range(size):
                h = (h * 31 + codes[i + j] * int(language._FACTORS[j])) % 2**32
            h = (h + size - 1) * 0x85EBCA6B % 2**32
            out.append((h ^ h >> 15) % language.BUCKETS)
    return out


def test_log_posteriors_by_hand(spark):
    rows = [("a", "The 12 cats\tsat"), ("a", None), ("b", "Der Hund läuft"), ("b", "der der"), ("c", ""), (None, "xyz")]
    model = language.train(spark.createDataFrame(rows, "lang string, text string"))
    counts = {lang: np.zeros(language.BUCKETS) for lang in "abc"}
    for lang, text in rows:
        for g in grams_by_hand(text or "") if lang else ():
            counts[lang][g] += 1
    for text in ("der cat 99", "Hund", "", "字"):
        expected = [
            -np.log(3) + sum(np.log((n[g] + 0.5) / (n.sum() + 0.5 * language.BUCKETS)) for g in grams_by_hand(text))
            for n in counts.values()
        ]
        assert np.allclose(language._scores(model, [text])[0], expected, atol=1e-3)
        (row,) = language.predict(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), model).collect()
        if language.has_letter(text):
            chance = np.exp(expected - np.max(expected))
            assert row.lang_pred == "abc"[int(np.argmax(expected))]
            assert abs(row.score - 1 / chance.sum()) < 1e-3


def test_a_model_knows_the_most_frequent_languages_only(spark):
    rows = [(f"junk{i}", "some text") for i in range(50)] + [("en", "the cat sat")] * 3 + [("de", "der hund")] * 2
    df = spark.createDataFrame(rows, "lang string, text string")
    assert language.train(df, most=3).languages == ["de", "en", "junk0"]
    plain = language.train(df.where("lang IN ('en', 'de')"))
    some = language.train(df, most=2)
    assert some.languages == plain.languages and (some.log_chance == plain.log_chance).all()


def statistics_by_hand(text):
    import math
    import re
    from collections import Counter

    data = text.encode()
    n = len(data)
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    own = [w for w in re.split("[ \t\n\x0b\x0c\r]+", lowered) if w]
    count, seen = len(own), Counter(own)
    share = lambda a, b: a / b if b else 0.0
    of = lambda chars: sum(data.count(c.encode()) for c in chars)
    space = of(" \t\n\x0b\x0c\r")
    upper, lower = sum("A" <= c <= "Z" for c in text), sum("a" <= c <= "z" for c in text)
    wide = sum(b >= 128 for b in data)
    odd = of("#$%&*+/<=>@\\^_`{|}~[]")
    runs = lambda k: [tuple(own[i : i + k]) for i in range(count - k + 1)]
    lines = [x for x in data.split(b"\n") if x.strip()]
    most = max(seen.values(), default=0)
    marked = re.findall(rb"[^\sA-Za-z0-9\x80-\xff.,;:?'\"()-](?=\s|$)", data)
    return [
        math.log1p(n), math.log1p(count), share(n - space, count), share(space, n), share(upper, upper + lower + wide),
        share(of("0123456789"), n), share(of(".,;:?'\"()-"), n), share(of("!"), count), share(odd, n), share(odd, count),
        share(wide, n), -sum(k / n * math.log2(k / n) for k in Counter(data).values()), share(len(seen), count),
        share(most, count), share(len(set(runs(2))), len(runs(2))), share(len(set(runs(5))), len(runs(5))),
        share(sum(a == b for a, b in zip(own, own[1:])), count), math.log1p(len(lines)), share(count, len(lines)),
        share(len(set(lines)), len(lines)), share(sum(x.rstrip()[-1:] in b".!?" for x in lines), len(lines)),
        share(len(marked), count), share(of("|"), count), share(data.count(b"http"), count), math.log1p(most),
        share(of(".,"), count),
    ]


def test_statistics_by_hand():
    texts = [
        "One two two! See http://x.y/z?a=1&b=2 | 12.5%\n\n  \nOne two two!  Größe #tag* end.\r\nCAPS, caps; (caps)",
        "a b c d e a b c d e a b c d e", "x", "!!! ~~~ $$$", "字 ſ é\tÄ 99", "line one.\nline one.\nline two",
    ]
    made = quality.statistics(texts)
    for text, row in zip(texts, made):
        assert np.allclose(row, statistics_by_hand(text)), text
    assert not quality.statistics([None, ""]).any()
