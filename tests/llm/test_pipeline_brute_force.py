"""The pipeline stage by stage against slow definitions on a small corpus."""

import hashlib
import math
import random
from collections import Counter

import corpus_pipeline
from starmart.llm import mixing, sharding
from tests.llm import data
from tests.llm.test_decontaminate import best
from tests.llm.test_near_dup import brute_force


def corpus():
    rng = random.Random(12)
    item = " ".join(data.words(rng, 30))
    rows = []

    def add(text, source):
        rows.append((len(rows), text, "en", source, len(text)))

    for k in range(60):
        good = [w + rng.choice(["", "", "", ".", ","]) for w in data.words(rng, rng.randrange(40, 90))]
        text = " ".join(good)
        if k % 10 == 3:
            text += " " + item
        add(text, "big")
        if k % 4 == 0:
            own = text.split()
            own[5] = "changed"
            add(" ".join(own), "small")
    for _ in range(40):
        add(" ".join(f"{w.upper()}!!" for w in data.words(rng, 8)) * 6, "junk")
    return rows, item


def poisson(rate, u):
    k, chance = 0, math.exp(-rate)
    total = chance
    while total <= u:
        k += 1
        chance *= rate / k
        total += chance
    return k


def test_every_stage(spark, tmp_path):
    rows, item = corpus()
    labels = [(r[0], int(r[3] != "junk"), 0) for r in rows if r[0] % 3]
    spark.createDataFrame(rows, data.DOCUMENT).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    by_id = {r[0]: r for r in rows}
    left = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)))
        left.append(docs.collect())

    ids = [sorted(r.doc_id for r in x) for x in left]
    assert ids[0] == [r[0] for r in rows if r[3] != "junk"]
    unique = {c for _, c in brute_force([by_id[i] for i in ids[0]]).values()}
    assert ids[1] == sorted(unique) and len(unique) < len(ids[0])
    clean = [i for i in ids[1] if best(by_id[i][1], item) < 0.75]
    assert ids[2] == clean and len(clean) < len(ids[1])

    sizes = Counter(by_id[i][3] for i in clean)
    weight = {s: n**mixing.TEMPERATURE for s, n in sizes.items()}
    rate = {s: len(clean) * weight[s] / sum(weight.values()) / sizes[s] for s in sizes}
    drawn = Counter()
    for i in clean:
        name = f"id:{i}:{hashlib.md5(by_id[i][1].encode()).hexdigest()}"
        digits = hashlib.md5(f"count {mixing.SEED}:{name}".encode()).hexdigest()[:13]
        drawn[i] = poisson(rate[by_id[i][3]], int(digits, 16) / 16**13)
    assert Counter(ids[3]) == +drawn

    assert ids[4] == ids[3]
    counts = Counter(int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % sharding.CELLS for i in ids[3])
    expected = Counter()
    for _, a, end, shard, _ in sharding.walk(counts, corpus_pipeline.SHARDS):
        expected[shard] += end - a
    assert Counter(r.shard for r in left[4]) == +expected
    assert all(tuple(r)[:5] == by_id[r.doc_id] for r in left[4])
