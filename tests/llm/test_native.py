"""The two operators of DataFrame functions only."""

import math
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import mixing, url_reputation
from tests.llm import data


def test_rules_hosts_and_awkward_urls(spark):
    cases = {
        "http://A.B.Example.ORG/es/1": ("a.b.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12?x": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://badexample.org/es/1": ("badexample.org", "/es/1", "org/", "allow"),
        "http://x.org": ("x.org", "", None, None),
        "http://x.com/fr/#a://b": ("x.com", "/fr/", "com/fr/", "allow"),
        "http://x.com/de/?q": ("x.com", "/de/", "com/de/", "block"),
        "x://É.COM/De/": ("É.com", "/De/", None, None),
        "no scheme": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
        "http://": ("", "", None, None),
        "http://u@h.co.uk:80/p": ("u@h.co.uk:80", "/p", None, None),
    }
    urls = list(cases) + ["http://x.com/" + "a" * 100_000]
    rows = [(i, u, "x") for i, u in enumerate(urls)] + [(None, urls[0], "x"), (0, urls[0], "x")]
    pages = data.with_clashes(spark.createDataFrame(rows, "page_id bigint, url string, html string"), "host", "n", "site", "bound")
    outcomes = spark.createDataFrame([(i, i % 2) for i in range(5)] + [(0, None), (None, 1), (3, 5)], "page_id bigint, good int")
    found = url_reputation.judge(pages, outcomes).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found}
    for i, want in enumerate(cases.values()):
        r = by_id[i]
        assert (r.host, r.path, r.rule) == want[:3]
        assert r.verdict == want[3] if want[3] else r.verdict in ("allow", "block")
    assert url_reputation.judge(pages.limit(0), outcomes).count() == 0
    none = url_reputation.judge(pages, outcomes.limit(0)).collect()
    assert len(none) == len(rows) and len({r.host_bound for r in none}) == 1


def test_few_outcomes_are_shrunk_to_relatives(spark):
    """A new host of a good domain is trusted, one of a bad domain is not, and many outcomes outweigh both."""
    rows, outcomes = [], []
    for host, good, bad in (("a.good.net", 400, 4), ("b.good.net", 300, 3), ("new.good.net", 0, 0),
                            ("a.bad.net", 4, 300), ("b.bad.net", 2, 200), ("new.bad.net", 0, 0),
                            ("odd.bad.net", 500, 0)):
        for k in range(max(1, good + bad)):
            rows.append((len(rows), f"http://{host}/{k}"))
            if good + bad:
                outcomes.append((len(rows) - 1, int(k < good)))
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    found = url_reputation.judge(pages, spark.createDataFrame(outcomes, "page_id bigint, good int"), rules=())
    by_host = {r.host: r for r in found.collect()}
    assert by_host["new.good.net"].host_bound > by_host["new.bad.net"].host_bound
    assert by_host["a.good.net"].verdict == "allow" and by_host["a.bad.net"].verdict == "block"
    assert by_host["odd.bad.net"].verdict == "allow"


def test_counts_are_the_inverted_poisson(spark):
    rows = [(i, f"t{i}", "en", "big" if i % 10 else ("small" if i % 20 else None), 1) for i in range(4000)]
    df = data.with_clashes(spark.createDataFrame(rows, data.DOCUMENT), "rate", "sums", "n", "weight", "u")
    rate = {r.of_source: r.rate for r in mixing.rates(df).collect()}
    found = mixing.mix(df).collect()
    assert set(found[0].asDict()) == set(df.columns) | {"copy", "shuffle_key"}
    copies = Counter(r.doc_id for r in found)
    import hashlib

    for i, text, _, source, _ in rows:
        name = f"id:{i}:{hashlib.md5(text.encode()).hexdigest()}"
        u = int(hashlib.md5(f"count {mixing.SEED}:{name}".encode()).hexdigest()[:13], 16) / 16**13
        k, p = 0, math.exp(-rate[source])
        total = p
        while total <= u:
            k += 1
            p *= rate[source] / k
            total += p
        assert copies[i] == k
    share = Counter(r.source for r in found)
    for source, mean in rate.items():
        n = sum(r[3] == source for r in rows)
        assert abs(share[source] - mean * n) < 5 * math.sqrt(mean * n)
    assert all(sorted(r.copy for r in found if r.doc_id == i) == list(range(1, copies[i] + 1)) for i in (1, 10, 20))


def test_rows_without_an_id_are_dealt_out(spark):
    df = spark.range(3000).selectExpr(
        "cast(null as bigint) as doc_id", "concat('t', id) as text", "'s' as source", "map(1, id) as extra"
    )
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        found = mixing.mix(df, epochs=3).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset(merging)
    assert len(found) > 1
    total = sum(r["count"] for r in found)
    assert abs(total - 9000) < 5 * math.sqrt(9000) and max(r["count"] for r in found) < total / 2


def test_equal_rows_are_drawn_alike_and_dealt_out(spark):
    df = spark.range(3000).selectExpr("cast(null as bigint) as doc_id", "'same' as text", "'s' as source")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        found = mixing.mix(df, epochs=3).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset(merging)
    total = sum(r["count"] for r in found)
    assert total == 3000 * round(total / 3000) > 0 and max(r["count"] for r in found) < total / 2


def test_rows_that_share_an_id_are_drawn_by_text(spark, monkeypatch):
    rows = [(None, f"no id {i}", "en", "none", 1) for i in range(3000)]
    rows += [(7, f"one id {i}", "en", "one", 1) for i in range(3000)] + [(7, None, "en", "one", 1)]
    rows += [(100 + i, f"own {i}", "en", "own", 1) for i in range(3000)]
    df = spark.createDataFrame(rows, data.DOCUMENT)
    rate = {r.of_source: r.rate for r in mixing.rates(df).collect()}
    found = mixing.mix(df).collect()
    share = Counter(r.source for r in found)
    for source in ("none", "one", "own"):
        mean = 3000 * rate[source]
        assert abs(share[source] - mean) < 5 * math.sqrt(mean), source
    copies = Counter(Counter(r.text for r in found if r.source == "none").values())
    for k in (1, 2, 3):
        chance = 3000 * math.exp(-rate["none"]) * rate["none"] ** k / math.factorial(k)
        assert abs(copies[k] - chance) < 5 * math.sqrt(chance)
    # The draws are the same in the pipeline, and where the sources are joined by a shuffle.
    by_stage = corpus_pipeline.mix_sources(spark, data.with_clashes(df, "copy", "row"), "").collect()
    assert Counter(r[:5] for r in by_stage) == Counter(r[:5] for r in found)
    assert {(r.copy, r.row) for r in by_stage} == {("copy", "row")}
    monkeypatch.setattr(mixing, "BROADCAST_ENTRIES", 0)
    assert Counter(mixing.mix(df).collect()) == Counter(found)


def test_columns_of_any_name_are_kept(spark):
    df = spark.createDataFrame([(i, f"t{i}", None, f"s{i % 2}", 1) for i in range(50)], data.DOCUMENT)
    names = ["row", "salt", "name", "in_source", "of_source", "sums", "u", "n", "Copy", "shuffle_key", "a.b", "mix_u"]
    found = mixing.mix(df.withColumns({n: F.lit(n) for n in names})).collect()
    kept = [n for n in names if n not in ("Copy", "shuffle_key")]
    assert found and all([r[n] for n in kept] == kept and isinstance(r.copy, int) for r in found)


def test_weights_large_rates_and_no_rows(spark):
    rows = [(1, "a", None, "x", 1), (2, "b", None, "y", 1), (None, None, None, None, None)] * 2
    df = spark.createDataFrame(rows, data.DOCUMENT)
    found = mixing.mix(df, weights={"x": 1.0, "z": 5.0}, epochs=500).collect()
    assert {r.source for r in found} == {"x"}
    assert 2600 < len(found) < 3400
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df, weights={"z": 1.0}).count() == 0


def test_no_python_in_the_plans(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id bigint, url string")
    outcomes = spark.createDataFrame([(1, 1)], "page_id bigint, good int")
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], data.DOCUMENT)
    for df in (url_reputation.judge(pages, outcomes), mixing.mix(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
