from collections import Counter

from pyspark.sql import functions as F

from starmart.llm import sharding
from tests.llm import data


def check(found, n, shards):
    counts = Counter(r.shard for r in found)
    assert sum(counts.values()) == n
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(counts.get(s, 0)))


def test_counts_slots_and_rows(spark):
    rows = data.corpus()
    rows += [rows[0]] * 300
    df = data.with_clashes(spark.createDataFrame(rows, data.DOCUMENT), "rank", "end", "cell", "n")
    out = sharding.shard_rows(df, 7)
    assert out.columns == [*df.columns, "shard", "slot"]
    found = out.collect()
    check(found, len(rows), 7)
    plain = lambda xs: Counter((r.doc_id, r.text) for r in xs)
    assert plain(found) == plain(df.collect())
    assert Counter(map(tuple, found)) == Counter(map(tuple, sharding.shard_rows(df, 7).collect()))


def test_maps_and_columns_of_any_name(spark, monkeypatch):
    monkeypatch.setattr(sharding, "STEP", 3)
    df = spark.range(40).selectExpr(
        "id % 7 as doc_id", "map('k', id % 3, 'l', null) as m", "array(map(1, id % 2)) as deep", "'t' as text"
    )
    names = ["row", "maps", "entries", "key", "cell", "part", "of", "start", "end", "first", "rank", "low", "at", "ring_cell", "a.b"]
    df = df.withColumns({n: F.lit(n) for n in names})
    found = sharding.shard_rows(df, 3).collect()
    check(found, 40, 3)
    assert all([r[n] for n in names] == names for r in found)
    plain = lambda xs: Counter((r.doc_id, str(r.m), str(r.deep)) for r in xs)
    assert plain(found) == plain(df.collect())


def test_the_query_s_columns(spark, tmp_path):
    import zlib

    from starmart.llm.queries import QUERIES

    rows = data.corpus(2, 3)
    spark.createDataFrame(rows, data.DOCUMENT).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op3_hash_ring"](spark, str(tmp_path)).collect()
    check(found, len(rows), 24)
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    expected = Counter((i, len(t) + 8, zlib.crc32(t), "rows", None) for i, t in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in found) == expected


def test_few_rows_and_none(spark):
    some = spark.createDataFrame([(1, "a"), (2, None), (None, "")], "doc_id bigint, text string")
    check(sharding.shard_rows(some, 24).collect(), 3, 24)
    assert sharding.shard_rows(some.limit(0), 24).count() == 0


def test_only_overflow_moves():
    """Against the shard of the first point clockwise; and with a shard more most rows stay."""
    n = 40_000
    counts = Counter((i * 2654435761) % sharding.CELLS for i in range(n))
    points = sharding.ring(24)

    def natural(cell):
        return next((s for c, s in points if c >= cell), points[0][1])

    placed = list(sharding.walk(counts, 24))
    assert sum(e - a for _, a, e, _, _ in placed) == n
    stayed = sum(e - a for c, a, e, s, _ in placed if s == natural(c))
    load = Counter()
    for c, k in counts.items():
        load[natural(c)] += k
    overflow = sum(max(0, k - n / 24) for k in load.values())
    assert n - stayed <= overflow + 24
    before = {(c, r): s for c, a, e, s, _ in placed for r in range(a, e)}
    after = {(c, r): s for c, a, e, s, _ in sharding.walk(counts, 25) for r in range(a, e)}
    moved = sum(before[k] != after[k] for k in before)
    assert moved < n / 3


def test_a_key_of_many_rows_is_ranked_in_parts(spark):
    rows = [(None if i % 3 else i, f"t{i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = sharding.shard_rows(df, 5)
    found = out.collect()
    check(found, len(rows), 5)
    assert Counter(r.text for r in found) == Counter(t for _, t in rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x and "sum(n" in x and "key#" in x]
    assert windows and all("[cell" in x and ", part" in x for x in windows)
