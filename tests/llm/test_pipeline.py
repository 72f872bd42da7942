from pathlib import Path

import pytest

import corpus_pipeline
from tests.llm import data

ROOT = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(ROOT).exists(), reason="the driver's tables are not here")
def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, ROOT))
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, ROOT).collect()
    assert len(last) == counts[-1]
    assert {r.shard for r in last} == set(range(24))


def test_awkward_rows_go_through(spark, tmp_path):
    rows = data.corpus(5, 3)
    df = data.with_clashes(spark.createDataFrame(rows, data.DOCUMENT), "score", "rank", "node", "copy", "shard_")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    spark.createDataFrame([(0, rows[0][1]), (1, None)], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert set(out.columns) == set(df.columns) | {"shard", "slot"}
    out.collect()
