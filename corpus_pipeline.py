"""A corpus made ready for training: five stages over documents, each a table of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.llm import decontaminate, mixing, near_dup, quality, sharding
from starmart.llm.rows import packed
from starmart.llm.shipping import ship
from starmart.scratch import stored

#: Documents scored lower are rejected.
LEAST_QUALITY = 0.3
SHARDS = 24


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject; the model knows the labels of four fifths of the ids."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(quality.remainder("doc_id", 5) != 0)
    model = quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
    scored = quality.score(docs.select(packed(docs.columns), "text"), model)
    return scored.where(F.col("score") >= LEAST_QUALITY).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    ship(spark)
    return near_dup.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    ship(spark)
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for, shuffled."""
    return mixing.mix(docs, marked=False)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return sharding.shard_rows(docs, SHARDS)


STAGES = [
    ("quality_classifier", keep_quality),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("poisson_mixing", mix_sources),
    ("hash_ring_sharding", shard),
]

#: The classifier and the two similarity stages have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the result of each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
