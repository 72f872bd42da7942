"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.llm import (
    decontaminate,
    importance,
    interaction,
    language,
    line_dedup,
    mixing,
    near_dup,
    quality,
    secrets,
    sharding,
    suffix_dedup,
    topk,
    url_reputation,
)
from starmart.llm.oracle import ORACLE  # noqa: F401
from starmart.llm.shipping import ship

SHARDS = 24


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{root}/{name}.parquet")


def line_runs(spark: SparkSession, root: str) -> DataFrame:
    docs = _table(spark, root, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_lines(docs)


def secret_scan(spark: SparkSession, root: str) -> DataFrame:
    return secrets.digest(secrets.scan(_table(spark, root, "documents")))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id with the size and checksum of the text; a null text is an empty one."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )


def hash_ring(spark: SparkSession, root: str) -> DataFrame:
    placed = sharding.shard_rows(sized(_table(spark, root, "documents")), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def url_verdicts(spark: SparkSession, root: str) -> DataFrame:
    """The label of the document whose doc_id is a page's page_id is that page's outcome."""
    outcomes = _table(spark, root, "labels").select(
        F.col("doc_id").alias("page_id"), F.col("quality").alias("good")
    )
    return url_reputation.judge(_table(spark, root, "pages"), outcomes)


def quality_scores(spark: SparkSession, root: str) -> DataFrame:
    docs, labels = _table(spark, root, "documents"), _table(spark, root, "labels")
    model = quality.train(docs, labels.where(quality.remainder("doc_id", 5) != 0))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (quality.remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def languages(spark: SparkSession, root: str) -> DataFrame:
    docs = _table(spark, root, "documents")
    model = language.train(docs.where(quality.remainder("doc_id", 4) != 2))
    held_out = (quality.remainder("doc_id", 4) == 2).alias("held_out")
    return language.predict(docs, model).select("doc_id", held_out, "lang_pred", "score")


def nearest(spark: SparkSession, root: str) -> DataFrame:
    rows = _table(spark, root, "embeddings").select(
        "vec_id", topk.quantised(F.col("embedding")).alias("vector")
    )
    return topk.top_k(rows, rows.where("vec_id % 100 = 0"))


def mixture(spark: SparkSession, root: str) -> DataFrame:
    docs = _table(spark, root, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs)


def benchmark_hits(spark: SparkSession, root: str) -> DataFrame:
    return decontaminate.contaminations(_table(spark, root, "documents"), _table(spark, root, "benchmark"))


def near_duplicate_classes(spark: SparkSession, root: str) -> DataFrame:
    found = near_dup.near_duplicates(_table(spark, root, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def importance_sample(spark: SparkSession, root: str) -> DataFrame:
    docs = _table(spark, root, "documents").select("doc_id", "text")
    drawn = importance.resample(docs, _table(spark, root, "benchmark"), with_text=False)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def filter_audit(spark: SparkSession, root: str) -> DataFrame:
    return interaction.audit_documents(_table(spark, root, "documents"), _table(spark, root, "labels"))


def repeated_bytes(spark: SparkSession, root: str) -> DataFrame:
    docs = _table(spark, root, "documents").select("doc_id", "text")
    cut = suffix_dedup.remove_repeated_bytes(docs)
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", digest)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_runs": line_runs,
    "op2_secrets": secret_scan,
    "op3_hash_ring": hash_ring,
    "op4_url_reputation": url_verdicts,
    "op5_quality": quality_scores,
    "op6_languages": languages,
    "op7_top_k": nearest,
    "op8_poisson_mix": mixture,
    "op9_benchmark_hits": benchmark_hits,
    "op10_near_duplicates": near_duplicate_classes,
    "op11_importance_sample": importance_sample,
    "op12_filter_audit": filter_audit,
    "op13_suffix_dedup": repeated_bytes,
}
