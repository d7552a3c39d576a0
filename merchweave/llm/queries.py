"""Registered queries of the operators: thin functions over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchweave.llm import (
    exact_dedup,
    fingerprints,
    hard_negatives,
    language_model,
    line_dedup,
    mixing,
    packing,
    phrases,
    quality_cascade,
    sharding,
    simhash,
    token_files,
    toxicity,
)
from merchweave.llm.common import documents

SHARD_BYTES = 1 << 20

REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTERED[f.__name__] = f
    return f


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, chain)


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    sizes = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return sharding.shard(sizes, SHARD_BYTES, size="n_bytes")


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.text_groups(documents(spark, sf_dir))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.judge(documents(spark, sf_dir).select("doc_id", "source", "lang", "text")).select(
        "doc_id",
        "source",
        "lang",
        F.col("__topic").alias("topic"),
        F.col("__tokens").alias("tokens"),
        F.round("__probability", 6).alias("probability"),
        F.col("__kept").alias("kept"),
    )


@query
def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(documents(spark, sf_dir))


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.new_path(spark)
    token_files.write(documents(spark, sf_dir), path)
    return token_files.summary(spark, path)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(documents(spark, sf_dir)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text("f").alias("fingerprint"),
        fingerprints.as_text("edited_f").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


@query
def op11_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return quality_cascade.measures(docs, quality_cascade.plan(docs))


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(documents(spark, sf_dir))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels shifted for every seventh id, components in whole 256ths; rows with a component that is no number go."""
    finite = F.forall("embedding", lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (
        spark.read.parquet(f"{sf_dir}/embeddings.parquet")
        .filter(finite)
        .select(
            F.col("vec_id").alias("id"),
            F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
            F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("v"),
        )
    )
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)
