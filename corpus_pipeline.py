"""The pipeline over training documents: stages that each work on all rows the one before has kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and
reads again for the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from merchweave.llm import exact_dedup, mixing, packing, simhash, toxicity
from merchweave.llm.common import documents, small_batches
from merchweave.session import staged


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    small_batches(spark)
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject(docs, chain)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the largest id of every group of equal texts."""
    return exact_dedup.deduplicate(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near-duplicates."""
    small_batches(spark)
    return simhash.deduplicate(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics have their target weights."""
    return mixing.sample(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in the training sequences."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("simhash", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# Models, fingerprints and tokenizers have no SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
