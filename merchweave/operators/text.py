"""TF-IDF of product text and the similarity of products by it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchweave.functions.scalars import round_half_even
from merchweave.session import staged

# Words of two or more letters or digits, in any script.
WORD = r"[\p{L}\p{N}_]{2,}"
MAX_TERMS = 1000


# Very frequent English words, for callers that want a short list of their own.
COMMON_WORDS = (
    "a an and are as at be but by for from had has have he her his i if in is it its not of on or she "
    "that the their them they this to was we were which will with you"
).split()


def default_stop_words() -> list[str]:
    """The English list that comes with Spark ML."""
    return StopWordsRemover.loadDefaultStopWords("english")


def words_of(docs: DataFrame, key: str, text: str, stop_words: Sequence[str] | None = None) -> DataFrame:
    """(key, term): one row per word of the whole text of every row."""
    stop = list(default_stop_words() if stop_words is None else stop_words)
    words = docs.select(
        key, F.explode(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))).alias("term")
    )
    return words.filter(~F.col("term").isin(stop)) if stop else words


def term_counts(words: DataFrame, key: str) -> DataFrame:
    """(key, term, tf)"""
    return words.groupBy(key, "term").agg(F.count("*").alias("tf"))


def vocabulary(words: DataFrame, max_terms: int = MAX_TERMS) -> DataFrame:
    """The most frequent terms over all rows; ties by term. Each task sends one row per term."""
    totals = words.groupBy("term").agg(F.count("*").alias("total"))
    return totals.orderBy(F.desc("total"), "term").limit(max_terms).select("term")


def tfidf(
    docs: DataFrame, key: str, text: str, max_terms: int = MAX_TERMS, stop_words: Sequence[str] | None = None
) -> DataFrame:
    """Unit-length weights tf * (ln((1 + n) / (1 + df)) + 1) per row and term of the vocabulary."""
    words = words_of(docs, key, text, stop_words)
    terms = staged(vocabulary(words, max_terms), "vocabulary")
    # Only words of the vocabulary are counted by row, and these counts are read for the rest.
    counts = staged(term_counts(words.join(terms, "term"), key), "term-counts")
    rows = docs.agg(F.count("*")).scalar().cast("double")
    used = counts.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log((F.lit(1.0) + rows) / (F.lit(1.0) + F.col("df").cast("double"))) + F.lit(1.0)
    raw = counts.join(used, "term").withColumn("raw", F.col("tf") * idf)
    norms = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    return raw.join(norms, key).select(
        key, "term", F.col("tf"), round_half_even(F.col("raw") / F.col("norm"), 9).alias("weight")
    )
