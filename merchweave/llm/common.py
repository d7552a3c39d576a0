"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchweave.session import arrow_rows, partitions  # noqa: F401

ASCII_SPACE = r"[\x20\x09-\x0D]"
BATCH = 1000  # whole texts that go to a Python worker at a time


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Whole texts are large rows, so fewer of them than Spark's default travel to Python at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))


def let(value: str, name: str, body: str) -> str:
    """SQL text that evaluates ``value`` once and uses it as ``name`` in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def aside(df: DataFrame, taken: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the columns renamed that are called like one in ``taken``, and the names to give back."""
    reserved, mark = {t.lower() for t in taken}, "__aside"
    while any(c.lower().startswith(mark) for c in df.columns):
        mark += "_"
    back = {f"{mark}{i}": c for i, c in enumerate(df.columns) if c.lower() in reserved}
    return df.withColumnsRenamed({c: n for n, c in back.items()}), back


def n_words(text: str) -> Column:
    """Words between ASCII white space; NULL counts as empty."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_bits(value: Column, digits: int) -> Column:
    """The first ``digits`` (15 at most) hex digits of the MD5 as a number; any SQL engine can repeat it."""
    return F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("long")
