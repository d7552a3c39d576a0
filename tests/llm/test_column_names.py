"""Columns of the caller come back as they went in, whatever their names."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from merchweave.llm import line_dedup, mixing, sharding

NAMES = ["leaf", "fine", "depth", "__fine", "__leaf", "__gone", "__doc", "__topic", "__tokens", "__kept", "__cell_lang", "__aside0"]


@pytest.fixture(scope="module")
def named(spark):
    rows = spark.range(300).select(
        F.col("id").alias("doc_id"),
        F.concat(F.repeat(F.lit("word "), (F.col("id") % 50 + 1).cast("int")), F.lit("\nA line of forty code points and some more of them.")).alias("text"),
        F.when(F.col("id") % 3 > 0, "en").alias("lang"),
        F.concat(F.lit("s"), F.col("id") % 2).alias("source"),
    )
    return rows.withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in NAMES})


def values(df):
    return Counter((r.doc_id, *[r[n] for n in NAMES]) for r in df.collect())


@pytest.mark.parametrize("operator", [lambda d: sharding.shard(d, 500), line_dedup.deduplicate])
def test_names_of_the_caller(named, operator):
    got = operator(named)
    assert got.columns[: len(named.columns)] == named.columns and values(got) == values(named)


def test_names_of_the_caller_in_a_sample(named):
    got = mixing.sample(named)
    assert got.columns == named.columns and 0 < got.count() < 300
    assert not values(got) - values(named)


def test_shards_are_those_of_the_plain_rows(named):
    plain = named.select("doc_id", "text")
    mine = sharding.shard(named, 500).select("doc_id", "shard", "shard_bytes")
    assert Counter(mine.collect()) == Counter(sharding.shard(plain, 500).select("doc_id", "shard", "shard_bytes").collect())


def test_one_id_holds_a_third_of_the_rows(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("x" * 20).alias("text"))
    got = sharding.shard(rows, 400).collect()
    held = Counter(r.shard for r in got)
    assert len(got) == 3000 and all(r.shard_bytes == 20 * held[r.shard] <= 400 for r in got)
    names = set(held)
    assert not any(n[:k] in names for n in names for k in range(len(n)))
    # A shard's parent would not fit.
    parents = Counter()
    for n, c in held.items():
        for k in range(len(n)):
            parents[n[:k]] += c
    assert all(parents[n[:-1]] * 20 > 400 for n in names)
