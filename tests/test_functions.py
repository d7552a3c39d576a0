import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from merchweave.functions import ordering, scalars
from merchweave.sources import files


def test_round_half_even_matches_numpy(spark):
    values = [0.5, 1.5, 2.5, -0.5, 4.25, 4.35, 77.70915, 1e6 + 0.00005, 3.14159]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 1, 4):
        got = [r[0] for r in df.select(scalars.round_half_even(F.col("x"), digits)).collect()]
        assert got == list(np.round(values, digits))


def test_human_size(spark):
    df = spark.createDataFrame([(0,), (1023,), (1024,), (1280,), (1536,), (1024**2,), (1024**3,), (5 * 1024**4,), (None,)], "n bigint")
    got = [r[0] for r in df.select(scalars.human_size(F.col("n"))).collect()]
    assert got == ["0.0 B", "1023.0 B", "1.0 KB", "1.2 KB", "1.5 KB", "1.0 MB", "1.0 GB", "5.0 TB", None]


def test_min_max_scaling_edge_cases(spark):
    constant = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert {r.y for r in scalars.min_max_scaled(constant, "x", "y").collect()} == {0.0}
    single = spark.createDataFrame([(7.0,)], "x double")
    assert scalars.min_max_scaled(single, "x", "y").first().y == 0.0
    nulls = spark.createDataFrame([(0.0,), (None,), (4.0,), (1.0,)], "x double")
    assert [r.y for r in scalars.min_max_scaled(nulls, "x", "y").collect()] == [0.0, None, 1.0, 0.25]


def test_elapsed_days_counts_whole_days_not_midnights(spark):
    df = spark.sql("select timestamp_ntz'2024-01-02 00:10:00' a, timestamp_ntz'2024-01-01 23:50:00' b, timestamp_ntz'2024-01-01 00:10:00' c")
    got = df.select(scalars.elapsed_days(F.col("a"), F.col("b")), scalars.elapsed_days(F.col("a"), F.col("c"))).first()
    assert tuple(got) == (0, 1)


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(0.5,), (3.0,), (9.0,), (None,)], "x double")
    assert [r[0] for r in df.select(scalars.clip(F.col("x"), 1.0, 5.0)).collect()] == [1.0, 3.0, 5.0, None]


def test_source_name(spark):
    df = spark.createDataFrame([("a/b/shop_orders_dataset.csv",), ("translation.csv",), ("shop_items_v2_dataset.csv",)], "p string")
    got = [r[0] for r in df.select(scalars.source_name(F.col("p"), "shop_")).collect()]
    assert got == ["orders", "translation", "items_v2"]


def test_mode_prefers_smallest_and_first_skips_null(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (1, "b"), (2, None)], "k int, v string")
    got = {r.k: r.m for r in df.groupBy("k").agg(F.coalesce(F.mode("v", True), F.lit("unknown")).alias("m")).collect()}
    assert got == {1: "a", 2: "unknown"}


@pytest.mark.parametrize("groups", [1, 3])
def test_running_total_with_a_hot_group(spark, groups):
    """Most rows in one group; positions must run through all slices."""
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": np.where(rng.random(4000) < 0.6, 0, rng.integers(0, groups, 4000)), "v": rng.permutation(4000)})
    pdf["w"] = rng.integers(1, 5, 4000)
    got = ordering.running_total(spark.createDataFrame(pdf).repartition(5), ["v"], "w", group=["k"]).toPandas()
    pdf = pdf.sort_values(["k", "v"])
    pdf["want"] = pdf.groupby("k").w.cumsum() - pdf.w
    merged = got.merge(pdf, on=["k", "v"])
    assert len(merged) == 4000
    assert (merged.n_before == merged.want).all()
    assert (got.groupby("k").n_total.first() == pdf.groupby("k").w.sum()).all()


def test_positions_descending_with_null_group(spark):
    df = spark.createDataFrame([(None, 5, 1), (None, 5, 2), ("a", 1, 3), ("a", 9, 4)], "g string, v int, id int")
    got = ordering.positions(df, ["v", "id"], group=["g"], descending=["v"])
    assert sorted((r.id, r.position) for r in got.collect()) == [(1, 1), (2, 2), (3, 2), (4, 1)]


def test_medians_by_all_ways(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.normal(size=1001), "b": rng.integers(0, 9, 1001).astype(float)})
    pdf.loc[::7, "a"] = np.nan
    df = spark.createDataFrame(pdf).select(F.nanvl("a", F.lit(None)).alias("a"), "b", F.lit(None).cast("double").alias("c"))
    want = {"a": pdf.a.median(), "b": pdf.b.median(), "c": None}
    small = {r.column_name: r.median for r in ordering.exact_medians(df, ["a", "b", "c"]).collect()}
    counted = {r.column_name: r.median for r in ordering.medians_by_count(df, ["a", "b", "c"]).collect()}
    ranked = {r.column_name: r.median for r in ordering.medians_by_rank(df, ["a", "b", "c"]).collect()}
    assert small == want
    assert counted == want
    assert ranked == want


def test_medians_choose_a_way_per_column(spark, monkeypatch):
    monkeypatch.setattr(ordering, "TINY_DOMAIN", 5)
    monkeypatch.setattr(ordering, "SMALL_DOMAIN", 50)
    df = spark.range(301).select((F.col("id") % 3).alias("x"), (F.col("id") % 30).alias("y"), F.col("id").alias("z"))
    got = {r.column_name: r.median for r in ordering.exact_medians(df, ["x", "y", "z"]).collect()}
    pdf = df.toPandas()
    assert got == {c: pdf[c].median() for c in "xyz"}


def test_ranked_values_give_pandas_ranks(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": range(500), "v": rng.integers(0, 40, 500).astype(float)})
    ranks = ordering.ranked_values(spark.createDataFrame(pdf), ["v"]).toPandas().set_index("value")
    pct = pdf.v.map((ranks.n_before + (ranks.n + 1) / 2) / ranks.n_total)
    assert np.allclose(pct, pdf.v.rank(pct=True))
    low = pdf.v.map(ranks.n_total - ranks.n_before - ranks.n + 1)
    assert (low == pdf.v.rank(method="min", ascending=False)).all()


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(1000)
    a = files.sample_rows(df, 100, ["id"]).collect()
    b = files.sample_rows(df.repartition(7), 100, ["id"]).collect()
    assert len(a) == 100 and sorted(a) == sorted(b)
    assert files.sample_percent(spark.range(3), 1.0, ["id"]).count() == 1


def test_hash_bucket_is_even(spark):
    counts = spark.range(20000).groupBy(scalars.hash_bucket(F.col("id"), F.lit("x"), buckets=10).alias("b")).count().collect()
    assert len(counts) == 10 and min(c["count"] for c in counts) > 1800
