"""Gaps, splits, exact selection and distances against plain Python."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchweave.functions.selection import first_by_hash, nth_smallest
from merchweave.operators import places, timing
from merchweave.sources import files

START = datetime(2020, 1, 1)


def purchases(n=900, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        user = "hot" if i % 3 == 0 else f"u{int(rng.integers(0, 60))}"  # a third of the rows
        out.append((user, i, START + timedelta(seconds=int(rng.integers(0, 5000)) * 37)))
    return [*out, out[5], (None, 10**6, START), ("u1", 10**6 + 1, None)]


def plain_gaps(rows):
    by = {}
    for user, order, at in {r for r in rows if None not in r}:
        by.setdefault(user, []).append((at, order))
    out = []
    for user, found in by.items():
        found.sort()
        for (a, p), (b, o) in zip(found, found[1:], strict=False):
            out.append((user, o, p, float(np.rint((b - a).total_seconds() / 86400 * 1e6) / 1e6)))
    return sorted(out)


@pytest.mark.parametrize("hot", [10**6, 100, 1])
def test_gaps_of_users_of_any_size(spark, hot):
    frame = spark.createDataFrame(purchases(), "u string, o long, t timestamp_ntz").repartition(5)
    got = timing.repeat_gaps(frame, "u", "o", "t", hot=hot)
    assert got.columns == ["u", "o", "previous_o", "gap_days"]
    assert sorted(map(tuple, got.collect())) == plain_gaps(purchases())


def test_gaps_of_nobody(spark):
    assert timing.repeat_gaps(spark.createDataFrame([], "u string, o long, t timestamp_ntz"), "u", "o", "t").count() == 0


@pytest.mark.parametrize("share", [0.0, 0.5, 0.8, 1.0])
def test_temporal_split_keeps_moments_together(spark, share):
    rows = purchases()
    got = timing.temporal_split(spark.createDataFrame(rows, "u string, o long, t timestamp_ntz"), "t", share).collect()
    assert len(got) == len(rows)
    times = sorted(r.t for r in got if r.t)
    cut = times[max(1, math.ceil(len(times) * share)) - 1]
    assert all(r.split == (None if r.t is None else "train" if r.t <= cut else "test") for r in got)


def test_temporal_split_of_nothing(spark):
    for data in ([], [(None,), (None,)]):
        got = timing.temporal_split(spark.createDataFrame(data, "t timestamp_ntz"), "t").collect()
        assert [r.split for r in got] == [None] * len(data)


@pytest.mark.parametrize("buckets", [2, 7, 4096])
def test_nth_smallest(spark, buckets):
    rng = np.random.default_rng(buckets)
    values = [*rng.integers(-(2**62), 2**62, 200).tolist(), *[5] * 60, *range(-20, 20), -(2**63), 2**63 - 1]
    frame = spark.createDataFrame([(int(v),) for v in values] + [(None,)], "v long").repartition(3)
    ordered = sorted(values)
    for n in (1, 2, 150, len(values) - 1, len(values)):
        assert nth_smallest(frame, "v", n, buckets) == ordered[n - 1]
    assert nth_smallest(frame, "v", 0, buckets) is None and nth_smallest(frame, "v", len(values) + 1, buckets) is None


def test_first_by_hash_takes_exactly_n_without_a_range_shuffle(spark):
    frame = spark.range(5000).withColumn("h", F.md5((F.col("id") % 700).cast("string")))
    want = sorted((r.h, r.id) for r in frame.collect())
    for n in (0, 1, 1234, 4999, 5000, 9000):
        got = first_by_hash(frame, "h", ["id"], n)
        assert sorted((r.h, r.id) for r in got.collect()) == want[:n]
    plan = files.sample_rows(frame, 1000, ["id"])._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan


def test_haversine_and_bands(spark):
    one = spark.range(1).select(
        places.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)).alias("quarter"),
        places.haversine_km(F.lit(-23.55), F.lit(-46.63), F.lit(-22.91), F.lit(-43.17)).alias("near"),
        places.haversine_km(F.lit(10.0), F.lit(20.0), F.lit(10.0), F.lit(20.0)).alias("same"),
    ).first()
    assert one.quarter == pytest.approx(math.pi / 2 * 6371) and one.same == 0.0 and one.near == pytest.approx(360.7, abs=0.5)
    got = spark.createDataFrame([(99.9,), (100.0,), (6000.0,), (None,)], "km double").select(places.band(F.col("km")))
    assert [r[0] for r in got.collect()] == ["0-100", "100-500", "5000+", "unknown"]


def test_distances_of_lines(spark):
    items = spark.createDataFrame([(1, 7), (1, 8), (2, 7), (3, 9)], "order_id long, seller_id long")
    orders = spark.createDataFrame([(1, 1), (2, 2), (3, 1)], "order_id long, customer_id long")
    people = spark.createDataFrame(
        [(1, "SP", "a"), (2, "RJ", "b")], "customer_id long, customer_state string, customer_zip_code_prefix string"
    )
    sellers = spark.createDataFrame([(7, "a"), (8, "b"), (9, "none")], "seller_id long, seller_zip_code_prefix string")
    points = spark.createDataFrame(
        [("a", 0.0, -40.0), ("a", -2.0, -40.0), ("a", 80.0, 80.0), ("b", -1.0, -49.0)],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double",
    )
    got = {
        (r.customer_state, r.distance_band): (r.n_lines, r.mean_km)
        for r in places.distance_bands(items, orders, people, sellers, points).collect()
    }
    km = 2 * 6371 * math.asin(math.sqrt(math.cos(math.radians(-1)) ** 2 * math.sin(math.radians(4.5)) ** 2))
    assert got == {
        ("SP", "0-100"): (1, 0.0),
        ("SP", "1000-2500"): (1, round(km, 3)),
        ("SP", "unknown"): (1, None),
        ("RJ", "1000-2500"): (1, round(km, 3)),
    }


def test_regional_preferences(spark):
    rows = [("SP", "x")] * 6 + [("SP", "y")] * 2 + [("RJ", "y")] * 4 + [(None, "x"), ("SP", None)]
    got = places.regional_preferences(spark.createDataFrame(rows, "s string, c string"), "s", "c").collect()
    assert {(r.s, r.c): (r.n_lines, r["rank"], r.region_share, r.preference) for r in got} == {
        ("SP", "x"): (6, 1, 0.75, 1.5),
        ("SP", "y"): (2, 2, 0.25, 0.5),
        ("RJ", "y"): (4, 1, 1.0, 2.0),
    }
