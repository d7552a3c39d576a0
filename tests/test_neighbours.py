"""The pruned search against a plain all-pairs computation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from merchweave.functions import cosine
from merchweave.operators import neighbours


def brute(vectors: dict, queries: dict, keep: int) -> dict:
    """vectors and queries: id -> {category: rating}."""

    def unit(v):
        norm = sum(x * x for x in v.values() if x > 0) ** 0.5
        return {c: x / norm for c, x in v.items() if x > 0} if norm else {}

    units = {i: unit(v) for i, v in vectors.items()}
    out = {}
    for q, v in queries.items():
        w = unit(v)
        scored = [(-round(sum(w[c] * u.get(c, 0.0) for c in w), 9), i) for i, u in units.items()]
        out[q] = [(i, -s + 0.0) for s, i in sorted(scored)[:keep]]
    return out


def as_frame(spark, vectors, ids="bigint"):
    rows = [(i, c, float(x)) for i, v in vectors.items() for c, x in v.items()]
    return spark.createDataFrame(rows, f"customer_unique_id {ids}, category_english string, rating double")


def answers(df, key="query_id"):
    return {r[key]: [(n.owner, n.similarity) for n in r.neighbours] for r in df.collect()}


def random_vectors(seed, users, categories, hot):
    rng = np.random.default_rng(seed)
    out = {}
    for u in range(users):
        if rng.random() < hot:
            out[u] = {"c00": 5.0, "c01": 3.0}  # one profile shared by very many
            continue
        chosen = rng.choice(categories, rng.integers(1, 5), replace=False)
        out[u] = {f"c{c:02d}": float(rng.integers(0, 6)) for c in chosen}
    return out


@pytest.mark.parametrize("seed, hot, keep, block", [(1, 0.0, 6, 7), (2, 0.4, 6, 30), (3, 0.2, 40, 7), (4, 0.1, 6, 2048)])
def test_profile_search_equals_all_pairs(spark, monkeypatch, seed, hot, keep, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)  # many blocks per cell
    monkeypatch.setattr(neighbours, "ROWS_PER_TASK", 16)  # and several tasks
    vectors = random_vectors(seed, 220, 9, hot)
    profiles = neighbours.build_profiles(as_frame(spark, vectors), keep)
    lists = answers(neighbours.nearest(neighbours.profile_queries(profiles), profiles))
    want = brute(vectors, vectors, keep)
    owners = {r.owner: r.profile_id for r in neighbours.profile_of_owner(profiles).collect()}
    assert set(owners) == set(vectors)
    for u in vectors:
        assert lists[owners[u]] == want[u]


def test_owner_lists_drop_self_by_id(spark):
    vectors = random_vectors(5, 80, 5, 0.5)
    profiles = neighbours.build_profiles(as_frame(spark, vectors), 4)
    got = answers(neighbours.owner_neighbours(profiles, 3), "customer_unique_id")
    want = brute(vectors, vectors, 80)
    for u in vectors:
        assert got[u] == [x for x in want[u] if x[0] != u][:3]


def test_zero_profile_lonely_user_and_short_lists(spark):
    vectors = {1: {"a": 5.0}, 2: {"a": 1.0, "b": 1.0}, 3: {"z": 4.0}, 4: {"a": 0.0}}
    profiles = neighbours.build_profiles(as_frame(spark, vectors), 10)
    lists = answers(neighbours.nearest(neighbours.profile_queries(profiles), profiles))
    assert lists[1] == [(1, 1.0), (2, 0.707106781), (3, 0.0), (4, 0.0)]
    assert lists[3] == [(3, 1.0), (1, 0.0), (2, 0.0), (4, 0.0)]
    assert lists[4] == [(1, 0.0), (2, 0.0), (3, 0.0), (4, 0.0)]


def test_requests_with_text_ids(spark):
    vectors = {f"u{i:03d}": v for i, v in random_vectors(8, 60, 6, 0.2).items()}
    profiles = neighbours.build_profiles(as_frame(spark, vectors, "string"), 5)
    asked = spark.createDataFrame([("r1", "c00"), ("r1", "c03"), ("r1", "nope"), ("r2", "c05")], "request_id string, category string")
    queries = neighbours.request_queries(asked, profiles).drop("entries")
    want = brute(vectors, {"r1": {"c00": 5.0, "c03": 5.0}, "r2": {"c05": 5.0}}, 5)
    assert answers(neighbours.nearest(queries, profiles)) == want


def test_cell_bound_is_never_too_low():
    rng = np.random.default_rng(4)
    vectors = rng.random((400, 6)) * (rng.random((400, 6)) < 0.5)
    vectors = vectors[vectors.sum(axis=1) > 0]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    bounds = cosine.cell_bounds(vectors)
    cells = vectors.argmax(axis=1)
    sims = vectors @ vectors.T
    for c in range(6):
        assert (sims[:, cells == c].max(axis=1) <= bounds[:, c] + 1e-12).all()
    # The bound of a query's own cell is 1, and some cells can be skipped.
    assert np.allclose(bounds[np.arange(len(cells)), cells], 1.0)
    assert (bounds < 0.8).any()


def test_kth_similarity_counts_shared_profiles():
    sims = np.array([[0.9, 0.5, 0.7], [0.1, 0.2, 0.0]])
    assert list(cosine.kth_similarity(sims, np.array([2, 5, 1]), 3)) == [0.7, 0.2]
    assert list(cosine.kth_similarity(sims, np.array([1, 1, 1]), 4)) == [0.0, 0.0]


def test_hot_profile_sends_few_rows(spark):
    """Equal users collapse to one profile that keeps only the owners a list can use."""
    same = pd.DataFrame({"customer_unique_id": range(3000), "category_english": "a", "rating": 5.0})
    more = pd.DataFrame({"customer_unique_id": range(3000, 3020), "category_english": "b", "rating": 1.0})
    profiles = neighbours.build_profiles(spark.createDataFrame(pd.concat([same, more])), 6)
    table = profiles.table.select("profile_id", F.size("owners").alias("n")).collect()
    assert sorted(tuple(r) for r in table) == [(0, 6), (3000, 6)]
