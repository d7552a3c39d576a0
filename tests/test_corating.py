"""The pruned item search against a plain all-pairs computation."""

from collections import defaultdict

import numpy as np
import pytest

from merchweave.operators import corating


def ratings_with_hot_users(seed, users, items, hot_share):
    """A few users rated a large share of all products; many products have one rater only."""
    rng = np.random.default_rng(seed)
    out = {}
    for i in range(items):
        raters = set(rng.integers(3, users, rng.integers(0, 4)).tolist())
        raters |= {h for h in range(3) if rng.random() < hot_share}
        for u in raters:
            out[int(u), i] = float(rng.integers(0, 11)) / 2
    return out


def unit(ratings):
    by_item = defaultdict(dict)
    for (u, i), r in ratings.items():
        if r > 0:
            by_item[i][u] = r
    return {i: {u: r / sum(x * x for x in v.values()) ** 0.5 for u, r in v.items()} for i, v in by_item.items()}


def brute_neighbours(ratings, k):
    units = unit(ratings)
    out = {}
    for i, v in units.items():
        sims = [(round(sum(w * units[j].get(u, 0.0) for u, w in v.items()), 9), j) for j in units if j != i]
        out[i] = sorted(((-s, j) for s, j in sims if s > 0))[:k]
    return {i: [(j, -s) for s, j in x] for i, x in out.items()}


def frame(spark, ratings):
    rows = [(u, i, r) for (u, i), r in ratings.items()]
    return spark.createDataFrame(rows, "customer_unique_id bigint, product_id bigint, rating double")


@pytest.mark.parametrize("seed, hot, k", [(1, 0.3, 5), (2, 0.7, 8), (3, 0.0, 40)])
def test_item_neighbours_equal_all_pairs(spark, seed, hot, k):
    ratings = ratings_with_hot_users(seed, 40, 150, hot)
    got = defaultdict(list)
    for r in sorted(corating.item_neighbours(frame(spark, ratings), k=k).collect(), key=lambda r: r.place):
        got[r.product_id].append((r.neighbour_id, r.similarity))
    want = {i: x for i, x in brute_neighbours(ratings, k).items() if x}
    assert set(got) == set(want)
    for i in want:
        assert np.allclose([s for _, s in got[i]], [s for _, s in want[i]], atol=1.5e-9)
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]]


def test_pairs_of_a_hot_user_are_pruned(spark):
    """One user rated everything: far fewer pairs are formed than there are products squared."""
    ratings = {(0, i): 4.0 for i in range(400)}
    ratings |= {(1 + i, i): 1.0 + i % 4 for i in range(0, 400, 2)}
    vectors = corating.unit_vectors(frame(spark, ratings))
    member, owners = corating._profiles(vectors, 6)
    assert owners.count() == 201  # all products only the hot user rated are one profile
    entries = corating._entries(vectors, owners)
    best = corating._best_of_user(entries, 6)
    pairs = corating._pairs(entries, entries.select("p").distinct(), best, corating._floors(entries, best, 6))
    assert pairs.count() <= 201 * 6


def test_predictions(spark):
    train = {(1, 10): 4.0, (1, 11): 2.0, (2, 10): 5.0, (2, 12): 3.0, (3, 13): 0.0, (4, 14): 1.0}
    pairs = [(1, 12), (2, 11), (3, 10), (4, 13), (9, 13), (2, 14)]
    got = {
        (r.customer_unique_id, r.product_id): r.pred_rating
        for r in corating.predict_from_neighbours(
            spark.createDataFrame(pairs, "customer_unique_id bigint, product_id bigint"), frame(spark, train), 40
        ).collect()
    }
    near = brute_neighbours(train, 40)
    overall = sum(train.values()) / len(train)
    for u, i in pairs:
        weight = sum(s for _, s in near.get(i, []))
        mine = [r for (v, _), r in train.items() if v == u and r > 0]
        if weight > 1e-9:
            want = sum(s * train.get((u, j), 0.0) for j, s in near[i]) / (weight + 1e-9)
        else:
            want = sum(mine) / len(mine) if mine else overall
        assert abs(got[u, i] - min(max(want, 1.0), 5.0)) < 1e-6
