"""Partners in baskets against plain counting."""

from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from merchweave.operators import cooccurrence as co


def plain(lines, k):
    baskets = {}
    for b, i in lines:
        if b is not None and i is not None:
            baskets.setdefault(b, set()).add(i)
    alone = Counter(i for s in baskets.values() for i in s)
    both = Counter(p for s in baskets.values() for p in permutations(s, 2))
    by_item = {}
    for (a, b), n in both.items():
        by_item.setdefault(a, []).append((-n, b))
    out = []
    for a, found in by_item.items():
        for rank, (n, b) in enumerate(sorted(found)[:k], 1):
            total = len(baskets)
            out.append((a, rank, b, -n, round(-n / total, 9), round(-n / alone[a], 9), round(-n * total / (alone[a] * alone[b]), 9)))
    return sorted(out)


def orders(seed=1, n=300, items=40):
    rng = np.random.default_rng(seed)
    out = [(int(b), f"i{min(int(rng.zipf(1.5)), items)}") for b in rng.integers(0, n, 6 * n)]
    out += [(b, "everywhere") for b in range(0, n, 3)]  # a third of all baskets
    return [*out, (None, "i1"), (5, None), (10**6, "alone"), *out[:20]]


@pytest.mark.parametrize("k,pairs,chunk", [(10, 10**6, 256), (3, 50, 4), (1000, 7, 2)])
def test_equals_plain_counting(spark, k, pairs, chunk):
    lines = orders()
    frame = spark.createDataFrame(lines, "order_id long, product_id string").repartition(5)
    got = co.bought_together(frame, "order_id", "product_id", k, pairs, chunk)
    assert got.columns == ["product_id", "rank", "partner", "n_both", "support", "confidence", "lift"]
    for a, b in zip(sorted(map(tuple, got.collect())), plain(lines, k), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], abs=2e-9)


def test_an_order_of_5000_items(spark):
    lines = [(0, i) for i in range(5000)] + [(1, i) for i in range(0, 50)] + [(2, i) for i in range(0, 3)]
    frame = spark.createDataFrame(lines, "o long, p long").repartition(4)
    got = co.bought_together(frame, "o", "p", k=3, pairs=1_000_000).collect()
    assert len(got) == 15_000
    by = {(r.p, r["rank"]): (r.partner, r.n_both) for r in got}
    assert by[0, 1] == (1, 3) and by[0, 2] == (2, 3) and by[0, 3] == (3, 2)
    assert by[4999, 1] == (0, 1) and by[4999, 3] == (2, 1)


def test_no_row_per_pair_leaves_a_task(spark):
    """What the counting step gives is k rows for each item and slice at most."""
    lines = [(b, i) for b in range(20) for i in range(60)]
    dealt = spark.createDataFrame(
        [(0, 0, [i for i in range(60)], [i for i in range(60)]) for _ in range(20)],
        "block long, slice long, own array<long>, partners array<long>",
    )
    assert co.partner_counts(dealt, "bigint", 2).count() == 120
    assert co.bought_together(spark.createDataFrame(lines, "o long, p long"), "o", "p", 2).count() == 120


def test_without_pairs(spark):
    for data in ([], [(1, 1), (2, 2)], [(None, 1), (1, None)]):
        assert co.bought_together(spark.createDataFrame(data, "o long, p long"), "o", "p").collect() == []


def test_counts_are_added_up_when_many(monkeypatch):
    monkeypatch.setattr(co, "HELD", 10)
    counts = co.PairCounts()
    for _ in range(5):
        counts.add([[1, 2, 3], [4]], [[1, 2, 3], [1, 4]])
    items, partners, n = counts.best(1)
    assert list(zip(items, partners, n.tolist(), strict=True)) == [(1, 2, 5), (2, 1, 5), (3, 1, 5), (4, 1, 5)]


@pytest.mark.parametrize("k,pairs,chunk,few", [(10, 10**6, 256, 0), (3, 50, 4, 0), (1000, 7, 2, 0), (3, 50, 4, 100)])
def test_blocks_and_few_items_give_the_same(spark, k, pairs, chunk, few):
    lines = orders(seed=2)
    frame = spark.createDataFrame(lines, "order_id long, product_id string").repartition(5)
    got = co.bought_together(frame, "order_id", "product_id", k, pairs, chunk, few)
    for a, b in zip(sorted(map(tuple, got.collect())), plain(lines, k), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], abs=2e-9)


def test_few_items_are_not_dealt_to_blocks(spark, monkeypatch):
    """With few items every item has very many pairs, and each slice of an item got all its baskets."""
    monkeypatch.setattr(co, "partner_counts", None)
    frame = spark.createDataFrame([(b, i) for b in range(20) for i in range(4)], "o long, p long")
    assert co.bought_together(frame, "o", "p", 2, pairs=5).count() == 8
