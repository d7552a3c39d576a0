"""Hard negatives against all pairs in plain Python, over many small tiles."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchweave.llm import hard_negatives as hard
from merchweave.llm.oracle import STATEMENTS
from merchweave.llm.queries import REGISTERED
from tools.check import compare, connect

SCHEMA = "id bigint, label int, v array<bigint>, tile int, aid string, score double"


def rows(seed=1, n=400, width=6, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-60, 60, (labels, width))
    out = []
    for i in range(n):
        label = int(rng.integers(0, labels)) if i % 3 else 0  # one label holds a third of the rows and more
        v = (centres[label] + rng.integers(-40, 40, width)).tolist()
        out.append((i, label, [5] * width if i % 5 == 2 else v, 7, "x", None))  # and one vector a fifth
    out += [(n, None, [1] * width, 7, "x", None), (n + 1, 1, None, 7, "x", None), (None, 1, [9] * width, 7, None, None)]
    out += [(n + 2, 1, [1, None, *[2] * (width - 2)], 7, "x", None), (n + 3, 1, [3, 4], 7, "x", None), (n + 4, 2, [], 7, "x", None)]
    return [*out, out[0], out[20], out[20], (0, 3, out[0][2], 7, "x", None)]  # repeated rows; an id under two labels


def plain(data, every=20, low=80, high=100, k=5):
    width = max((len(v) for i, lab, v, *_ in data if v and None not in v and None not in (i, lab)), default=0)
    known = {
        (i, lab, tuple(v) + (0,) * (width - len(v)))
        for i, lab, v, *_ in data
        if i is not None and lab is not None and v is not None and None not in v
    }
    out = []
    for i, lab, v in sorted(known):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, l) for j, l, w in known if j != i)
        for s, p, _ in [x for x in scored if x[2] == lab][:k]:
            fits = [x for x in scored if x[2] != lab and -low * s <= -100 * x[0] <= -high * s][:k]
            out += [(i, p, r, j, -s, -t) for r, (t, j, _) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize(
    "seed,width,size,low,high,k", [(1, 6, 10_000, 80, 100, 5), (2, 6, 40, 80, 100, 5), (3, 3, 25, -50, 90, 2), (4, 12, 9, 0, 120, 8)]
)
def test_equal_all_pairs(spark, monkeypatch, seed, width, size, low, high, k):
    monkeypatch.setattr(hard, "SLICES", 3)  # several levels of tiles
    data = rows(seed, width=width)
    frame = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = hard.mine(frame, F.col("id") % 20 == 0, n_positives=k, n_negatives=k, low=low, high=high, size=size)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain(data, low=low, high=high, k=k)
    assert sorted(map(tuple, got.collect())) == want and want


def test_tiles_hold_about_their_size_whatever_is_common(spark, monkeypatch):
    monkeypatch.setattr(hard, "SLICES", 4)
    frame = spark.range(4000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("label"),
        F.array(F.lit(1), F.col("id") % 2).cast("array<bigint>").alias("v"),
    )
    tiled, n = hard.tiles(frame, 100)
    sizes = [r["count"] for r in tiled.groupBy("tile").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 200 and n >= 40


def test_tree_boxes_hold_their_rows_and_searches_skip_leaves():
    rng = np.random.default_rng(5)
    centres = rng.integers(-300, 300, (8, 16))
    labels = rng.integers(0, 8, 5000)
    points = (centres[labels] + rng.integers(-9, 9, (5000, 16))).astype(float)
    tree = hard.Tree(np.arange(5000), labels, points)
    assert sorted(tree.ids.tolist()) == list(range(5000))
    for level, (low, high, *_) in enumerate(tree.levels):
        step = hard.LEAF * hard.FANOUT**level
        for i in range(len(low)):
            inside = tree.points[i * step : (i + 1) * step]
            assert (inside.min(axis=0) == low[i]).all() and (inside.max(axis=0) == high[i]).all()
    one = hard.Search(tree, -1, int(labels[0]), points[0])
    scores = points @ points[0]
    want = sorted((-int(s), i) for i, s in enumerate(scores) if labels[i] == labels[0])[:5]
    assert one.best(5, True) == [(-s, i) for s, i in want]
    assert len(one.scores) < 0.3 * math.ceil(5000 / hard.LEAF)  # leaves that were multiplied


def test_scores_beyond_doubles_and_beyond_long(spark):
    big = 1 << 27
    data = [(i, i % 2, [big - i, big + i], None, None, None) for i in range(40)]
    got = hard.mine(spark.createDataFrame(data, SCHEMA), F.col("id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == plain(data)
    with pytest.raises(ValueError, match="64 bits"):
        hard.mine(spark.createDataFrame([(0, 1, [1 << 40], None, None, None)], SCHEMA), F.lit(True))


@pytest.mark.parametrize("data", [[], [(1, None, None, 1, None, None)], [(0, 1, [], 1, None, None), (1, 2, [], 1, None, None)]])
def test_empty_tables(spark, data):
    frame = spark.createDataFrame(data, SCHEMA)
    assert hard.mine(frame, F.col("id") % 20 == 0).collect() == []


def test_query_equals_sql(spark):
    name, sf = "op13_hard_negatives", "/root/testdata/sf0.001"
    result, n = compare(name, REGISTERED[name](spark, sf), connect(sf), STATEMENTS[name])
    assert result == "ok" and n > 0
