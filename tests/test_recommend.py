import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchweave.operators import metrics, ratings, recommend
from tests.test_neighbours import brute


def random_training(seed, users=40, items=60, categories=7):
    rng = np.random.default_rng(seed)
    category = {p: f"c{p % categories}" for p in range(items)}
    rows = []
    for u in range(users):
        for p in rng.choice(items, rng.integers(2, 7), replace=False):
            rows.append((u, int(p), category[int(p)], float(rng.integers(0, 11)) / 2))
    return rows


@pytest.fixture(params=[1])
def world(request, spark):
    rows = random_training(request.param)
    training = spark.createDataFrame(
        rows, "customer_unique_id bigint, product_id bigint, category_english string, rating double"
    )
    return rows, training, recommend.train_grid(training, training)


def python_grid(rows):
    cells, cats = defaultdict(list), defaultdict(set)
    for u, _, c, r in rows:
        cells[u, c].append(r)
        cats[u].add(c)
    grid = defaultdict(dict)
    for (u, c), rs in cells.items():
        if len(cats[u]) >= 2:
            grid[u][c] = sum(rs) / len(rs)
    return dict(grid)


def mean_ratings(rows):
    by_item = defaultdict(list)
    for _, p, c, r in rows:
        by_item[p].append(r)
    return {p: sum(rs) / len(rs) for p, rs in by_item.items()}


def python_recommendations(rows, profile, seen, grid, n):
    """One user or request, step by step."""
    cats = sorted({c for v in grid.values() for c in v})
    near = [u for u, _ in brute(grid, {"q": profile}, 100)["q"]]
    share = {c: sum(grid[u].get(c, 0) > 0 for u in near) / len(near) * 100 for c in cats}
    owned = {c for c, r in profile.items() if r > 0}
    best = sorted((c for c in cats if c not in owned), key=lambda c: (-share[c], c))[: 2 * n]
    means, category = mean_ratings(rows), {p: c for _, p, c, _ in rows}
    found = []
    for c in best:
        items = sorted((p for p in means if category[p] == c and p not in seen), key=lambda p: (-means[p], p))[:2]
        found += [(p, means[p] + share[c] / 100, share[c]) for p in items]
    found.sort(key=lambda x: (-x[1], -x[2], x[0]))
    return [(p, round(s, 6)) for p, s, _ in found[:n]]


def collected(df, key):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out[r[key]].append((r.product_id, r.score))
    return out


def close(got, want):
    assert [p for p, _ in got] == [p for p, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], atol=1e-4)


def test_recommend_users(world):
    rows, training, grid = world
    py_grid = python_grid(rows)
    bought = defaultdict(set)
    for u, p, _, _ in rows:
        bought[u].add(p)
    got = collected(recommend.recommend_users(training, grid, 4), "customer_unique_id")
    for u, profile in py_grid.items():
        close(got[u], python_recommendations(rows, profile, bought[u], py_grid, 4))


def test_recommend_users_with_exclusions(spark, world):
    rows, training, grid = world
    py_grid = python_grid(rows)
    means = mean_ratings(rows)
    best = sorted(means, key=lambda p: (-means[p], p))[:12]
    user = next(iter(py_grid))
    exclude = spark.createDataFrame([(user, p) for p in best], "customer_unique_id bigint, product_id bigint")
    only = spark.createDataFrame([(user,), (-1,)], "customer_unique_id bigint")
    got = collected(recommend.recommend_users(training, grid, 4, exclude, only), "customer_unique_id")
    seen = {p for u, p, _, _ in rows if u == user} | set(best)
    assert set(got) == {user}  # a user outside the grid gets no list
    close(got[user], python_recommendations(rows, py_grid[user], seen, py_grid, 4))


def test_recommend_categories_and_fallback(spark, world):
    rows, training, grid = world
    py_grid = python_grid(rows)
    asked = [("r1", "c1"), ("r2", "c1"), ("r2", "c3"), ("r2", "nope"), ("r3", "nope"), ("r4", "c1")]
    requests = spark.createDataFrame(asked, "request_id string, category string")
    df = recommend.recommend_categories(requests, training, grid, 5)
    kinds = {r.request_id: r.recommendation_type for r in df.collect()}
    assert kinds == {"r1": "KNN", "r2": "KNN", "r3": "rank_based", "r4": "KNN"}
    got = collected(df, "request_id")
    close(got["r1"], python_recommendations(rows, {"c1": 5.0}, set(), py_grid, 5))
    close(got["r2"], python_recommendations(rows, {"c1": 5.0, "c3": 5.0}, set(), py_grid, 5))
    assert got["r4"] == got["r1"]
    popular = {r.category_english: r.share_pct for r in recommend.popular_categories(grid).collect()}
    means, category = mean_ratings(rows), {p: c for _, p, c, _ in rows}
    top = max(popular, key=lambda c: (popular[c], -int(c[1:])))
    assert any(category[p] == top for p, _ in got["r3"])
    assert all(abs(s - means[p] - popular[category[p]] / 100) < 1e-4 for p, s in got["r3"])


def test_only_unknown_requests(spark, world):
    _, training, grid = world
    requests = spark.createDataFrame([("r1", "nope")], "request_id string, category string")
    got = recommend.recommend_categories(requests, training, grid, 3).collect()
    assert len(got) == 3 and {r.recommendation_type for r in got} == {"rank_based"}
    assert recommend.category_confidence(requests, grid).isEmpty()


def test_request_exclusions(spark, world):
    rows, training, grid = world
    requests = spark.createDataFrame([("r1", "c1")], "request_id string, category string")
    plain = collected(recommend.recommend_categories(requests, training, grid, 5), "request_id")["r1"]
    exclude = spark.createDataFrame([("r1", plain[0][0])], "request_id string, product_id bigint")
    got = collected(recommend.recommend_categories(requests, training, grid, 5, exclude), "request_id")["r1"]
    close(got, python_recommendations(rows, {"c1": 5.0}, {plain[0][0]}, python_grid(rows), 5))


def test_split_is_stable_and_near_the_share(spark):
    pairs = spark.range(20000).select(F.col("id").alias("customer_unique_id"), (F.col("id") % 7).alias("product_id"))
    a = recommend.train_test_split(pairs)
    b = recommend.train_test_split(pairs.repartition(9))
    assert a.exceptAll(b).isEmpty()
    assert abs(a.filter("split = 'train'").count() / 20000 - 0.8) < 0.01


def test_wide_grid(spark):
    grid = spark.createDataFrame([(1, "a", 4.0), (2, "b", 3.0)], "customer_unique_id int, category_english string, rating double")
    got = {r.customer_unique_id: (r.a, r.b) for r in recommend.wide_grid(grid, ["a", "b"]).collect()}
    assert got == {1: (4.0, 0.0), 2: (0.0, 3.0)}


# ---- lists of mean ratings ----


def test_top_rated_unseen_steps_over_purchases(spark, world):
    rows, training, _ = world
    means = mean_ratings(rows)
    order = sorted(means, key=lambda p: (-means[p], p))
    # One user has bought the whole head of the list.
    heavy = [(999, p, "c0", 3.0) for p in order[:25]]
    more = training.unionByName(spark.createDataFrame(heavy, training.schema))
    everything = rows + heavy
    means = mean_ratings(everything)
    order = sorted(means, key=lambda p: (-means[p], p))
    got = collected(ratings.top_rated_unseen(more, 5), "customer_unique_id")
    for u in {r[0] for r in everything}:
        seen = {p for v, p, _, _ in everything if v == u}
        assert [p for p, _ in got[u]] == [p for p in order if p not in seen][:5]


def test_content_and_hybrid(spark, world):
    rows, training, _ = world
    means, category = mean_ratings(rows), {p: c for _, p, c, _ in rows}
    users = training.select("customer_unique_id").union(spark.range(5000, 5002))
    got = collected(ratings.content_recommendations(training, users, 6), "customer_unique_id")
    counts = defaultdict(int)
    for _, p, _, _ in rows:
        counts[p] += 1
    popular = sorted(counts, key=lambda p: (-counts[p], p))[:6]
    assert [x for x in got[5000]] == [(p, 0.0) for p in popular]
    content = {}
    for u in {r[0] for r in rows}:
        seen = {p for v, p, _, _ in rows if v == u}
        liked = {c for v, _, c, r in rows if v == u and r >= 4}
        content[u] = sorted((p for p in means if category[p] in liked and p not in seen), key=lambda p: (-means[p], p))
        assert [p for p, _ in got[u]] == content[u][:6]
    hybrid = collected(ratings.hybrid_recommendations(training, 5, depth=20), "customer_unique_id")
    for u in content:
        mine = [r for r in rows if r[0] == u]
        seen = {r[1] for r in mine}
        a, b = (0.8, 0.2) if len(mine) >= 2 else (0.2, 0.8)
        total = defaultdict(float)
        for p in sorted((p for p in means if p not in seen), key=lambda p: (-means[p], p))[:20]:
            total[p] += a * means[p]
        for p in content[u][:20]:
            total[p] += b * means[p]
        want = sorted(total, key=lambda p: (-round(total[p], 9), p))[:5]
        assert [p for p, _ in hybrid[u]] == want


def test_blend_rating(spark, world):
    rows, training, _ = world
    pairs = spark.createDataFrame([(rows[0][0], rows[0][1]), (-1, rows[0][1]), (rows[0][0], -1)], "customer_unique_id bigint, product_id bigint")
    got = {(r.customer_unique_id, r.product_id): r.pred_rating for r in ratings.blend_rating(pairs, training).collect()}
    overall = np.mean([r[3] for r in rows])
    mine = np.mean([r[3] for r in rows if r[0] == rows[0][0]])
    item = np.mean([r[3] for r in rows if r[1] == rows[0][1]])
    assert math.isclose(got[rows[0][0], rows[0][1]], float(np.clip(0.6 * mine + 0.4 * item, 1, 5)), abs_tol=1e-9)
    assert math.isclose(got[-1, rows[0][1]], overall) and math.isclose(got[rows[0][0], -1], overall)


def test_dense_ids(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "x string")
    assert rows(ratings.dense_ids(df, "x")) == [("a", 0), ("b", 1), ("c", 2)]


# ---- metrics ----


def rank_frame(spark, users):
    rows = [(u, i, float(s), rel) for u, items in users.items() for i, (s, rel) in enumerate(items)]
    return spark.createDataFrame(rows, "uid string, iid int, score double, relevant int")


def test_ranking_table_by_hand(spark):
    users = {
        "mixed": [(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 1)],
        "none": [(0.9, 0), (0.8, 0)],
        "short": [(0.5, 1)],
        "all": [(0.1, 1), (0.2, 1), (0.3, 1)],
        "ties": [(0.5, 0), (0.5, 1), (0.5, 0)],
    }
    got = {(r.uid, r.k): r for r in metrics.ranking_table(rank_frame(spark, users), [2, 3]).collect()}
    assert {u for u, _ in got} == {"mixed", "short", "all", "ties"}
    m = got["mixed", 3]
    assert (m.hits, m.precision, m.recall) == (2, 2 / 3, 2 / 3)
    ideal = 1 + 1 / math.log2(3) + 0.5
    assert math.isclose(m.ndcg, 1.5 / ideal, abs_tol=1e-8)
    assert math.isclose(m.map, (1 + 2 / 3) / 3, abs_tol=1e-8)
    s = got["short", 3]
    assert (s.precision, s.recall, s.ndcg, s.map) == (1.0, 1.0, 1.0, 1.0)
    assert got["all", 2].recall == 2 / 3 and got["all", 2].ndcg == 1.0
    t = got["ties", 2]  # a tie goes to the smaller item id
    assert (t.hits, t.map) == (1, 0.5) and math.isclose(t.ndcg, 1 / math.log2(3), abs_tol=1e-8)


def test_metric_means(spark):
    preds = spark.createDataFrame(
        [("a", 1, 5.0, 0.9), ("a", 2, 1.0, 0.5), ("b", 1, 1.0, 0.9), ("b", 2, 4.0, 0.1)],
        "uid string, iid int, true_rating double, pred_rating double",
    )
    got = {(r.k, r.metric): (r.n_users, r["mean"], r["std"]) for r in metrics.ranking_metrics(preds, [1]).collect()}
    assert got[1, "precision"] == (2, 0.5, 0.5)
    errors = metrics.rating_errors(preds).first()
    gaps = np.array([4.1, 0.5, 0.1, 3.9])
    assert math.isclose(errors.rmse, np.sqrt((gaps**2).mean()), abs_tol=1e-6) and errors.mae == 2.15


def tie_averaged_ndcg(truth, score, k):
    """Mean over tie blocks, each sharing its discounts; the ideal ignores ties."""
    discounts = [1 / math.log2(i + 2) if i < k else 0.0 for i in range(len(truth))]
    total, at = 0.0, 0
    for value in sorted(set(score), reverse=True):
        block = [t for t, s in zip(truth, score, strict=True) if s == value]
        total += sum(block) / len(block) * sum(discounts[at : at + len(block)])
        at += len(block)
    ideal = sum(g * d for g, d in zip(sorted(truth, reverse=True), discounts, strict=True))
    return total / ideal if ideal else 0.0


def test_neighbour_ndcg_with_ties(spark):
    rng = np.random.default_rng(7)
    cats = [f"c{i}" for i in range(9)]
    scores, truth, want = [], [], {}
    for u in range(30):
        s = np.where(rng.random(9) < 0.4, rng.integers(1, 4, 9) / 2.0, 0.0)
        g = np.where(rng.random(9) < 0.3, rng.integers(1, 6, 9).astype(float), 0.0)
        if not g.any():
            continue
        scores += [(u, c, float(x)) for c, x in zip(cats, s, strict=True) if x > 0]
        truth += [(u, c, float(x)) for c, x in zip(cats, g, strict=True) if x > 0]
        want[u] = tie_averaged_ndcg(list(g), list(s), 5)
    score_df = spark.createDataFrame(scores, "customer_unique_id int, category_english string, score double")
    truth_df = spark.createDataFrame(truth, "customer_unique_id int, category_english string, gain double")
    got = {r.customer_unique_id: r.ndcg for r in metrics.neighbour_ndcg(score_df, truth_df, F.lit(9), 5).collect()}
    assert set(got) == set(want)
    assert all(math.isclose(got[u], want[u], abs_tol=1e-8) for u in want)


def test_neighbour_precision_recall_counts_repeats(spark):
    scores = spark.createDataFrame([(1, "b", 3.0), (1, "d", 1.0)], "customer_unique_id int, category_english string, score double")
    liked = spark.createDataFrame([(1, "b"), (1, "b"), (1, "c"), (2, "a")], "customer_unique_id int, category_english string")
    users = spark.createDataFrame([(1,)], "customer_unique_id int")
    names = F.array(*[F.lit(c) for c in "abcd"])
    got = metrics.neighbour_precision_recall(scores, liked, users, names, 3).collect()
    # Predicted: b, d, then a as the first name among the zeros.
    assert [(r.customer_unique_id, r.hits, r.n_liked, r.precision, r.recall) for r in got] == [(1, 1, 3, 1 / 3, 1 / 3)]


def test_best_models_and_success(spark):
    results = spark.createDataFrame([("x", 0.5, 1.0), ("y", 0.7, None), ("z", None, 0.9), ("a", 0.7, 2.0)], "model string, ndcg double, rmse double")
    assert tuple(metrics.best_models(results).first()) == ("a", 0.7, "z", 0.9)
    stages = spark.createDataFrame([("SUCCESS",), ("FAILED",), ("SUCCESS",)], "status string")
    assert tuple(metrics.success_rate(stages).first()) == (3, 2, 66.7)
    assert metrics.success_rate(stages.filter("false")).first().success_pct == 0.0


def test_factor_model_predicts_every_test_row(spark, world):
    _, training, _ = world
    split = recommend.train_test_split(training)
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    got = ratings.factor_model(train, test, rank=4, iterations=3).collect()
    assert len(got) == test.count()
    assert all(1.0 <= r.pred_rating <= 5.0 for r in got)


def test_factor_model_follows_the_ratings(spark):
    rows = [(u, i, float(1 + (i + u % 2 * 2) % 5)) for u in range(30) for i in range(20)]
    ratings_of = spark.createDataFrame(rows, "customer_unique_id int, product_id int, rating double")
    test = ratings_of.filter("(customer_unique_id * 7 + product_id) % 5 = 0")
    got = ratings.factor_model(ratings_of.exceptAll(test), test, rank=6).collect()
    mean = sum(r.true_rating for r in got) / len(got)
    assert len({round(r.score, 6) for r in got}) > 4
    assert sum((r.pred_rating - r.true_rating) ** 2 for r in got) < 0.25 * sum((mean - r.true_rating) ** 2 for r in got)
