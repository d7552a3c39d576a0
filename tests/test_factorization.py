"""Factorisation with missing ratings as 0 against dense numpy updates."""

import inspect
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchweave.operators import factorization as nmf
from merchweave.plans import catalog
from merchweave.session import bucketed, discard, staged

RANK = 3


def ratings(seed=2, users=25, items=18):
    rng = np.random.default_rng(seed)
    out = {(int(rng.integers(0, users)), f"p{int(rng.integers(0, items))}"): float(rng.integers(1, 6)) for _ in range(120)}
    out |= {(u, "p0"): 5.0 for u in range(0, users, 2)}  # one item with a large share
    return [(u, i, x) for (u, i), x in out.items()]


def dense(rows, users, items, start, rounds):
    x = np.zeros((len(users), len(items)))
    for u, i, r in rows:
        x[users.index(u), items.index(i)] = r
    w, h = start
    errors = []
    for _ in range(rounds):
        w = w * (x @ h.T) / np.maximum(w @ (h @ h.T), nmf.LEAST)
        h = h * (w.T @ x) / np.maximum((w.T @ w) @ h, nmf.LEAST)
        errors.append(float(np.linalg.norm(x - w @ h)))
    return w, h, errors


def matrix(factor, key, ids):
    by = {r[key]: [r[c] for c in nmf.names(RANK)] for r in factor.rows.collect()}
    assert set(by) == set(ids)
    return np.asarray([by[i] for i in ids])


def test_rounds_equal_dense_updates_and_the_error_falls(spark):
    rows = ratings()
    frame = spark.createDataFrame(rows, "user long, item string, x double").repartition(3)
    users, items = [*range(26)], [f"p{i}" for i in range(19)]  # one of each without any rating
    people = spark.createDataFrame([(u,) for u in users], "user long")
    goods = spark.createDataFrame([(i,) for i in items], "item string")
    first = nmf.factorise(frame, people, goods, RANK, rounds=0)
    start = matrix(first.users, "user", users), matrix(first.items, "item", items).T
    model = nmf.factorise(frame, people, goods, RANK, rounds=6, tolerance=0.0)
    w, h, errors = dense(rows, users, items, start, 6)
    assert np.allclose(matrix(model.users, "user", users), w, rtol=1e-9, atol=1e-12)
    assert np.allclose(matrix(model.items, "item", items).T, h, rtol=1e-9, atol=1e-12)
    assert model.errors == pytest.approx(errors)
    assert all(b < a for a, b in zip(model.errors, model.errors[1:], strict=False))

    pairs = spark.createDataFrame([(3, "p0"), (25, "p1"), (99, "p0"), (1, "none")], "user long, item string")
    got = {(r.user, r.item): (r.score, r.pred_rating) for r in nmf.predict(model, pairs, F.lit(3.25), RANK).collect()}
    score = float(w[3] @ h[:, 0])
    assert got[3, "p0"] == pytest.approx((score, min(5.0, max(1.0, score))))
    assert got[25, "p1"] == (0.0, 1.0) and got[99, "p0"] == got[1, "none"] == (3.25, 3.25)


def test_rounds_end_where_nothing_is_gained(spark):
    frame = spark.createDataFrame([(u, f"p{i}", 4.0) for u in range(4) for i in range(3)], "user long, item string, x double")
    model = nmf.factorise(frame, frame.select("user"), frame.select("item"), 1, rounds=50, check=2, tolerance=1e-3)
    assert len(model.errors) == 4 and model.errors[-1] == pytest.approx(0.0, abs=1e-5)


def test_no_ratings(spark):
    empty = spark.createDataFrame([], "user long, item string, x double")
    model = nmf.factorise(empty, empty.select("user"), empty.select("item"), RANK, rounds=2)
    assert model.users.rows.count() == 0 and model.errors == [0.0, 0.0]


def test_discard_deletes_staged_tables_only(spark, tmp_path):
    table = staged(spark.range(5), "short-lived")
    folder = table.inputFiles()[0].rsplit("/", 1)[0]
    discard(table)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)
    spark.range(3).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="no staged table"):
        discard(spark.read.parquet(str(tmp_path / "other")))


def test_an_update_shuffles_products_only(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = spark.createDataFrame(ratings(), "user long, item string, x double")
        model = nmf.factorise(frame, frame.select("user"), frame.select("item"), RANK, rounds=1)
        by_item = bucketed(frame, "item", "known-ratings")
        rows = nmf.updated_rows(by_item, model.users, "user", model.items, "item", RANK)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning(user") == 1
        assert plan.count("Exchange") == 1
        files = [f.rsplit("_", 1)[1] for f in model.users.rows.inputFiles()]
        assert len(files) == len(set(files))  # one file a bucket
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    name = by_item.inputFiles()[0].rsplit("/", 2)[1]
    discard(by_item)
    assert not spark.catalog.tableExists(name)


def test_the_query_runs_the_whole_factorisation(spark, monkeypatch):
    rows = [(u, i, int(x)) for u, i, x in ratings(users=6, items=5)]
    train = spark.createDataFrame(rows, "customer_unique_id long, product_id string, rating int")
    asked = []
    plain = nmf.factorise

    def short(*given, **named):
        call = inspect.signature(plain).bind(*given, **named)
        call.apply_defaults()
        asked.append(dict(call.arguments))
        call.arguments["rounds"] = 1
        return plain(*call.args, **call.kwargs)

    monkeypatch.setattr(nmf, "factorise", short)
    found = catalog.QUERIES["nmf_rating"](SimpleNamespace(train=train, test=train.limit(3)))
    assert found.count() == 3
    (call,) = asked
    assert [call[x] for x in ("rank", "rounds", "check", "tolerance")] == [20, 200, 10, 1e-4]


def test_column_products_of_a_written_factor(spark):
    table = np.random.default_rng(5).random((50, RANK + 1))
    columns = ["id long", *[f"{c} double" for c in nmf.names(RANK)], "fit double"]
    frame = spark.createDataFrame([(i, *r.tolist()) for i, r in enumerate(table)], ", ".join(columns))
    for rows in (frame.repartition(3), frame.filter("id < 0"), frame.limit(1)):
        gram, fit = nmf._sums(rows, RANK)
        own = np.asarray([tuple(r)[1:] for r in rows.collect()]).reshape(-1, RANK + 1)
        assert np.allclose(gram, own[:, :RANK].T @ own[:, :RANK]) and fit == pytest.approx(own[:, RANK].sum())
