"""Non-negative factorisation of the whole rating matrix, missing ratings being 0.

Multiplicative updates need three things of a factor: its products with the known ratings, which is a join
and a sum over the ratings alone, its own rows, and the small matrix of all products of its columns. The zeros
are in that matrix and never become rows. Each update writes the new factor; then the column products are summed over
it. Only these rank x rank numbers of every task come to the driver, whatever the size of the matrix.

Ratings are written twice, in buckets of their user and of their item, and factors in buckets of their id. What an
update shuffles is then the products of ratings and factor on their way to the row they are added up for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchweave.functions.scalars import clip, mean_of_tenths
from merchweave.session import bucketed, discard, staged

RANK = 20
ROUNDS = 200
CHECK = 10  # rounds between looks at the error
TOLERANCE = 1e-4  # of the first error: less gain than that ends the rounds
LEAST = 1e-12  # divisors are at least this
SCALE = (1.0, 5.0)


def names(rank: int) -> list[str]:
    return [f"f{j}" for j in range(rank)]


def starting_factor(ids: DataFrame, key: str, kind: str, scale: float, rank: int) -> DataFrame:
    """Numbers below ``scale`` from the MD5 of kind, id and column, the same on every run and engine."""

    def number(j: int) -> Column:
        digest = F.md5(F.concat_ws("|", F.lit(kind), F.col(key).cast("string"), F.lit(str(j))))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32) * F.lit(scale)

    return ids.select(key, *[number(j).alias(c) for j, c in enumerate(names(rank))], F.lit(0.0).alias("fit"))


@dataclass
class Factor:
    """A written factor (id, f0, f1, ..., fit), the products of its columns, and the sum of ``fit``."""

    rows: DataFrame
    gram: np.ndarray
    fit: float


def _sums(rows: DataFrame, rank: int) -> tuple[np.ndarray, float]:
    """The products of the columns and the sum of ``fit``; a task sends one row, the upper half of its own."""
    upper = np.triu_indices(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, fit = np.zeros((rank, rank)), 0.0
        for batch in batches:
            values = np.stack([c.to_numpy() for c in batch.columns], axis=1)
            gram += values[:, :rank].T @ values[:, :rank]
            fit += float(values[:, rank].sum())
        yield pa.RecordBatch.from_arrays([pa.array([[*gram[upper].tolist(), fit]], pa.list_(pa.float64()))], ["sums"])

    found = rows.select(*names(rank), "fit").mapInArrow(run, "sums array<double>").collect()
    *products, fit = np.sum([r["sums"] for r in found], axis=0) if found else np.zeros(len(upper[0]) + 1)
    gram = np.zeros((rank, rank))
    gram[upper] = products
    return np.maximum(gram, gram.T), float(fit)  # nothing is below 0


def _written(rows: DataFrame, rank: int, key: str, placed: bool = False) -> Factor:
    table = bucketed(rows, key, f"factor-{key}", placed)
    return Factor(table, *_sums(table, rank))


def updated_rows(ratings: DataFrame, own: Factor, own_key: str, other: Factor, other_key: str, rank: int) -> DataFrame:
    """The rows of ``own`` after one multiplicative update against ``other``; ``ratings`` has both keys and ``x``.

    ``fit`` is each row's part in the product of ratings and prediction. Ratings in buckets of ``other_key`` are
    joined without a shuffle.
    """
    columns, gram = names(rank), other.gram
    products = (
        ratings.join(other.rows, other_key)
        .groupBy(own_key)
        .agg(*[F.expr(f"sum(x * {c}) AS s_{c}") for c in columns])
    )
    sums = [f"coalesce(s_{c}, 0D) AS s_{c}" for c in columns]
    joined = own.rows.join(products, own_key, "left").selectExpr(own_key, *columns, *sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.stack([c.to_numpy() for c in batch.columns[1:]], axis=1)
            old, above = values[:, :rank], values[:, rank:]
            new = above * old / np.maximum(old @ gram, LEAST)
            fit = (above * new).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in new.T), pa.array(fit)], [own_key, *columns, "fit"]
            )

    return joined.mapInArrow(run, own.rows.schema)


def updated(ratings: DataFrame, own: Factor, own_key: str, other: Factor, other_key: str, rank: int) -> Factor:
    """``own`` after one update, written."""
    return _written(updated_rows(ratings, own, own_key, other, other_key, rank), rank, own_key, placed=True)


@dataclass
class Model:
    users: Factor
    items: Factor
    errors: list[float]  # the Frobenius norm of what is left, from the start on


def _error(squares: float, users: Factor, items: Factor) -> float:
    """|X - WH| from |X|^2, <X, WH> and the column products: no cell of WH is formed."""
    cross = float((users.gram * items.gram).sum())
    return math.sqrt(max(0.0, squares - 2 * items.fit + cross))


def factorise(
    ratings: DataFrame,
    user_ids: DataFrame,
    item_ids: DataFrame,
    rank: int = RANK,
    rounds: int = ROUNDS,
    check: int = CHECK,
    tolerance: float = TOLERANCE,
) -> Model:
    """Factors of the matrix of ``ratings`` (user, item, x), whose rows and columns are ``user_ids`` and ``item_ids``.

    Every round updates the users' factor, then the items'. It ends after ``rounds``, or where the error
    has fallen by less than ``tolerance`` of the first one within ``check`` rounds. A pair rated twice counts as the
    mean of its ratings.
    """
    known = ratings.groupBy("user", "item").agg(F.avg("x").alias("x")).filter(F.col("x") > 0)
    known = bucketed(known, "user", "known-ratings")
    by_item = bucketed(known, "item", "known-ratings")
    people, goods = staged(user_ids.distinct(), "matrix-users"), staged(item_ids.distinct(), "matrix-items")
    total, squares = known.agg(F.sum("x"), F.sum(F.col("x") * F.col("x"))).first()
    cells = people.count() * goods.count()
    scale = math.sqrt((total or 0.0) / max(1, cells) / rank)
    users = _written(starting_factor(people, "user", "user", scale, rank), rank, "user")
    items = _written(starting_factor(goods, "item", "item", scale, rank), rank, "item")
    errors: list[float] = []
    for done in range(1, rounds + 1):
        for_users = updated(by_item, users, "user", items, "item", rank)
        discard(users.rows)  # the new table holds all that later rounds need
        for_items = updated(known, items, "item", for_users, "user", rank)
        discard(items.rows)
        users, items = for_users, for_items
        errors.append(_error(squares or 0.0, users, items))
        if done % check == 0 and len(errors) > check and errors[-1 - check] - errors[-1] <= tolerance * errors[0]:
            break
    return Model(users, items, errors)


def long_factor(factor: Factor, key: str, kind: str, rank: int = RANK) -> DataFrame:
    """(kind, id, component, value): one row per entry."""
    entries = F.array(*[F.struct(F.lit(j).alias("component"), F.col(c).alias("value")) for j, c in enumerate(names(rank))])
    return factor.rows.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), F.inline(entries))


def predict(model: Model, pairs: DataFrame, overall: Column, rank: int = RANK) -> DataFrame:
    """Add ``score``, the product of the factors, and ``pred_rating``, clipped to the scale.

    ``pairs`` has user and item; a pair with an unknown user or item gets ``overall``.
    """
    columns = names(rank)
    left = model.users.rows.select("user", *[F.col(c).alias(f"u_{c}") for c in columns])
    right = model.items.rows.select("item", *[F.col(c).alias(f"i_{c}") for c in columns])
    product = sum((F.col(f"u_{c}") * F.col(f"i_{c}") for c in columns), F.lit(0.0))
    return (
        pairs.join(left, "user", "left")
        .join(right, "item", "left")
        .withColumn("score", product)
        .withColumn("pred_rating", F.coalesce(clip(F.col("score"), *SCALE), overall))
        .withColumn("score", F.coalesce("score", overall))
        .drop(*[f"u_{c}" for c in columns], *[f"i_{c}" for c in columns])
    )


def matrix_model(train: DataFrame, test: DataFrame, rank: int = RANK, rounds: int = ROUNDS) -> Model:
    """Factors of the training ratings over all users and products of both sets."""

    def named(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("customer_unique_id").alias("user"), F.col("product_id").alias("item"), F.col("rating").cast("double").alias("x")
        )

    both = named(train).unionByName(named(test))
    return factorise(named(train), both.select("user"), both.select("item"), rank, rounds)


def matrix_ratings(train: DataFrame, test: DataFrame, rank: int = RANK, rounds: int = ROUNDS) -> DataFrame:
    """(uid, iid, true_rating, score, pred_rating) of the test rows."""
    model = matrix_model(train, test, rank, rounds)
    pairs = test.select(
        F.col("customer_unique_id").alias("user"), F.col("product_id").alias("item"), F.col("rating").alias("true_rating")
    )
    overall = train.agg(mean_of_tenths(F.col("rating"))).scalar()
    return predict(model, pairs, overall, rank).select(
        F.col("user").alias("uid"), F.col("item").alias("iid"), "true_rating", "score", "pred_rating"
    )
