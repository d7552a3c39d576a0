"""Ranking metrics, rating errors and model comparison."""

from __future__ import annotations

from collections.abc import Sequence
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.functions.scalars import round_half_even

RELEVANT = 4.0


def discount(position: Column) -> Column:
    return F.lit(1.0) / F.log2(position.cast("double") + 1.0)


def ranking_table(scored: DataFrame, ks: Sequence[int], user: str = "uid", item: str = "iid") -> DataFrame:
    """Per user and k: hits, precision, recall, NDCG and MAP for labels 0/1 in ``relevant``.

    Only the first max(ks) rows per user are ordered; Spark cuts the lists before
    the shuffle. Totals come from a plain aggregate, so a user with very many
    rows needs no large sort. Ties in the score go to the smaller item id.
    Users without a relevant row are left out.
    """
    depth = max(ks)
    totals = scored.groupBy(user).agg(
        F.count("*").alias("n_rows"), F.sum("relevant").cast("long").alias("n_relevant")
    )
    by_user = W.partitionBy(user)
    best = scored.withColumn(
        "position", F.row_number().over(by_user.orderBy(F.desc("score"), item))
    ).filter(F.col("position") <= depth)
    running = F.sum("relevant").over(by_user.orderBy("position").rowsBetween(W.unboundedPreceding, 0))
    steps = (
        best.withColumn("_running", running)
        .join(totals.filter(F.col("n_relevant") > 0), user)
        .withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks])))
        .filter(F.col("position") <= F.col("k"))
    )
    gain = F.col("relevant").cast("double")
    sums = steps.groupBy(user, "k").agg(
        F.max("n_rows").alias("n_rows"),
        F.max("n_relevant").alias("n_relevant"),
        F.sum("relevant").cast("long").alias("hits"),
        F.sum(gain * discount(F.col("position"))).alias("_dcg"),
        F.sum(gain * F.col("_running").cast("double") / F.col("position").cast("double")).alias("_ap"),
    )
    # With 0/1 labels the ideal order starts with all relevant rows.
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.least(F.col("n_relevant"), F.col("k")).cast("int")),
        F.lit(0.0),
        lambda total, i: total + discount(i),
    )
    return sums.select(
        user,
        "k",
        "hits",
        (F.col("hits").cast("double") / F.least(F.col("k"), F.col("n_rows")).cast("double")).alias("precision"),
        (F.col("hits").cast("double") / F.col("n_relevant").cast("double")).alias("recall"),
        round_half_even(F.col("_dcg") / ideal, 9).alias("ndcg"),
        round_half_even(F.col("_ap") / F.least(F.col("n_relevant"), F.col("k"), F.col("n_rows")).cast("double"), 9).alias("map"),
    )


def graded_ndcg(scored: DataFrame, k: int, user: str = "uid", item: str = "iid") -> DataFrame:
    """NDCG@k per user for graded labels in ``relevance``; users whose labels sum to 0 are left out."""
    by_user = W.partitionBy(user)

    def total(order: list[Column], name: str) -> DataFrame:
        first = scored.withColumn("position", F.row_number().over(by_user.orderBy(*order))).filter(F.col("position") <= k)
        return first.groupBy(user).agg(F.sum(F.col("relevance") * discount(F.col("position"))).alias(name))

    dcg = total([F.desc("score"), F.col(item)], "dcg")
    ideal = total([F.desc("relevance"), F.col(item)], "idcg")
    return (
        dcg.join(ideal.filter(F.col("idcg") > 0), user)
        .select(user, round_half_even(F.col("dcg") / F.col("idcg"), 9).alias("ndcg"))
    )


def with_relevance(predictions: DataFrame, threshold: float = RELEVANT) -> DataFrame:
    """Predictions (uid, iid, true_rating, pred_rating) as scores with 0/1 labels."""
    return predictions.select(
        "uid", "iid", F.col("pred_rating").alias("score"), (F.col("true_rating") >= threshold).cast("int").alias("relevant")
    )


METRICS = ["precision", "recall", "ndcg", "map"]


def ranking_metrics(predictions: DataFrame, ks: Sequence[int] = (5, 10), threshold: float = RELEVANT) -> DataFrame:
    """Mean and population deviation of every metric over the users, one row per k and metric."""
    per_user = ranking_table(with_relevance(predictions, threshold), ks)
    long = per_user.unpivot(["uid", "k"], METRICS, "metric", "value")
    return long.groupBy("k", "metric").agg(
        F.count("*").alias("n_users"),
        round_half_even(F.avg("value"), 6).alias("mean"),
        round_half_even(F.stddev_pop("value"), 6).alias("std"),
    )


def rating_errors(predictions: DataFrame) -> DataFrame:
    gap = F.col("true_rating") - F.col("pred_rating")
    return predictions.agg(
        F.count("*").alias("n_rows"),
        round_half_even(F.sqrt(F.avg(gap * gap)), 6).alias("rmse"),
        round_half_even(F.avg(F.abs(gap)), 6).alias("mae"),
    )


def neighbour_precision_recall(scores: DataFrame, liked: DataFrame, users: DataFrame, catalogue: Column, k: int = 5) -> DataFrame:
    """Hits of the k best predicted categories among the liked ones.

    ``scores`` (user, category, score) holds positive scores; categories without
    one score 0 and fill up the k in name order. ``liked`` has one row per liked
    test row, so a category may repeat and counts that often in the recall.
    ``users`` are those of the grid.
    """
    top = scores.groupBy("customer_unique_id").agg(
        F.array_sort(
            F.collect_list(F.struct((-F.col("score")).alias("minus"), F.col("category_english").alias("category")))
        ).alias("_ranked")
    )
    names = F.coalesce(F.col("_ranked.category"), F.array().cast("array<string>"))
    predicted = F.slice(F.concat(names, F.array_except(catalogue, names)), 1, k)
    wanted = liked.groupBy("customer_unique_id").agg(
        F.count("*").alias("n_liked"), F.collect_set("category_english").alias("_liked")
    )
    hits = F.size(F.array_intersect(predicted, F.col("_liked")))
    return (
        wanted.join(users, "customer_unique_id", "left_semi")
        .join(top, "customer_unique_id", "left")
        .select(
            "customer_unique_id",
            "n_liked",
            hits.alias("hits"),
            (hits.cast("double") / F.lit(float(k))).alias("precision"),
            (hits.cast("double") / F.col("n_liked").cast("double")).alias("recall"),
        )
    )


def neighbour_ndcg(scores: DataFrame, truth: DataFrame, n_categories: Column, k: int = 5) -> DataFrame:
    """NDCG@k with equal predictions sharing their gain and discount.

    ``scores`` (user, category, score) holds positive scores, ``truth`` (user,
    category, gain) the test ratings. Categories in neither are not listed: those
    predicted 0 form the last tie block, whose size follows from their number.
    """
    pairs = truth.join(scores, ["customer_unique_id", "category_english"], "full").select(
        "customer_unique_id", F.coalesce("gain", F.lit(0.0)).alias("gain"), F.coalesce("score", F.lit(0.0)).alias("score")
    )
    known = truth.select("customer_unique_id").distinct()
    blocks = (
        pairs.join(known, "customer_unique_id", "left_semi")
        .groupBy("customer_unique_id", "score")
        .agg(F.sum("gain").alias("gain"), F.count("*").alias("listed"))
    )
    by_user = W.partitionBy("customer_unique_id")
    positive = F.sum(F.when(F.col("score") > 0, F.col("listed")).otherwise(0)).over(by_user)
    size = F.when(F.col("score") > 0, F.col("listed")).otherwise(n_categories - positive)
    before = F.coalesce(
        F.sum("size").over(by_user.orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )

    def discounts_to(n: Column) -> Column:
        totals = F.array(F.lit(0.0), *[F.lit(d) for d in _cumulative_discounts(k)])
        return F.element_at(totals, (F.least(n, F.lit(k)) + 1).cast("int"))

    gains = (
        blocks.withColumn("size", size)
        .withColumn("before", before)
        .withColumn("span", discounts_to(F.col("before") + F.col("size")) - discounts_to(F.col("before")))
        .groupBy("customer_unique_id")
        .agg(F.sum(F.col("gain") / F.col("size") * F.col("span")).alias("dcg"))
    )
    best = truth.withColumn(
        "place", F.row_number().over(by_user.orderBy(F.desc("gain"), "category_english"))
    ).filter(F.col("place") <= k)
    ideal = best.groupBy("customer_unique_id").agg(F.sum(F.col("gain") * discount(F.col("place"))).alias("idcg"))
    return gains.join(ideal, "customer_unique_id").select(
        "customer_unique_id",
        round_half_even(F.coalesce(F.try_divide(F.col("dcg"), F.col("idcg")), F.lit(0.0)), 9).alias("ndcg"),
    )


def neighbour_means(hits: DataFrame, ndcg: DataFrame, k: int = 5) -> DataFrame:
    """(metric, n_users, mean): the neighbour model's precision, recall and NDCG at k over its users; 0 without any."""

    def means(per_user: DataFrame, names: Sequence[str]) -> DataFrame:
        rows = [
            F.struct(
                F.lit(f"{name}_{k}").alias("metric"),
                F.count(name).alias("n_users"),
                F.coalesce(round_half_even(F.avg(name), 6), F.lit(0.0)).alias("mean"),
            )
            for name in names
        ]
        return per_user.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))

    return means(hits, ["precision", "recall"]).unionByName(means(ndcg, ["ndcg"]))


def _cumulative_discounts(k: int) -> list[float]:
    out, total = [], 0.0
    for i in range(1, k + 1):
        total += 1.0 / log2(i + 1)
        out.append(total)
    return out


def performance_report(results: DataFrame, k: int = 5) -> DataFrame:
    """One row per model from (model, metric, mean), with metrics named like ``ndcg_5``.

    A metric a model lacks counts as 0, and models without any are left out. Models are placed by NDCG, ties by
    precision and then by name; the first is the best.
    """
    names = [f"{m}_{k}" for m in ("precision", "recall", "ndcg")]
    wide = results.groupBy("model").agg(
        *[F.coalesce(F.max(F.when(F.col("metric") == n, F.col("mean"))), F.lit(0.0)).alias(n) for n in names]
    )
    order = W.orderBy(F.desc(names[2]), F.desc(names[0]), "model")  # one row per model
    return wide.filter(F.greatest(*names) > 0).withColumn("place", F.row_number().over(order))


def best_models(results: DataFrame) -> DataFrame:
    """Model with the best NDCG and model with the least RMSE from (model, ndcg, rmse).

    Models without a metric take no part in that comparison; ties go by name.
    """
    by_ndcg = F.min(F.when(F.col("ndcg").isNotNull(), F.struct((-F.col("ndcg")).alias("minus"), "model")))
    by_rmse = F.min(F.when(F.col("rmse").isNotNull(), F.struct("rmse", "model")))
    return results.agg(
        by_ndcg["model"].alias("best_ranking_model"),
        F.max("ndcg").alias("best_ndcg"),
        by_rmse["model"].alias("best_rating_model"),
        F.min("rmse").alias("best_rmse"),
    )


def success_rate(statuses: DataFrame, good: str = "SUCCESS") -> DataFrame:
    return statuses.agg(
        F.count("*").alias("n_stages"),
        F.count_if(F.col("status") == good).alias("n_success"),
        F.coalesce(
            round_half_even(F.avg((F.col("status") == good).cast("double")) * 100, 1), F.lit(0.0)
        ).alias("success_pct"),
    )
