"""Rating predictors and recommendation lists built from mean ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.functions.ordering import positions
from merchweave.functions.scalars import clip, mean_of_tenths
from merchweave.operators.recommend import item_mean_ratings, items_by_category, seen_items, unseen_items
from merchweave.session import staged

# Weights of the two means and of the two lists.
USER_WEIGHT, ITEM_WEIGHT = 0.6, 0.4
HEAVY, LIGHT = 0.8, 0.2
MIN_PURCHASES = 2
HYBRID_DEPTH = 100
LIKED = 4.0
SCALE = (1.0, 5.0)


def dense_ids(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Distinct values in sorted order with codes from 0."""
    distinct = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return positions(distinct, [column], name="_p").select(column, (F.col("_p") - 1).alias(name))


def blend_rating(pairs: DataFrame, training: DataFrame) -> DataFrame:
    """Weighted user and item means, clipped; the global mean if either is unknown."""
    users = training.groupBy("customer_unique_id").agg(mean_of_tenths(F.col("rating")).alias("user_mean"))
    items = item_mean_ratings(training)
    overall = training.agg(mean_of_tenths(F.col("rating"))).scalar()
    blended = clip(F.lit(USER_WEIGHT) * F.col("user_mean") + F.lit(ITEM_WEIGHT) * F.col("mean_rating"), *SCALE)
    return (
        pairs.join(users, "customer_unique_id", "left")
        .join(items, "product_id", "left")
        .withColumn("pred_rating", F.coalesce(blended, overall))
        .drop("user_mean", "mean_rating")
    )


def popular_items(training: DataFrame, k: int = 10) -> DataFrame:
    counts = training.groupBy("product_id").agg(F.count("rating").alias("n_ratings"))
    return counts.orderBy(F.desc("n_ratings"), "product_id").limit(k)


def top_rated_unseen(training: DataFrame, k: int = 10) -> DataFrame:
    """For every user the k best rated products the user has not bought."""
    items = staged(
        positions(
            item_mean_ratings(training), ["mean_rating", "product_id"], descending=["mean_rating"], name="item_place"
        ),
        "item-places",
    )
    seen = seen_items(training).join(items.select("product_id", "item_place"), "product_id").drop("product_id")
    users = training.select("customer_unique_id").distinct()
    found = unseen_items(users, seen, items, ["customer_unique_id"], [], k)
    order = W.partitionBy("customer_unique_id").orderBy("item_place")
    return found.select(
        "customer_unique_id", F.row_number().over(order).alias("rank"), "product_id", F.col("mean_rating").alias("score")
    )


def content_recommendations(training: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """Unseen products of the categories a user rated highly, best rated first.

    Users without any history get the most popular products with score 0.
    ``training`` carries ``category_english``.
    """
    liked = (
        training.filter(F.col("rating") >= LIKED).select("customer_unique_id", "category_english").distinct()
    ).join(users, "customer_unique_id", "left_semi")
    items = staged(items_by_category(training), "items")
    seen = (
        seen_items(training)
        .join(items.select("product_id", "category_english", "item_place"), "product_id")
        .drop("product_id")
    )
    found = unseen_items(
        liked, seen, items, ["customer_unique_id", "category_english"], ["category_english"], k
    )
    order = W.partitionBy("customer_unique_id").orderBy(F.desc("score"), "product_id")
    ranked = (
        found.withColumnRenamed("mean_rating", "score")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("customer_unique_id", "rank", "product_id", "score")
    )
    # The k popular products, numbered: k rows.
    numbered = popular_items(training, k).withColumn(
        "rank", F.row_number().over(W.orderBy(F.desc("n_ratings"), "product_id"))
    )
    strangers = users.select("customer_unique_id").distinct().join(training, "customer_unique_id", "left_anti")
    fallback = (
        strangers.withColumn("rank", F.explode(F.sequence(F.lit(1), F.lit(k))))
        .join(numbered, "rank")
        .select("customer_unique_id", "rank", "product_id", F.lit(0.0).alias("score"))
    )
    return ranked.unionByName(fallback)


def hybrid_recommendations(training: DataFrame, k: int = 10, depth: int = HYBRID_DEPTH) -> DataFrame:
    """Both lists weighted by how much the user bought, summed per product."""
    purchases = training.groupBy("customer_unique_id").agg(F.count("*").alias("_n"))
    many = F.col("_n") >= MIN_PURCHASES
    users = training.select("customer_unique_id").distinct()
    rated = top_rated_unseen(training, depth).join(purchases, "customer_unique_id")
    content = content_recommendations(training, users, depth).join(purchases, "customer_unique_id")

    def weighted(df: DataFrame, if_many: float, if_few: float) -> DataFrame:
        weight = F.when(many, F.lit(if_many)).otherwise(F.lit(if_few))
        return df.select("customer_unique_id", "product_id", (weight * F.col("score")).alias("part"))

    both = weighted(rated, HEAVY, LIGHT).unionByName(weighted(content, LIGHT, HEAVY))
    total = both.groupBy("customer_unique_id", "product_id").agg(F.round(F.sum("part"), 9).alias("score"))
    order = W.partitionBy("customer_unique_id").orderBy(F.desc("score"), "product_id")
    return total.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def factor_model(train: DataFrame, test: DataFrame, rank: int = 20, iterations: int = 10, seed: int = 42) -> DataFrame:
    """Non-negative factors of the ratings by ALS; predictions for the test rows, clipped to the scale.

    The factors are fitted to the ratings themselves; a missing rating is unknown, not 0. ``score`` is the
    prediction before the clip, which ranks items. Rows with an unknown user or product get the train mean.
    """
    from pyspark.ml.recommendation import ALS

    both = train.select("customer_unique_id", "product_id").unionByName(test.select("customer_unique_id", "product_id"))
    users = dense_ids(both, "customer_unique_id", "user_code").withColumn("user_code", F.col("user_code").cast("int"))
    items = dense_ids(both, "product_id", "item_code").withColumn("item_code", F.col("item_code").cast("int"))

    def coded(df: DataFrame) -> DataFrame:
        return df.join(users, "customer_unique_id").join(items, "product_id")

    als = ALS(
        rank=rank,
        maxIter=iterations,
        nonnegative=True,
        seed=seed,
        userCol="user_code",
        itemCol="item_code",
        ratingCol="rating",
        coldStartStrategy="nan",
    )
    known = staged(coded(train).select("customer_unique_id", "product_id", "rating", "user_code", "item_code"), "coded")
    model = als.fit(known)
    overall = known.agg(mean_of_tenths(F.col("rating"))).scalar()
    raw = F.when(~F.isnan("prediction"), F.col("prediction").cast("double"))
    return model.transform(coded(test)).select(
        F.col("customer_unique_id").alias("uid"),
        F.col("product_id").alias("iid"),
        F.col("rating").alias("true_rating"),
        F.coalesce(raw, overall).alias("score"),
        clip(F.coalesce(raw, overall), *SCALE).alias("pred_rating"),
    )
