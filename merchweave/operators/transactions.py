"""The joined transaction table and the user-item interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchweave.functions.scalars import mean_of_ints, round_half_even


def orders_with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    return orders.join(items, "order_id", "inner")


def with_reviews(lines: DataFrame, reviews: DataFrame) -> DataFrame:
    """Left join; an order with several reviews repeats its lines. No review scores 0."""
    return lines.join(
        reviews.select("order_id", "review_score", "has_review_text"), "order_id", "left"
    ).withColumn("review_score", F.coalesce("review_score", F.lit(0)))


def with_time_parts(df: DataFrame, stamp: str = "order_purchase_timestamp") -> DataFrame:
    """Date, hour and weekday (Monday is 0) of the purchase."""
    return df.withColumns(
        {
            "purchase_date": F.to_date(stamp),
            "purchase_hour": F.hour(stamp),
            "purchase_dayofweek": F.weekday(stamp),
        }
    )


def purchase_lines(
    orders: DataFrame, items: DataFrame, reviews: DataFrame, customers: DataFrame, products: DataFrame | None = None
) -> DataFrame:
    """Order lines with score, user and (given the products) category: what features and models read.

    User and score belong to the order and join it before its lines do, so lines are shuffled by product and by
    order only. The order comes last: its lines then stand in one task and collapse before they go to their user.
    """
    people = customers.select("customer_id", "customer_unique_id", "customer_state")
    placed = with_reviews(orders.join(people, "customer_id", "left"), reviews)
    lines = orders_with_items(placed, items if products is None else line_categories(items, products))
    first, last = ["product_id", "customer_id", "order_id"], ["review_score", "has_review_text"]
    last += [*people.columns[1:], *(["category_english"] if products is not None else [])]
    return lines.select(*first, *[c for c in [*orders.columns, *items.columns] if c not in first], *last)


def line_categories(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with the category of their product; a product listed twice repeats them."""
    return lines.join(products.select("product_id", "category_english"), "product_id", "left")


def build_transactions(
    orders: DataFrame,
    items: DataFrame,
    reviews: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    products: DataFrame,
) -> DataFrame:
    """All six cleaned tables joined, one row per order line and review.

    Orders, items, reviews and payments share the order key and thus one
    shuffle. Pass customers reduced to one row per person to reproduce the
    source data (later orders of a person then have no user), or all of them.
    """
    lines = with_reviews(orders_with_items(orders, items), reviews).join(payments, "order_id", "left")
    people = customers.select("customer_id", "customer_unique_id", "customer_state")
    goods = products.select("product_id", "category_english", "product_weight_g", "product_photos_qty")
    return with_time_parts(lines.join(people, "customer_id", "left").join(goods, "product_id", "left"))


def build_interactions(transactions: DataFrame) -> DataFrame:
    """One row per user and product: mean score (0 where not reviewed), distinct orders."""
    return (
        transactions.filter(F.col("customer_unique_id").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("customer_unique_id", "product_id")
        .agg(
            round_half_even(mean_of_ints(F.col("review_score")), 1).alias("rating"),
            F.count_distinct("order_id").alias("purchase_count"),
        )
        .withColumn("implicit", F.lit(1))
    )


def matrix_stats(interactions: DataFrame) -> DataFrame:
    """Users, items, interactions and the share of empty cells in percent."""
    counts = interactions.agg(
        F.count_distinct("customer_unique_id").alias("n_users"),
        F.count_distinct("product_id").alias("n_items"),
        F.count("*").alias("n_interactions"),
    )
    cells = F.col("n_users").cast("double") * F.col("n_items").cast("double")
    filled = F.coalesce(F.try_divide(F.col("n_interactions").cast("double"), cells), F.lit(0.0))
    return counts.withColumn("sparsity_pct", round_half_even((F.lit(1.0) - filled) * 100, 4))


def multi_category_users(interactions_with_category: DataFrame, at_least: int = 2) -> DataFrame:
    return (
        interactions_with_category.groupBy("customer_unique_id")
        .agg(F.count_distinct("category_english").alias("distinct_categories"))
        .filter(F.col("distinct_categories") >= at_least)
    )


def with_category(interactions: DataFrame, products: DataFrame) -> DataFrame:
    """Category of each interaction; products without one are 'unknown'."""
    return interactions.join(products.select("product_id", "category_english"), "product_id", "left").withColumn(
        "category_english", F.coalesce("category_english", F.lit("unknown"))
    )
