"""Aggregates behind the exploratory plots and the preparation summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.functions.ordering import positions
from merchweave.functions.scalars import mean_of_ints, round_half_even


def score_distribution(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("review_score") > 0).groupBy("review_score").agg(F.count("*").alias("n"))


def top_categories(transactions: DataFrame, k: int = 15) -> DataFrame:
    return (
        transactions.filter(F.col("category_english").isNotNull())
        .groupBy("category_english")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "category_english")
        .limit(k)
    )


def long_tail(transactions: DataFrame) -> DataFrame:
    """Every product with its sales and its place in the popularity order."""
    sold = (
        transactions.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(F.count("*").alias("n_sold"))
    )
    return positions(sold, ["n_sold", "product_id"], descending=["n_sold"], name="place")


def user_activity(interactions: DataFrame, first: int = 10) -> DataFrame:
    """How many users made 1, 2, ... purchases: the smallest ``first`` values."""
    per_user = interactions.groupBy("customer_unique_id").agg(F.sum("purchase_count").alias("n_purchases"))
    return per_user.groupBy("n_purchases").agg(F.count("*").alias("n_users")).orderBy("n_purchases").limit(first)


def monthly_volume(transactions: DataFrame) -> DataFrame:
    """Lines per calendar month, labelled by month end; months without any are 0."""
    stamped = transactions.filter(F.col("order_purchase_timestamp").isNotNull())
    counts = stamped.groupBy(F.last_day("order_purchase_timestamp").alias("month_end")).agg(
        F.count("order_id").alias("n_lines")
    )
    months = counts.agg(
        F.sequence(
            F.trunc(F.min("month_end"), "month"),
            F.trunc(F.max("month_end"), "month"),
            F.expr("interval 1 month"),
        ).alias("months")
    ).select(F.explode("months").alias("month"))
    months = months.select(F.last_day("month").alias("month_end"))
    return months.join(counts, "month_end", "left").withColumn("n_lines", F.coalesce("n_lines", F.lit(0)))


def purchase_heatmap(transactions: DataFrame) -> DataFrame:
    """Lines per weekday and hour, one column per hour; empty cells are 0."""
    hours = list(range(24))
    return (
        transactions.filter(F.col("purchase_dayofweek").isNotNull())
        .groupBy("purchase_dayofweek")
        .agg(
            *[
                F.count(F.when(F.col("purchase_hour") == h, F.col("order_id"))).alias(f"h{h:02d}")
                for h in hours
            ]
        )
    )


def price_histogram(transactions: DataFrame, cap: float = 500.0, bins: int = 50) -> DataFrame:
    """Equal bins over the capped prices; the last bin includes its upper edge."""
    price = F.least(F.col("price"), F.lit(cap))
    priced = transactions.filter(F.col("price").isNotNull()).groupBy(price.alias("p")).agg(F.count("*").alias("n"))
    edges = priced.agg(F.struct(F.min("p").alias("lo"), F.max("p").alias("hi")).alias("e")).scalar()
    # A constant column gets a range of one around it, as numpy does.
    flat = edges["lo"] == edges["hi"]
    low = F.when(flat, edges["lo"] - 0.5).otherwise(edges["lo"])
    high = F.when(flat, edges["hi"] + 0.5).otherwise(edges["hi"])
    bucket = F.least(F.floor((F.col("p") - low) / (high - low) * bins).cast("int"), F.lit(bins - 1))
    counts = priced.groupBy(bucket.alias("bin")).agg(F.sum("n").alias("n_lines"))
    all_bins = transactions.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counts, "bin", "left").select("bin", F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


def payment_share(transactions: DataFrame) -> DataFrame:
    counts = (
        transactions.filter(F.col("primary_payment_type").isNotNull())
        .groupBy("primary_payment_type")
        .agg(F.count("*").alias("n_lines"))
    )
    share = F.col("n_lines").cast("double") * 100.0 / F.sum("n_lines").over(W.partitionBy()).cast("double")
    return counts.withColumn("share_pct", round_half_even(share, 1))


def preparation_summary(transactions: DataFrame, interactions: DataFrame) -> DataFrame:
    facts = transactions.agg(
        F.count("*").alias("transaction_rows"),
        F.count_distinct("customer_unique_id").alias("unique_users"),
        F.count_distinct("product_id").alias("unique_products"),
        F.count_distinct("category_english").alias("unique_categories"),
        round_half_even(mean_of_ints(F.when(F.col("review_score") > 0, F.col("review_score"))), 2).alias("avg_review_score"),
        F.min("order_purchase_timestamp").alias("first_purchase"),
        F.max("order_purchase_timestamp").alias("last_purchase"),
    )
    pairs = interactions.agg(F.count("*")).scalar()
    cells = F.col("unique_users").cast("double") * F.col("unique_products").cast("double")
    filled = F.coalesce(F.try_divide(F.col("interaction_count").cast("double"), cells), F.lit(0.0))
    return facts.withColumn("interaction_count", pairs).withColumn(
        "sparsity_pct", round_half_even((F.lit(1.0) - filled) * 100, 4)
    )
