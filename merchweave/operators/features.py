"""User, item and interaction features and their registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.functions.ordering import ranked_values
from merchweave.functions.scalars import (
    bounds_of,
    category_flag,
    elapsed_days,
    mean_of_ints,
    mean_of_money,
    money_sum,
    round_doubles,
    round_half_even,
    scale_between,
)
from merchweave.session import staged

# Categories with their own 0/1 column.
TOP_CATEGORIES = [
    "bed_bath_table",
    "health_beauty",
    "sports_leisure",
    "furniture_decor",
    "computers_accessories",
    "housewares",
    "watches_gifts",
    "telephony",
    "garden_tools",
    "auto",
]
RATING_WEIGHT = 0.6
FREQUENCY_WEIGHT = 0.4

USER_FEATURES = [
    "customer_unique_id",
    "purchase_count",
    "total_spending",
    "avg_order_value",
    "avg_rating_given",
    "review_count",
    "distinct_products",
    "distinct_categories",
    "preferred_category",
    "avg_freight",
    "customer_state",
    "recency_days",
    "purchase_freq_log",
    "spending_log",
    "spending_normalized",
    "aov_normalized",
]

# Columns of the order lines that the three feature tables are made of, next to the category.
LINE_COLUMNS = [
    "order_id",
    "product_id",
    "customer_unique_id",
    "customer_state",
    "order_purchase_timestamp",
    "price",
    "freight_value",
    "review_score",
]


def _reviewed():
    return F.when(F.col("review_score") > 0, F.col("review_score"))


def user_aggregates(transactions: DataFrame, together: bool = False) -> DataFrame:
    """One row per user, plus one for lines without a user (it carries the latest purchase).

    Lines without a user take no part in the distinct counts, so they collapse
    to one row per task before the shuffle. Where the lines of a user stand ``together`` in a task,
    the first line of each value is counted instead, which needs no shuffle.
    """
    known = F.col("customer_unique_id").isNotNull()
    stamp = F.col("order_purchase_timestamp")

    def distinct(column: str) -> Column:
        if together:
            return F.count(F.when(known & F.col(f"_first_{column}"), F.col(column)))
        return F.count_distinct(F.when(known, F.col(column)))

    if together:
        for c in ("order_id", "product_id", "category_english"):
            place = F.row_number().over(W.partitionBy("customer_unique_id", c).orderBy(c))
            transactions = transactions.withColumn(f"_first_{c}", place == 1)
    return transactions.groupBy("customer_unique_id").agg(
        distinct("order_id").alias("purchase_count"),
        money_sum(F.col("price")).alias("total_spending"),
        mean_of_money(F.col("price")).alias("avg_order_value"),
        mean_of_ints(_reviewed()).alias("avg_rating_given"),
        F.count(_reviewed()).alias("review_count"),
        distinct("product_id").alias("distinct_products"),
        distinct("category_english").alias("distinct_categories"),
        F.coalesce(F.mode(F.when(known, F.col("category_english")), True), F.lit("unknown")).alias("preferred_category"),
        mean_of_money(F.col("freight_value")).alias("avg_freight"),
        F.min_by(
            "customer_state",
            F.when(F.col("customer_state").isNotNull(), F.struct(stamp, F.col("order_id"))),
        ).alias("customer_state"),
        F.max(stamp).alias("last_purchase"),
    )


def build_user_features(transactions: DataFrame, latest: Column | None = None, together: bool = False) -> DataFrame:
    """``latest`` is the time of the latest purchase, where ``transactions`` does not hold all lines."""
    grouped = staged(user_aggregates(transactions, together), "user-aggregates", compression="zstd")
    latest = grouped.agg(F.max("last_purchase")).scalar() if latest is None else latest
    users = grouped.filter(F.col("customer_unique_id").isNotNull())
    bounds = bounds_of(users, "total_spending", "avg_order_value")
    features = users.withColumns(
        {
            "recency_days": elapsed_days(latest, F.col("last_purchase")),
            "purchase_freq_log": F.log1p(F.col("purchase_count").cast("double")),
            "spending_log": F.log1p("total_spending"),
            "spending_normalized": scale_between(
                F.col("total_spending"), bounds["total_spending_lo"], bounds["total_spending_hi"]
            ),
            "aov_normalized": scale_between(
                F.col("avg_order_value"), bounds["avg_order_value_lo"], bounds["avg_order_value_hi"]
            ),
        }
    )
    return round_doubles(features.select(*USER_FEATURES))


def item_aggregates(transactions: DataFrame) -> DataFrame:
    """One row per product; lines without a user still count as sold."""
    return (
        transactions.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.min("category_english").alias("category_english"),
            F.count("order_id").alias("total_sold"),
            mean_of_ints(_reviewed()).alias("avg_rating_received"),
            F.count(_reviewed()).alias("review_count"),
            mean_of_money(F.col("price")).alias("avg_price"),
            money_sum(F.col("price")).alias("total_revenue"),
            F.count_distinct("customer_unique_id").alias("distinct_buyers"),
            mean_of_money(F.col("freight_value")).alias("avg_freight"),
        )
    )


def popularity_rank(items: DataFrame, ranks: DataFrame) -> DataFrame:
    """Competition rank of total_sold, largest first: 1 + products sold more often."""
    sold = ranks.filter(F.col("column_name") == "total_sold").select(
        F.col("value").alias("_sold"),
        (F.col("n_total") - F.col("n_before") - F.col("n") + 1).cast("int").alias("popularity_rank"),
    )
    return items.join(sold, F.col("total_sold").cast("double") == F.col("_sold"), "left").drop("_sold")


def price_percentile(items: DataFrame, ranks: DataFrame) -> DataFrame:
    """Average rank of the mean price over the number of products."""
    price = ranks.filter(F.col("column_name") == "avg_price").select(
        F.col("value").alias("_price"),
        (
            (F.col("n_before").cast("double") + (F.col("n").cast("double") + 1.0) / 2.0) / F.col("n_total").cast("double")
        ).alias("price_percentile"),
    )
    return items.join(price, F.col("avg_price") == F.col("_price"), "left").drop("_price")


def one_hot(df: DataFrame, categories: Sequence[str], column: str = "category_english") -> DataFrame:
    flags = {f"is_cat_{c.replace(' ', '_')}": category_flag(F.col(column), c) for c in categories}
    other = F.lit(1) - F.coalesce(F.col(column).isin(list(categories)), F.lit(False)).cast("int")
    return df.withColumns({**flags, "is_cat_other": other})


def item_feature_names(categories: Sequence[str]) -> list[str]:
    return [
        "product_id",
        "category_english",
        "total_sold",
        "avg_rating_received",
        "review_count",
        "avg_price",
        "total_revenue",
        "distinct_buyers",
        "avg_freight",
        "product_weight_g",
        "product_photos_qty",
        "product_volume_cm3",
        "popularity_rank",
        "price_percentile",
        "price_normalized",
        "sold_normalized",
        "rating_normalized",
        *[f"is_cat_{c.replace(' ', '_')}" for c in categories],
        "is_cat_other",
    ]


def build_item_features(
    transactions: DataFrame, products: DataFrame, categories: Sequence[str] = tuple(TOP_CATEGORIES)
) -> DataFrame:
    grouped = staged(item_aggregates(transactions), "item-aggregates", compression="zstd")
    attributes = products.select(
        "product_id",
        "product_weight_g",
        "product_photos_qty",
        (F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")).alias(
            "product_volume_cm3"
        ),
    ).dropDuplicates(["product_id"])
    ranks = ranked_values(grouped, ["total_sold", "avg_price"])
    items = grouped.withColumn("_rating", F.coalesce("avg_rating_received", F.lit(0.0)))
    bounds = bounds_of(items, "avg_price", "total_sold", "_rating")
    items = price_percentile(popularity_rank(items.join(attributes, "product_id", "left"), ranks), ranks)
    for source, target in (
        ("avg_price", "price_normalized"),
        ("total_sold", "sold_normalized"),
        ("_rating", "rating_normalized"),
    ):
        items = items.withColumn(target, scale_between(F.col(source), bounds[f"{source}_lo"], bounds[f"{source}_hi"]))
    return round_doubles(one_hot(items, categories).select(*item_feature_names(categories)))


def build_interaction_features(interactions: DataFrame) -> DataFrame:
    """Scaled rating and the weighted affinity of each user-item pair."""
    pairs = staged(interactions, "interactions", compression="zstd")
    bounds = bounds_of(pairs.withColumn("rating", F.coalesce("rating", F.lit(0.0))), "rating", "purchase_count")
    rating = scale_between(F.coalesce("rating", F.lit(0.0)), bounds["rating_lo"], bounds["rating_hi"])
    frequency = scale_between(F.col("purchase_count"), bounds["purchase_count_lo"], bounds["purchase_count_hi"])
    return pairs.select(
        "customer_unique_id",
        "product_id",
        round_half_even(F.col("rating"), 4).alias("rating"),
        "purchase_count",
        F.col("implicit").alias("implicit_signal"),
        round_half_even(rating, 4).alias("rating_normalized"),
        round_half_even(F.lit(RATING_WEIGHT) * rating + F.lit(FREQUENCY_WEIGHT) * frequency, 4).alias(
            "user_item_affinity"
        ),
    )


# What each stored feature is.
# (feature_name, feature_table, feature_type, transformation, description, source_columns)
FEATURE_REGISTRY = [
    ("purchase_count", "user_features", "numeric", "count", "Total number of orders placed", "order_id"),
    ("total_spending", "user_features", "numeric", "sum", "Sum of all item prices (BRL)", "price"),
    ("avg_order_value", "user_features", "numeric", "mean", "Mean price per purchased item", "price"),
    ("avg_rating_given", "user_features", "numeric", "mean", "Mean review score given by user (1-5)", "review_score"),
    ("review_count", "user_features", "numeric", "count", "Number of reviews submitted", "review_score"),
    ("distinct_products", "user_features", "numeric", "nunique", "Unique products purchased", "product_id"),
    ("distinct_categories", "user_features", "numeric", "nunique", "Unique categories purchased", "category_english"),
    ("preferred_category", "user_features", "categorical", "mode", "Most frequently purchased category", "category_english"),
    ("avg_freight", "user_features", "numeric", "mean", "Mean shipping cost per item", "freight_value"),
    ("customer_state", "user_features", "categorical", "first", "Customer state code", "customer_state"),
    ("recency_days", "user_features", "numeric", "derived", "Days since last purchase relative to dataset end", "order_purchase_timestamp"),
    ("purchase_freq_log", "user_features", "numeric", "log1p", "Log-transformed purchase count", "purchase_count"),
    ("spending_log", "user_features", "numeric", "log1p", "Log-transformed total spending", "total_spending"),
    ("spending_normalized", "user_features", "numeric", "min-max [0,1]", "Normalized total spending", "total_spending"),
    ("aov_normalized", "user_features", "numeric", "min-max [0,1]", "Normalized avg order value", "avg_order_value"),
    ("total_sold", "item_features", "numeric", "count", "Total units sold", "order_id"),
    ("avg_rating_received", "item_features", "numeric", "mean", "Mean review score received (1-5)", "review_score"),
    ("review_count", "item_features", "numeric", "count", "Number of reviews received", "review_score"),
    ("avg_price", "item_features", "numeric", "mean", "Mean selling price (BRL)", "price"),
    ("total_revenue", "item_features", "numeric", "sum", "Total revenue generated", "price"),
    ("distinct_buyers", "item_features", "numeric", "nunique", "Number of unique buyers", "customer_unique_id"),
    ("product_volume_cm3", "item_features", "numeric", "derived (LxHxW)", "Product volume in cm3", "product_length/height/width_cm"),
    ("popularity_rank", "item_features", "numeric", "rank", "Rank by total_sold (1 = most popular)", "total_sold"),
    ("price_percentile", "item_features", "numeric", "rank(pct)", "Price percentile [0,1]", "avg_price"),
    ("price_normalized", "item_features", "numeric", "min-max [0,1]", "Normalized average price", "avg_price"),
    ("sold_normalized", "item_features", "numeric", "min-max [0,1]", "Normalized sales volume", "total_sold"),
    ("rating_normalized", "item_features", "numeric", "min-max [0,1]", "Normalized average rating", "avg_rating_received"),
    ("is_cat_*", "item_features", "binary", "one-hot", "One-hot encoding for top 10 categories + other", "category_english"),
    ("rating", "interaction_features", "numeric", "mean", "Explicit rating (review score)", "review_score"),
    ("purchase_count", "interaction_features", "numeric", "count", "Times user bought this item", "order_id"),
    ("implicit_signal", "interaction_features", "binary", "flag", "1 if purchased, 0 otherwise", "order_id"),
    ("rating_normalized", "interaction_features", "numeric", "min-max [0,1]", "Normalized rating", "rating"),
    ("user_item_affinity", "interaction_features", "numeric", "weighted (0.6xrating + 0.4xfreq)", "Composite affinity score", "rating, purchase_count"),
]


def feature_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        FEATURE_REGISTRY,
        "feature_name string, feature_table string, feature_type string, "
        "transformation string, description string, source_columns string",
    )


def filled_counts(table: DataFrame, table_name: str) -> DataFrame:
    """Non-NULL rows of every column of a feature table; one-hot columns count as one feature."""
    plain = [c for c in table.columns if not c.startswith("is_cat_")]
    flags = [c for c in table.columns if c.startswith("is_cat_")]
    counts = [F.count(c).alias(c) for c in plain]
    if flags:
        counts.append(F.count(flags[0]).alias("is_cat_*"))
    wide = table.agg(*counts)
    return wide.unpivot([], wide.columns, "feature_name", "n_filled").withColumn("feature_table", F.lit(table_name))


def registry_with_counts(registry: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """The registry with the number of filled rows of each feature in the stored tables."""
    counts = None
    for name, table in tables.items():
        part = filled_counts(table, name)
        counts = part if counts is None else counts.unionByName(part)
    return registry.join(counts, ["feature_table", "feature_name"], "left")


def feature_summary(registry: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Per feature table: registered features, columns and rows."""
    sizes = None
    for name, table in tables.items():
        part = table.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("feature_table"), F.lit(len(table.columns)).alias("n_columns"), "n_rows"
        )
        sizes = part if sizes is None else sizes.unionByName(part)
    registered = registry.groupBy("feature_table").agg(F.count("*").alias("n_registered"))
    return sizes.join(registered, "feature_table", "left").select(
        "feature_table", F.coalesce("n_registered", F.lit(0)).alias("n_registered"), "n_columns", "n_rows"
    )
