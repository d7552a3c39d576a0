"""Cleaning of the source tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchweave.functions.ordering import exact_medians
from merchweave.functions.scalars import money_sum

ORDER_TIMESTAMPS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]
IMPUTED = [
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]
UNKNOWN = "unknown"


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``.

    An aggregate rather than a window, so each task sends one row per key and a
    key with most of the rows is no heavier than any other.
    """
    rest = [c for c in df.columns if c not in key]
    ranked = F.struct(*order, *[c for c in rest if c not in order])
    return (
        df.groupBy(*key)
        .agg(F.min(ranked).alias("_first"))
        .select(*[F.col(c) if c in key and c not in order else F.col(f"_first.{c}") for c in df.columns])
    )


def clean_customers(customers: DataFrame, order: Sequence[str] = ("customer_id",)) -> DataFrame:
    return tidy_places(keep_first(customers, ["customer_unique_id"], list(order)))


def tidy_places(customers: DataFrame) -> DataFrame:
    return customers.withColumns(
        {
            "customer_city": F.lower(F.trim("customer_city")),
            "customer_state": F.upper(F.trim("customer_state")),
        }
    )


def translate_categories(products: DataFrame, categories: DataFrame) -> DataFrame:
    named = products.join(
        categories.select("product_category_name", "product_category_name_english"),
        "product_category_name",
        "left",
    )
    return named.select(
        *[c for c in products.columns if c != "product_category_name"],
        F.coalesce("product_category_name", F.lit(UNKNOWN)).alias("product_category_name"),
        F.coalesce("product_category_name_english", F.lit(UNKNOWN)).alias("category_english"),
    )


def impute_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULLs with the exact median of the column."""
    medians = exact_medians(df, columns)
    lookup = medians.agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", "median"))).alias("medians")
    ).scalar()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), lookup[c]) for c in columns})


def clean_products(
    products: DataFrame, categories: DataFrame, impute: Sequence[str] = tuple(IMPUTED)
) -> DataFrame:
    return translate_categories(impute_medians(products, [c for c in impute if c in products.columns]), categories)


def clean_orders(orders: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """Parse the timestamps; text that is no timestamp becomes NULL. No status is dropped by default."""
    parsed = orders.withColumns(
        {
            f.name: F.col(f.name).try_cast("timestamp_ntz")
            for f in orders.schema
            if f.name in ORDER_TIMESTAMPS and not isinstance(f.dataType, T.TimestampNTZType)
        }
    )
    return parsed.filter(F.col("order_status").isin(list(statuses))) if statuses else parsed


def clean_reviews(reviews: DataFrame) -> DataFrame:
    message = F.coalesce("review_comment_message", F.lit(""))
    return reviews.withColumns(
        {
            "review_score": F.col("review_score").cast("int"),
            "review_comment_title": F.coalesce("review_comment_title", F.lit("")),
            "review_comment_message": message,
            "has_review_text": (F.length(message) > 0).cast("int"),
        }
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    return (
        payments.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            money_sum(F.col("payment_value")).alias("total_payment"),
            F.max("payment_sequential").alias("num_payments"),
            F.min_by(
                "payment_type",
                F.when(F.col("payment_type").isNotNull(), F.col("payment_sequential")),
            ).alias("primary_payment_type"),
        )
    )


# Bounding box of valid points.
LATITUDES = (-60.0, 10.0)
LONGITUDES = (-80.0, -30.0)


def clean_geolocation(points: DataFrame, order: Sequence[str] = ("row_id",)) -> DataFrame:
    """First point of every zip prefix, then only those inside the box."""
    first = keep_first(points, ["geolocation_zip_code_prefix"], list(order))
    return first.filter(
        F.col("geolocation_lat").between(*LATITUDES) & F.col("geolocation_lng").between(*LONGITUDES)
    )


def distinct_complete(df: DataFrame) -> DataFrame:
    return df.na.drop().distinct()
