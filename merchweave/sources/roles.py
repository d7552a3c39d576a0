"""Source tables of the shop, read from the star-schema Parquet files.

Each function gives one of the nine source tables. Gaps, repeated reviews and
untranslated categories are derived from the keys, because the files have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared, so that opening a table starts no job to infer its schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Categories without a translation.
UNTRANSLATED = ["Brand#7", "Brand#19"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[table]) if table in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{table}.parquet")


def _minutes(n):
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"), F.lit(0))


def _days(n: int):
    return F.make_dt_interval(F.lit(n), F.lit(0), F.lit(0), F.lit(0))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, as in the shop's export: customer_id belongs to an order."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    people = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    places = _places(spark, sf_dir)
    return (
        orders.join(people, orders.o_custkey == people.c_custkey)
        .join(places, people.c_nationkey == places.n_nationkey)
        .select(
            F.col("o_orderkey").alias("customer_id"),
            F.col("o_custkey").alias("customer_unique_id"),
            F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
            F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("customer_city"),
            F.lower("r_name").alias("customer_state"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    gap = key % 50 == 0
    return read(spark, sf_dir, "part").select(
        key.alias("product_id"),
        F.when(~gap, F.col("p_brand")).alias("product_category_name"),
        F.length("p_name").cast("double").alias("product_name_lenght"),
        F.when(~gap, F.col("p_size") * 10).cast("double").alias("product_description_lenght"),
        F.when(~gap, key % 7).cast("double").alias("product_photos_qty"),
        F.when(key % 40 != 0, F.col("p_size") * 100).cast("double").alias("product_weight_g"),
        (F.col("p_size") + 5).cast("double").alias("product_length_cm"),
        (F.col("p_size") % 20 + 2).cast("double").alias("product_height_cm"),
        (F.col("p_size") % 30 + 6).cast("double").alias("product_width_cm"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "part")
        .select(F.col("p_brand").alias("product_category_name"))
        .filter(~F.col("product_category_name").isin(UNTRANSLATED))
        .distinct()
        .withColumn(
            "product_category_name_english",
            F.lower(F.regexp_replace("product_category_name", "#", "_")),
        )
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    delivered = F.col("o_orderstatus") == "F"
    return read(spark, sf_dir, "orders").select(
        key.alias("order_id"),
        key.alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        (day + _minutes(key % 1440)).alias("order_purchase_timestamp"),
        F.when(key % 25 != 0, day).alias("order_approved_at"),
        F.when(F.col("o_orderstatus") != "P", day + _days(3)).alias("order_delivered_carrier_date"),
        F.when(delivered, day + _days(9)).alias("order_delivered_customer_date"),
        (day + _days(20)).alias("order_estimated_delivery_date"),
    )


def orders_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as an untyped export: timestamps are text and some are unreadable."""
    df = orders(spark, sf_dir)
    stamp = F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss")
    approved = F.date_format("order_approved_at", "yyyy-MM-dd HH:mm:ss")
    return df.select(
        "order_id",
        "customer_id",
        "order_status",
        F.when(F.col("order_id") % 60 == 0, F.lit("not a date")).otherwise(stamp).alias("order_purchase_timestamp"),
        approved.alias("order_approved_at"),
        *[
            F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
            for c in (
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            )
        ],
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review for most orders, and a second one for some (a fan-out on the join)."""
    key, who, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    second_too = F.when(key % 97 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    first = F.col("nth") == 0
    return (
        read(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        .filter(key % 10 != 0)
        .withColumn("nth", F.explode(second_too))
        .select(
            (key * 10 + F.col("nth")).alias("review_id"),
            key.alias("order_id"),
            F.when(first, (key * 7 + who) % 5 + 1).otherwise((key * 3 + who) % 5 + 1).cast("int").alias("review_score"),
            F.when(first & (key % 4 != 0), F.col("o_orderpriority")).alias("review_comment_title"),
            F.when(first & (key % 3 != 0), F.col("o_orderpriority")).alias("review_comment_message"),
            (day + _days(12)).alias("review_creation_date"),
            (day + _days(14)).alias("review_answer_timestamp"),
        )
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    # Payment types by remainder.
    kinds = F.array(*[F.lit(k) for k in ("credit_card", "boleto", "voucher", "debit_card")])
    return (
        read(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice")
        .withColumn("seq", F.explode(F.sequence(F.lit(1), (key % 3 + 1).cast("int"))))
        .select(
            key.alias("order_id"),
            F.col("seq").alias("payment_sequential"),
            F.element_at(kinds, ((key + F.col("seq")) % 4 + 1).cast("int")).alias("payment_type"),
            (key % 12).cast("int").alias("payment_installments"),
            F.when(F.col("seq") == 1, F.col("o_totalprice")).otherwise(F.col("seq").cast("double")).alias("payment_value"),
        )
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read(spark, sf_dir, "supplier")
    places = _places(spark, sf_dir)
    return supplier.join(places, supplier.s_nationkey == places.n_nationkey).select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed points per zip prefix; row_id is the order in the file."""
    people = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    places = _places(spark, sf_dir)
    return people.join(places, people.c_nationkey == places.n_nationkey).select(
        F.col("c_custkey").alias("row_id"),
        F.col("c_nationkey").cast("string").alias("geolocation_zip_code_prefix"),
        (F.col("c_custkey") % 100 - 70).cast("double").alias("geolocation_lat"),
        (-(F.col("c_custkey") % 80)).cast("double").alias("geolocation_lng"),
        F.col("n_name").alias("geolocation_city"),
        F.col("r_name").alias("geolocation_state"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored (user, item) pairs for the ranking metrics."""
    uid, iid = F.col("uid"), F.col("iid")
    return (
        read(spark, sf_dir, "lineitem")
        .select(F.col("l_suppkey").alias("uid"), F.col("l_partkey").alias("iid"))
        .distinct()
        .select(
            "uid",
            "iid",
            ((iid + uid) % 5 + 1).cast("double").alias("true_rating"),
            (((iid * 13 + uid * 7) % 97) / 10).cast("double").alias("pred_rating"),
        )
    )


ROLES = {
    "customers": customers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "reviews": reviews,
    "payments": payments,
    "sellers": sellers,
    "geolocation": geolocation,
    "categories": categories,
}
