"""Registered queries: one function per operator, over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchweave.functions.ordering import ranked_values
from merchweave.functions.scalars import (
    bounds_of,
    elapsed_days,
    human_size,
    mean_of_money,
    money_sum,
    round_doubles,
    round_half_even,
    scale_between,
    source_name,
)
from merchweave.operators import (
    cleaning,
    cooccurrence,
    corating,
    eda,
    factorization,
    features,
    metrics,
    neighbours,
    places,
    quality,
    ratings,
    recommend,
    text,
    timing,
    transactions,
)
from merchweave.plans.pipeline import Shop
from merchweave.session import configure, staged
from merchweave.sources import files, lake, models, roles, store
from merchweave.streaming import events

Query = Callable[[Shop], DataFrame]
QUERIES: dict[str, Query] = {}

# Categories with their own 0/1 column in the star-schema tables.
ONE_HOT = ["brand_1", "brand_2", "brand_3", "brand_4", "brand_5", "brand_6", "brand_8", "brand_9", "brand_10", "brand_11"]
# The three groups of the category report, in this shop's names.
REPORT_GROUPS = {1: ["brand_1"], 2: ["brand_1", "brand_2"], 3: ["brand_3", "brand_4", "brand_5"]}
RAW_TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]
SAMPLE_PERCENT = 10.0
TRAINING_SAMPLE = 1000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query):
        return lambda spark, sf_dir: fn(Shop(configure(spark), sf_dir, ONE_HOT))

    return {name: bind(fn) for name, fn in QUERIES.items()}


# ---- sources and lake ----


@query
def latest_partition(shop: Shop) -> DataFrame:
    """Events landed by date; the newest date is read back."""
    root = shop.scratch("landing")
    stamped = shop.table("events").withColumn("ingest_date", F.to_date("ts"))
    files.write_table(stamped, root, partition_by=["ingest_date"])
    return files.latest_partition(shop.spark.read.parquet(root)).drop("ingest_date")


@query
def json_flatten(shop: Shop) -> DataFrame:
    parsed = files.parse_json_column(shop.table("events").select("event_id", "props"), "props", "struct<k:int>")
    return parsed


@query
def payload_shapes(shop: Shop) -> DataFrame:
    """The orders as responses of four shapes in one folder, by the remainder of their key, read back as one table."""
    lines = F.struct("l_partkey", F.struct(F.col("l_quantity").cast("int").alias("n"), "l_returnflag").alias("ship"))
    rows = shop.table("lineitem").withColumn("kind", F.col("l_orderkey") % 4)
    text = (
        F.when(F.col("kind") == 0, F.to_json(F.collect_list(lines)))
        .when(F.col("kind") == 1, F.to_json(F.max(lines)))
        .when(F.col("kind") == 2, F.to_json(F.collect_list("l_returnflag")))
        .otherwise(F.count("*").cast("string"))
    )
    folder = shop.scratch("payloads")
    rows.groupBy("l_orderkey", "kind").agg(text.alias("text")).select("text").write.text(folder)
    table = files.payload_table(files.payload_rows(shop.spark, folder, whole_files=False), "modes")
    keys = ["shape", "l_partkey", "ship.n", "ship.l_returnflag", "modes", "value"]
    return table.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.count("*").alias("n_rows"))


def _raw_sources(shop: Shop) -> dict:
    sources = {name: (lambda n=name: shop.table(n)) for name in RAW_TABLES}
    sources["absent"] = lambda: shop.table("absent")
    return sources


@query
def ingest_audit(shop: Shop) -> DataFrame:
    audit = lake.ingest_all(shop.spark, _raw_sources(shop), shop.scratch("raw"), "2024-01-01")
    return audit.select(
        "source_name", "row_count", "status", F.array_join("columns", ",").alias("columns"), "column_count"
    )


@query
def ingest_summary(shop: Shop) -> DataFrame:
    return lake.run_summary(lake.ingest_all(shop.spark, _raw_sources(shop), shop.scratch("raw"), "2024-01-01"))


@query
def lake_catalog(shop: Shop) -> DataFrame:
    root = shop.scratch("raw")
    lake.ingest_all(shop.spark, _raw_sources(shop), root, "2024-01-01")
    return lake.lake_catalog(shop.spark, root)


@query
def lake_stats(shop: Shop) -> DataFrame:
    root = shop.scratch("raw")
    audit = lake.ingest_all(shop.spark, _raw_sources(shop), root, "2024-01-01")
    return lake.lake_stats(lake.lake_catalog(shop.spark, root), audit)


# Numbers inside arrays have no text form that every engine shares.
CHECKED = [t for t in RAW_TABLES if t != "embeddings"]


@query
def checksum_verify(shop: Shop) -> DataFrame:
    root = shop.scratch("raw")
    audit = lake.ingest_all(shop.spark, {n: (lambda n=n: shop.table(n)) for n in CHECKED}, root, "2024-01-01")
    # The audit of one table is withheld, so it has nothing to be compared with; another one changes after landing.
    known = audit.filter(F.col("source_name") != "labels")
    landed = {n: lake.read_landed(shop.spark, root, n) for n in CHECKED}
    landed["nation"] = landed["nation"].withColumn("n_name", F.lower("n_name"))
    return lake.verify_checksums(landed, known).select("source_name", "actual_rows", "actual_checksum", "result")


@query
def human_size_text(shop: Shop) -> DataFrame:
    n = F.col("n_chars") * F.col("n_chars") * F.col("doc_id")
    return shop.table("documents").select("doc_id", n.alias("n_bytes"), human_size(n).alias("size_human"))


@query
def source_names(shop: Shop) -> DataFrame:
    parts = [
        shop.table(t).select(source_name(F.input_file_name(), suffix="s").alias("source_name")).groupBy("source_name").agg(F.count("*").alias("n_rows"))
        for t in RAW_TABLES
    ]
    return quality.union_all(parts)


@query
def sample_rows(shop: Shop) -> DataFrame:
    return files.sample_percent(shop.role("orders").select("order_id", "order_status"), SAMPLE_PERCENT, ["order_id"])


@query
def constraint_check(shop: Shop) -> DataFrame:
    tables = {
        "user_features": features.user_aggregates(shop.lines).filter(F.col("customer_unique_id").isNotNull()),
        "item_features": features.item_aggregates(shop.lines),
        "interaction_features": shop.interactions,
        "orders": shop.orders,
        "order_items": shop.role("order_items"),
    }
    return quality.constraint_checks(
        tables,
        primary_keys={
            "user_features": ["customer_unique_id"],
            "item_features": ["product_id"],
            "interaction_features": ["customer_unique_id", "product_id"],
            "order_items": ["order_id", "order_item_id"],
        },
        foreign_keys=[
            ("interaction_features", "customer_unique_id", "user_features", "customer_unique_id"),
            ("interaction_features", "product_id", "item_features", "product_id"),
            ("orders", "order_id", "order_items", "order_id"),
        ],
        not_null={"user_features": ["purchase_count", "total_spending"], "orders": ["order_status", "order_approved_at"]},
    )


# ---- quality ----

# Expectations that fit the star-schema tables, with some that fail on purpose.
SPECS = {
    **quality.EXPECTATIONS,
    "orders": quality.Expectation(
        quality.EXPECTATIONS["orders"].columns, unique=["order_id", "customer_id"], allowed={"order_status": ["F", "O"]}
    ),
    "customers": quality.Expectation(
        [*quality.EXPECTATIONS["customers"].columns, "customer_email"], unique=["customer_unique_id"]
    ),
    "order_items": quality.Expectation(
        [c for c in quality.EXPECTATIONS["order_items"].columns if c != "freight_value"],
        ranges={"price": (1000, 100000), "freight_value": (2, 49), "order_item_id": (1, 50)},
    ),
}


def _checks(shop: Shop) -> DataFrame:
    return quality.validate(shop.sources, SPECS, shop.spark)


# What the raw files should hold, with a column too many, one too few and one of another type on purpose.
FILE_COLUMNS = {
    **roles.SCHEMAS,
    "customer": roles.SCHEMAS["customer"] + ", c_email string",
    "lineitem": roles.SCHEMAS["lineitem"].replace("l_tax double, ", ""),
    "documents": roles.SCHEMAS["documents"].replace("n_chars bigint", "n_chars int"),
}


@query
def dq_schema(shop: Shop) -> DataFrame:
    paths = {t: f"{shop.sf_dir}/{t}.parquet" for t in RAW_TABLES}
    return quality.check_files(shop.spark, paths, {t: T.StructType.fromDDL(FILE_COLUMNS[t]) for t in RAW_TABLES})


@query
def dq_missing(shop: Shop) -> DataFrame:
    return quality.union_all([quality.missing_values(df, t) for t, df in shop.sources.items()])


@query
def dq_completeness(shop: Shop) -> DataFrame:
    return quality.union_all([quality.completeness(df, t) for t, df in shop.sources.items()])


@query
def dq_full_dupes(shop: Shop) -> DataFrame:
    return quality.union_all([quality.check_full_duplicates(df, t) for t, df in shop.sources.items()])


@query
def dq_key_dupes(shop: Shop) -> DataFrame:
    return quality.union_all(
        [quality.check_unique(shop.sources[t], t, c) for t, s in SPECS.items() for c in s.unique]
    )


@query
def dq_range(shop: Shop) -> DataFrame:
    return quality.union_all(
        [quality.check_ranges(shop.sources[t], t, s.ranges) for t, s in SPECS.items() if s.ranges]
    )


@query
def dq_allowed(shop: Shop) -> DataFrame:
    return quality.union_all(
        [quality.check_allowed(shop.sources[t], t, s.allowed) for t, s in SPECS.items() if s.allowed]
    )


@query
def dq_unexpected_values(shop: Shop) -> DataFrame:
    return quality.union_all(
        [quality.unexpected_values(shop.sources[t], t, s.allowed) for t, s in SPECS.items() if s.allowed]
    )


@query
def column_profile(shop: Shop) -> DataFrame:
    """Type, filled and missing values of every column of the raw tables."""
    return quality.union_all([quality.profile_columns(shop.table(t), t) for t in RAW_TABLES])


@query
def profile_numeric(shop: Shop) -> DataFrame:
    return quality.union_all(
        [quality.profile_numeric(df, t) for t, df in shop.sources.items() if quality.numeric_columns(df)]
    )


@query
def profile_categorical(shop: Shop) -> DataFrame:
    return quality.union_all(
        [quality.profile_categorical(df, t) for t, df in shop.sources.items() if quality.text_columns(df)]
    )


@query
def dq_status(shop: Shop) -> DataFrame:
    return quality.table_status(_checks(shop))


@query
def dq_summary(shop: Shop) -> DataFrame:
    return quality.quality_summary(quality.facts_of(shop.sources, SPECS, shop.spark))


@query
def dq_issues(shop: Shop) -> DataFrame:
    return quality.open_issues(_checks(shop))


@query
def stage_success(shop: Shop) -> DataFrame:
    """Share of tables whose validation did not end in an error."""
    status = F.when(F.col("overall_status") == quality.ERROR, F.lit("FAILED")).otherwise(F.lit("SUCCESS"))
    return metrics.success_rate(quality.table_status(_checks(shop)).withColumn("status", status))


# ---- cleaning ----


@query
def dedupe_keep_first(shop: Shop) -> DataFrame:
    return cleaning.keep_first(shop.role("customers"), ["customer_unique_id"], ["customer_id"])


@query
def clean_customers(shop: Shop) -> DataFrame:
    return shop.customers


@query
def clean_products(shop: Shop) -> DataFrame:
    return shop.products


@query
def impute_median(shop: Shop) -> DataFrame:
    return cleaning.impute_medians(shop.role("products"), cleaning.IMPUTED)


@query
def clean_orders(shop: Shop) -> DataFrame:
    return cleaning.clean_orders(roles.orders_as_text(shop.spark, shop.sf_dir))


@query
def filter_status(shop: Shop) -> DataFrame:
    return cleaning.clean_orders(shop.role("orders"), ["F", "O"])


@query
def clean_reviews(shop: Shop) -> DataFrame:
    return shop.reviews


@query
def geo_clean(shop: Shop) -> DataFrame:
    return cleaning.clean_geolocation(shop.role("geolocation"))


@query
def txn_time_parts(shop: Shop) -> DataFrame:
    return transactions.with_time_parts(shop.orders.select("order_id", "order_purchase_timestamp"))


@query
def minmax_scale(shop: Shop) -> DataFrame:
    df = shop.role("payments").select("order_id", "payment_sequential", "payment_value")
    bounds = bounds_of(df, "payment_value")
    scaled = scale_between(F.col("payment_value"), bounds["payment_value_lo"], bounds["payment_value_hi"])
    return df.withColumn("scaled", round_half_even(scaled, 6))


@query
def log_features(shop: Shop) -> DataFrame:
    spent = shop.role("order_items").groupBy("order_id").agg(money_sum(F.col("price")).alias("spent"))
    return spent.withColumn("spent_log", round_half_even(F.log1p("spent"), 4))


@query
def one_hot(shop: Shop) -> DataFrame:
    return features.one_hot(shop.product_categories, ONE_HOT)


@query
def recency(shop: Shop) -> DataFrame:
    latest = shop.orders.agg(F.max("order_purchase_timestamp")).scalar()
    return shop.orders.select(
        "order_id", elapsed_days(latest, F.col("order_purchase_timestamp")).alias("recency_days")
    )


@query
def dense_ids(shop: Shop) -> DataFrame:
    return ratings.dense_ids(shop.table("customer"), "c_name", "code")


# ---- joins ----


@query
def join_inner(shop: Shop) -> DataFrame:
    return transactions.orders_with_items(shop.orders, shop.role("order_items"))


@query
def join_left_fanout(shop: Shop) -> DataFrame:
    lines = transactions.orders_with_items(shop.orders, shop.role("order_items"))
    return transactions.with_reviews(lines, shop.reviews).select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "review_score", "has_review_text"
    )


@query
def transaction_table(shop: Shop) -> DataFrame:
    return shop.transactions


QUERIES["transactions"] = QUERIES.pop("transaction_table")


@query
def transactions_all_orders(shop: Shop) -> DataFrame:
    return shop.transactions_all_orders


def _merged(shop: Shop) -> DataFrame:
    return (
        shop.role("reviews")
        .select("order_id", "review_score")
        .join(shop.role("orders").select("order_id", "customer_id"), "order_id")
        .join(shop.role("order_items").select("order_id", "product_id", "price"), "order_id")
        .join(shop.role("customers").select("customer_id", "customer_unique_id"), "customer_id")
        .join(shop.role("products").select("product_id", "product_category_name", "product_photos_qty"), "product_id")
        .join(shop.role("categories"), "product_category_name")
        .select(
            "order_id",
            "customer_unique_id",
            "product_id",
            "product_category_name_english",
            "review_score",
            "price",
            "product_photos_qty",
        )
    )


@query
def merged_inner(shop: Shop) -> DataFrame:
    return _merged(shop)


@query
def distinct_dropna(shop: Shop) -> DataFrame:
    rows = shop.role("reviews").select("review_score", "review_comment_title", "review_comment_message")
    return cleaning.distinct_complete(rows)


@query
def interaction_category(shop: Shop) -> DataFrame:
    return transactions.with_category(shop.interactions, shop.product_categories)


@query
def multi_category_users(shop: Shop) -> DataFrame:
    pairs = transactions.with_category(shop.interactions, shop.product_categories)
    return transactions.multi_category_users(pairs)


@query
def unseen_items(shop: Shop) -> DataFrame:
    """Products no known user has bought."""
    return shop.product_categories.join(shop.interactions.select("product_id"), "product_id", "left_anti")


def _disliked(shop: Shop) -> DataFrame:
    """Pairs a user scored lowest in any order."""
    return shop.all_lines.filter(F.col("review_score") == 1).select("customer_unique_id", "product_id")


@query
def exclusion_union(shop: Shop) -> DataFrame:
    return recommend.seen_items(shop.interactions, _disliked(shop))


# ---- aggregates and features ----


@query
def payments_per_order(shop: Shop) -> DataFrame:
    return shop.payments


@query
def interactions(shop: Shop) -> DataFrame:
    return shop.interactions


@query
def user_features(shop: Shop) -> DataFrame:
    return shop.user_features


@query
def user_features_all_orders(shop: Shop) -> DataFrame:
    return features.build_user_features(shop.all_lines)


@query
def mode_agg(shop: Shop) -> DataFrame:
    lines = shop.role("order_items").join(shop.product_categories, "product_id", "left")
    return lines.groupBy("order_id").agg(
        F.coalesce(F.mode("category_english", True), F.lit("unknown")).alias("preferred_category")
    )


@query
def item_features(shop: Shop) -> DataFrame:
    return shop.item_features


@query
def interaction_features(shop: Shop) -> DataFrame:
    return shop.interaction_features


@query
def popularity_rank(shop: Shop) -> DataFrame:
    sold = staged(shop.role("order_items").groupBy("product_id").agg(F.count("*").alias("total_sold")), "sold")
    return features.popularity_rank(sold, ranked_values(sold, ["total_sold"]))


@query
def price_percentile(shop: Shop) -> DataFrame:
    priced = staged(
        shop.role("order_items").groupBy("product_id").agg(mean_of_money(F.col("price")).alias("avg_price")), "priced"
    )
    return round_doubles(features.price_percentile(priced, ranked_values(priced, ["avg_price"])))


@query
def sparsity(shop: Shop) -> DataFrame:
    return transactions.matrix_stats(shop.interactions)


@query
def prep_summary(shop: Shop) -> DataFrame:
    return eda.preparation_summary(shop.lines, shop.interactions)


@query
def feature_registry(shop: Shop) -> DataFrame:
    """The registry with the filled rows of every feature in the computed tables."""
    return features.registry_with_counts(features.feature_registry(shop.spark), shop.feature_tables)


@query
def feature_summary(shop: Shop) -> DataFrame:
    return features.feature_summary(features.feature_registry(shop.spark), shop.feature_tables)


@query
def group_stats(shop: Shop) -> DataFrame:
    return store.group_stats(shop.feature_tables)


# ---- exploratory ----


@query
def eda_score_dist(shop: Shop) -> DataFrame:
    return eda.score_distribution(shop.lines)


@query
def eda_top_categories(shop: Shop) -> DataFrame:
    return eda.top_categories(shop.lines)


@query
def eda_long_tail(shop: Shop) -> DataFrame:
    return eda.long_tail(shop.lines)


@query
def eda_user_activity(shop: Shop) -> DataFrame:
    return eda.user_activity(shop.interactions)


@query
def eda_monthly(shop: Shop) -> DataFrame:
    return eda.monthly_volume(shop.lines)


@query
def eda_heatmap(shop: Shop) -> DataFrame:
    return eda.purchase_heatmap(transactions.with_time_parts(shop.lines))


@query
def eda_price_hist(shop: Shop) -> DataFrame:
    """Prices here are far above those of the source shop, so the cap is too."""
    return eda.price_histogram(shop.lines, cap=50000.0)


@query
def eda_payment_share(shop: Shop) -> DataFrame:
    return eda.payment_share(
        transactions.with_reviews(
            transactions.orders_with_items(shop.orders, shop.role("order_items")), shop.reviews
        ).join(shop.payments, "order_id", "left")
    )


# ---- feature store ----


def _snapshot_registry(shop: Shop) -> DataFrame:
    """One snapshot at the last purchase of every month."""
    stamp = F.col("order_purchase_timestamp")
    return (
        shop.orders.groupBy(F.date_format(stamp, "'v_'yyyyMM").alias("snapshot_id"))
        .agg(F.max(stamp).alias("created_at"))
    )


@query
def snapshot_list(shop: Shop) -> DataFrame:
    return store.snapshot_list(_snapshot_registry(shop))


@query
def asof_snapshot(shop: Shop) -> DataFrame:
    moments = shop.orders.select("order_id", F.col("order_approved_at").alias("at")).filter(F.col("at").isNotNull())
    return store.snapshots_for(moments, staged(_snapshot_registry(shop), "registry"))


@query
def training_set(shop: Shop) -> DataFrame:
    # Of the user features only the number of categories is computed.
    return store.training_set(shop.interaction_features, features.user_aggregates(shop.lines))


@query
def training_set_wide(shop: Shop) -> DataFrame:
    tables = shop.feature_tables
    return store.training_set_wide(*[tables[t] for t in ("interaction_features", "user_features", "item_features")])


@query
def training_sample(shop: Shop) -> DataFrame:
    rows = shop.training.select("customer_unique_id", "product_id", "rating")
    return files.sample_rows(rows, TRAINING_SAMPLE, ["customer_unique_id", "product_id"])


@query
def distinct_ids(shop: Shop) -> DataFrame:
    return files.first_ids(shop.interactions, "customer_unique_id")


@query
def feature_lookup(shop: Shop) -> DataFrame:
    users = shop.user_features
    return files.rows_for_ids(users, "customer_unique_id", files.first_ids(users, "customer_unique_id"))


@query
def user_interactions(shop: Shop) -> DataFrame:
    """All interactions of one user, the one with the smallest id."""
    pairs = shop.interactions
    return pairs.filter(F.col("customer_unique_id") == pairs.agg(F.min("customer_unique_id")).scalar())


@query
def store_status(shop: Shop) -> DataFrame:
    from datetime import datetime

    kept = store.FeatureStore(shop.spark, shop.scratch("store"))
    kept.register(shop.feature_tables, datetime(2024, 1, 1, 12, 0, 0))
    return kept.status().select("snapshot_id", "feature_table", "row_count", "column_count", "is_latest")


# ---- model and recommendations ----


@query
def train_test_split(shop: Shop) -> DataFrame:
    return shop.training.select("customer_unique_id", "product_id", "split")


@query
def train_grid(shop: Shop) -> DataFrame:
    return recommend.train_grid(shop.training, shop.train)


@query
def user_category_grid(shop: Shop) -> DataFrame:
    return recommend.wide_grid(shop.model_grid, ONE_HOT)


@query
def popular_categories(shop: Shop) -> DataFrame:
    return round_doubles(recommend.popular_categories(shop.model_grid), 6)


@query
def item_mean_rating(shop: Shop) -> DataFrame:
    return round_doubles(recommend.item_mean_ratings(shop.training), 6)


@query
def top2_per_category(shop: Shop) -> DataFrame:
    items = recommend.items_by_category(shop.training).filter(F.col("item_place") <= recommend.PER_CATEGORY)
    return round_doubles(items, 6)


EVALUATED = 5


def _evaluated(shop: Shop) -> tuple[neighbours.Profiles, DataFrame]:
    profiles = neighbours.build_profiles(shop.model_grid, EVALUATED + 1)
    return profiles, neighbours.owner_neighbours(profiles, EVALUATED)


@query
def knn_users(shop: Shop) -> DataFrame:
    return neighbours.neighbour_rows(_evaluated(shop)[1], "customer_unique_id")


@query
def neighbour_scores(shop: Shop) -> DataFrame:
    return recommend.neighbour_scores(_evaluated(shop)[1], shop.model_grid)


def _scored(shop: Shop) -> tuple[neighbours.Profiles, DataFrame]:
    profiles, lists = _evaluated(shop)
    return profiles, recommend.neighbour_scores(lists, shop.model_grid)


def _precision_recall(shop: Shop, profiles: neighbours.Profiles, scores: DataFrame) -> DataFrame:
    liked = shop.test.filter(F.col("rating") >= metrics.RELEVANT)
    users = shop.model_grid.select("customer_unique_id").distinct()
    return metrics.neighbour_precision_recall(scores, liked, users, recommend.catalogue_of(profiles), EVALUATED)


@query
def knn_precision_recall(shop: Shop) -> DataFrame:
    return _precision_recall(shop, *_scored(shop))


def _ndcg(shop: Shop, profiles: neighbours.Profiles, scores: DataFrame) -> DataFrame:
    eligible = (
        shop.test.filter(F.col("rating") >= metrics.RELEVANT)
        .select("customer_unique_id")
        .distinct()
        .join(shop.model_grid.select("customer_unique_id"), "customer_unique_id", "left_semi")
    )
    truth = (
        shop.test.join(eligible, "customer_unique_id", "left_semi")
        .join(profiles.index.select(F.col("category").alias("category_english")), "category_english", "left_semi")
        .groupBy("customer_unique_id", "category_english")
        .agg(F.max_by("rating", "product_id").alias("gain"))
    )
    return metrics.neighbour_ndcg(scores, truth, profiles.index.agg(F.count("*")).scalar(), EVALUATED)


@query
def knn_ndcg(shop: Shop) -> DataFrame:
    return _ndcg(shop, *_scored(shop))


def _knn_means(shop: Shop) -> DataFrame:
    profiles, scores = _scored(shop)
    scores = staged(scores, "knn-scores")
    return metrics.neighbour_means(
        _precision_recall(shop, profiles, scores), _ndcg(shop, profiles, scores), EVALUATED
    )


@query
def knn_metrics(shop: Shop) -> DataFrame:
    """Mean precision, recall and NDCG of the nearest users' predictions, over one search."""
    return _knn_means(shop)


@query
def recommend_users(shop: Shop) -> DataFrame:
    return recommend.recommend_users(shop.training, shop.model_grid)


@query
def recommend_users_excluding(shop: Shop) -> DataFrame:
    return recommend.recommend_users(shop.training, shop.model_grid, exclude=_disliked(shop))


def _basket_requests(shop: Shop) -> DataFrame:
    """Each order's basket as a request; untranslated categories keep their raw name."""
    raw = shop.role("products").join(shop.role("categories"), "product_category_name", "left")
    named = raw.select(
        "product_id", F.coalesce("product_category_name_english", "product_category_name", F.lit("no category")).alias("category")
    )
    return (
        shop.role("order_items")
        .join(named, "product_id")
        .select(F.col("order_id").alias("request_id"), "category")
    )


@query
def recommend_categories(shop: Shop) -> DataFrame:
    return recommend.recommend_categories(_basket_requests(shop), shop.training, shop.model_grid)


@query
def recommend_fallback(shop: Shop) -> DataFrame:
    """Categories offered to every basket, with the way they were found."""
    return round_doubles(recommend.category_targets(_basket_requests(shop), shop.model_grid, 10), 6)


def _report_requests(shop: Shop) -> DataFrame:
    rows = [(g, c) for g, names in REPORT_GROUPS.items() for c in names]
    return shop.spark.createDataFrame(rows, "request_id bigint, category string")


@query
def category_confidence(shop: Shop) -> DataFrame:
    return recommend.category_confidence(_report_requests(shop), shop.model_grid)


# ---- ranking metrics ----


def _predictions(shop: Shop) -> DataFrame:
    return roles.predictions(shop.spark, shop.sf_dir)


def _ranking(shop: Shop, metric: str) -> DataFrame:
    table = metrics.ranking_table(metrics.with_relevance(_predictions(shop)), [5, 10, 20])
    return table.select("uid", "k", round_half_even(F.col(metric), 6).alias(metric))


@query
def precision_at_k(shop: Shop) -> DataFrame:
    return _ranking(shop, "precision")


@query
def recall_at_k(shop: Shop) -> DataFrame:
    return _ranking(shop, "recall")


@query
def ndcg_at_k(shop: Shop) -> DataFrame:
    return _ranking(shop, "ndcg")


@query
def graded_ndcg(shop: Shop) -> DataFrame:
    rows = _predictions(shop).select(
        "uid", "iid", F.col("pred_rating").alias("score"), F.col("true_rating").alias("relevance")
    )
    return round_doubles(metrics.graded_ndcg(rows, 10), 6)


@query
def map_at_k(shop: Shop) -> DataFrame:
    return _ranking(shop, "map")


@query
def ranking_metrics(shop: Shop) -> DataFrame:
    return metrics.ranking_metrics(_predictions(shop))


@query
def rating_errors(shop: Shop) -> DataFrame:
    return metrics.rating_errors(_predictions(shop))


# ---- rating models ----


def _as_predictions(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("customer_unique_id").alias("uid"),
        F.col("product_id").alias("iid"),
        F.col("rating").alias("true_rating"),
        "pred_rating",
    )


@query
def blend_rating(shop: Shop) -> DataFrame:
    """Predicted rating of every interaction; users outside the training set get the global mean."""
    pairs = shop.rated.select("customer_unique_id", "product_id")
    return round_doubles(ratings.blend_rating(pairs, shop.training), 6)


@query
def top_rated_unseen(shop: Shop) -> DataFrame:
    return round_doubles(ratings.top_rated_unseen(shop.training), 6)


@query
def popular_items(shop: Shop) -> DataFrame:
    return ratings.popular_items(shop.training)


@query
def content_recs(shop: Shop) -> DataFrame:
    users = shop.rated.select("customer_unique_id").distinct()
    return round_doubles(ratings.content_recommendations(shop.training, users), 6)


@query
def hybrid_recs(shop: Shop) -> DataFrame:
    return round_doubles(ratings.hybrid_recommendations(shop.training), 6)


@query
def item_neighbours(shop: Shop) -> DataFrame:
    """Nearest products by common raters, over all interactions."""
    return corating.item_neighbours(shop.rated)


@query
def item_knn_rating(shop: Shop) -> DataFrame:
    return round_doubles(_as_predictions(corating.predict_from_neighbours(shop.test, shop.train)), 6)


@query
def als_nonneg(shop: Shop) -> DataFrame:
    return ratings.factor_model(shop.train, shop.test)


@query
def nmf_update(shop: Shop) -> DataFrame:
    """Both factors after the first round."""
    model = factorization.matrix_model(shop.train, shop.test, rounds=1)
    both = factorization.long_factor(model.users, "user", "user").unionByName(
        factorization.long_factor(model.items, "item", "item")
    )
    return both.withColumn("value", round_half_even(F.col("value"), 9))


@query
def nmf_rating(shop: Shop) -> DataFrame:
    return factorization.matrix_ratings(shop.train, shop.test)


def _model_results(shop: Shop) -> DataFrame:
    """Test errors and NDCG@10 of the blended mean and of the product mean."""
    by_blend = ratings.blend_rating(shop.test, shop.train)
    means = recommend.item_mean_ratings(shop.train)
    overall = shop.train.agg(F.sum(F.col("rating").cast("decimal(10,1)")).cast("double") / F.count("*")).scalar()
    by_item = (
        shop.test.join(means, "product_id", "left")
        .withColumn("pred_rating", F.coalesce("mean_rating", overall))
        .drop("mean_rating")
    )
    parts = []
    for name, df in (("blend", by_blend), ("item_mean", by_item)):
        predictions = _as_predictions(df).withColumn("pred_rating", round_half_even(F.col("pred_rating"), 9))
        errors = metrics.rating_errors(predictions)
        ndcg = (
            metrics.ranking_metrics(predictions, [10]).filter(F.col("metric") == "ndcg").agg(F.max("mean")).scalar()
        )
        parts.append(errors.select(F.lit(name).alias("model"), "rmse", "mae", ndcg.alias("ndcg")))
    return quality.union_all(parts)


@query
def performance_report(shop: Shop) -> DataFrame:
    """The trained models by their ranking metrics: user neighbours over categories, the others over products."""
    rated = {
        "blend": ratings.blend_rating(shop.test, shop.train).withColumn("pred_rating", round_half_even(F.col("pred_rating"), 9)),
        "item_knn": round_doubles(corating.predict_from_neighbours(shop.test, shop.train), 6),
    }
    parts = [_knn_means(shop).select(F.lit("user_knn").alias("model"), "metric", "mean")]
    for name, predictions in rated.items():
        means = metrics.ranking_metrics(_as_predictions(predictions), [EVALUATED])
        parts.append(means.select(F.lit(name).alias("model"), F.concat_ws("_", "metric", "k").alias("metric"), "mean"))
    return metrics.performance_report(quality.union_all(parts), EVALUATED)


@query
def model_report(shop: Shop) -> DataFrame:
    return _model_results(shop)


@query
def best_model(shop: Shop) -> DataFrame:
    return metrics.best_models(staged(_model_results(shop), "results"))


@query
def published_grid(shop: Shop) -> DataFrame:
    """The grid published in two versions, the second trained on all rows; readers get the latest."""
    root = shop.scratch("models")
    first = shop.model_grid.filter(F.col("rating") >= metrics.RELEVANT)
    for version, grid, day in (("v2", shop.model_grid, 2), ("v1", first, 1)):
        models.publish(shop.spark, root, "user-knn", version, {"grid": grid}, {"rows": grid.count()}, datetime(2024, 1, day))
    return models.load(shop.spark, root, "user-knn", "grid")


@query
def latest_model(shop: Shop) -> DataFrame:
    """Latest run of each model name, with the event log as the run table."""
    runs = shop.table("events").select(
        F.col("event_type").alias("model"), F.col("event_id").alias("version"), F.col("ts").alias("start_time")
    )
    return runs.groupBy("model").agg(
        F.max(F.struct("start_time", "version"))["version"].alias("version"), F.max("start_time").alias("start_time")
    )


@query
def tfidf(shop: Shop) -> DataFrame:
    return round_doubles(text.tfidf(shop.role("products"), "product_id", "product_category_name", stop_words=text.COMMON_WORDS), 6)


@query
def tfidf_documents(shop: Shop) -> DataFrame:
    return round_doubles(text.tfidf(shop.table("documents"), "doc_id", "text", stop_words=text.COMMON_WORDS), 6)


@query
def item_similarity(shop: Shop) -> DataFrame:
    """The ten products most alike by the text of their category."""
    weights = text.tfidf(shop.role("products"), "product_id", "product_category_name", stop_words=text.COMMON_WORDS)
    profiles = neighbours.build_profiles(weights, 11, "product_id", "term", "weight")
    lists = neighbours.owner_neighbours(profiles, 10)
    return neighbours.neighbour_rows(lists, "customer_unique_id").withColumnRenamed(
        "customer_unique_id", "product_id"
    )


# ---- streaming ----


@query
def stream_ingest(shop: Shop) -> DataFrame:
    target, checkpoint = shop.scratch("stream"), shop.scratch("stream-state")
    for _ in range(2):  # the second run finds nothing new
        events.ingest(events.event_stream(shop.spark, shop.sf_dir), target, checkpoint)
    return shop.spark.read.parquet(target).drop("batch_id")


@query
def stream_land(shop: Shop) -> DataFrame:
    """Events landed by date in batches; the newest date is read back beside the audit of all batches."""
    root, checkpoint = shop.scratch("stream"), shop.scratch("stream-state")
    for _ in range(2):  # the second run finds nothing new
        events.land_stream(events.event_stream(shop.spark, shop.sf_dir), root, "events", checkpoint)
    landed = lake.read_landed(shop.spark, root, "events", "stream")
    audit = events.read_stream_audit(shop.spark, root, "events")
    return files.latest_partition(landed).groupBy("ingest_date", "event_type").agg(F.count("*").alias("n_events")).withColumn(
        "rows_audited", audit.agg(F.sum("row_count")).scalar()
    )


@query
def stream_item_counts(shop: Shop) -> DataFrame:
    target, checkpoint = shop.scratch("stream"), shop.scratch("stream-state")
    counts = events.windowed_counts(events.event_stream(shop.spark, shop.sf_dir))
    events.drain(counts, target, checkpoint, "update")
    newest = events.newest_version(shop.spark.read.parquet(target), ["window_start", "event_type"])
    return newest.withColumn("total_value", F.col("total_value").cast("double")).withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    )


@query
def stream_dedupe(shop: Shop) -> DataFrame:
    target, checkpoint = shop.scratch("stream"), shop.scratch("stream-state")
    stream = events.event_stream(shop.spark, shop.sf_dir)
    twice = stream.unionByName(events.event_stream(shop.spark, shop.sf_dir))
    events.drain(events.without_repeats(twice), target, checkpoint)
    return shop.spark.read.parquet(target).select("event_id", "user_id", "event_type", "value")


# ---- what is bought together, when and where ----


@query
def item_cooccurrence(shop: Shop) -> DataFrame:
    return cooccurrence.bought_together(shop.role("order_items"), "order_id", "product_id")


@query
def category_cooccurrence(shop: Shop) -> DataFrame:
    named = shop.role("order_items").select("order_id", "product_id").join(shop.product_categories, "product_id")
    return cooccurrence.bought_together(named, "order_id", "category_english", k=5)


@query
def repeat_gap(shop: Shop) -> DataFrame:
    people = shop.all_customers.select("customer_id", "customer_unique_id")
    return timing.repeat_gaps(
        shop.orders.join(people, "customer_id"), "customer_unique_id", "order_id", "order_purchase_timestamp"
    )


@query
def temporal_split(shop: Shop) -> DataFrame:
    lines = shop.all_lines.filter(F.col("customer_unique_id").isNotNull()).select(
        "customer_unique_id", "product_id", "order_id", "order_purchase_timestamp"
    )
    return timing.temporal_split(lines.distinct(), "order_purchase_timestamp")


@query
def geo_distance(shop: Shop) -> DataFrame:
    return places.distance_bands(
        shop.role("order_items"), shop.orders, shop.all_customers, shop.role("sellers"), shop.role("geolocation")
    )


@query
def regional_pref(shop: Shop) -> DataFrame:
    return places.regional_preferences(shop.all_lines, "customer_state", "category_english")
