"""Feature store: versioned snapshots of the feature tables with point-in-time lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.operators.features import FEATURE_REGISTRY
from merchweave.sources.files import rows_for_ids, sample_rows

GROUPS = ("user_features", "item_features", "interaction_features")
REGISTRY_SCHEMA = (
    "snapshot_id string, created_at timestamp, feature_groups array<struct<"
    "feature_table:string, row_count:bigint, column_count:int, columns:array<string>>>, "
    "stored_features array<string>"
)


class SnapshotNotFound(ValueError):
    pass


def snapshot_at(registry: DataFrame, moment: datetime) -> DataFrame:
    """The latest snapshot at or before ``moment`` by its timestamp; no row if there is none."""
    return (
        registry.filter(F.col("created_at") <= F.lit(moment))
        .orderBy(F.desc("created_at"), F.desc("snapshot_id"))
        .limit(1)
    )


def snapshots_for(moments: DataFrame, registry: DataFrame, at: str = "at") -> DataFrame:
    """The latest snapshot at or before each moment, for many moments at once.

    Each snapshot is valid until the next. Both sides meet on the days a snapshot
    is valid, so the join is an equi-join spread over days.
    """
    order = W.orderBy("created_at", "snapshot_id")  # one row per snapshot
    last = moments.agg(F.max(at)).scalar()
    spans = registry.select(
        "snapshot_id", "created_at", F.lead("created_at").over(order).alias("_until")
    ).filter(F.col("_until").isNull() | (F.col("_until") > F.col("created_at")))
    days = (
        spans.withColumn("_end", F.coalesce("_until", last))
        .filter(F.col("_end") >= F.col("created_at"))
        .withColumn("_day", F.explode(F.sequence(F.to_date("created_at"), F.to_date("_end"))))
        .drop("_end")
    )
    stamped = moments.withColumn("_d", F.to_date(at))
    matches = (
        (F.col("_d") == F.col("_day"))
        & (F.col(at) >= F.col("created_at"))
        & (F.col("_until").isNull() | (F.col(at) < F.col("_until")))
    )
    return stamped.join(days, matches, "left").drop("_d", "_day", "_until")


def snapshot_list(registry: DataFrame) -> DataFrame:
    latest = registry.agg(F.max(F.struct("created_at", "snapshot_id"))["snapshot_id"]).scalar()
    return registry.select("snapshot_id", "created_at", (F.col("snapshot_id") == latest).alias("is_latest"))


def group_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each feature table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("feature_table"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
            F.lit(",".join(df.columns)).alias("columns"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def training_set(interactions: DataFrame, users: DataFrame, min_categories: int = 2) -> DataFrame:
    """Interactions of users who bought in at least two categories."""
    qualified = users.filter(F.col("distinct_categories") >= min_categories).select("customer_unique_id")
    return interactions.join(qualified, "customer_unique_id", "left_semi")


WIDE_USER = [
    "total_spending",
    "avg_order_value",
    "avg_rating_given",
    "review_count",
    "distinct_products",
    "distinct_categories",
    "preferred_category",
    "recency_days",
    "purchase_freq_log",
    "spending_normalized",
    "aov_normalized",
    "customer_state",
]
WIDE_ITEM = [
    "category_english",
    "total_sold",
    "avg_rating_received",
    "review_count",
    "avg_price",
    "total_revenue",
    "distinct_buyers",
    "popularity_rank",
    "price_percentile",
    "price_normalized",
    "sold_normalized",
    "rating_normalized",
]


def training_set_wide(interactions: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Interactions with the features of their user and product, 31 columns."""
    u = users.select(
        "customer_unique_id", *[F.col(c).alias("user_review_count" if c == "review_count" else c) for c in WIDE_USER]
    )
    renamed = {"review_count": "item_review_count", "rating_normalized": "item_rating_normalized"}
    i = items.select("product_id", *[F.col(c).alias(renamed.get(c, c)) for c in WIDE_ITEM])
    return interactions.join(u, "customer_unique_id", "left").join(i, "product_id", "left")


class FeatureStore:
    """Snapshots under ``root``: each table partitioned by snapshot_id, plus a registry table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def registry_path(self) -> str:
        return f"{self.root}/registry"

    def register(self, tables: Mapping[str, DataFrame], created_at: datetime, snapshot_id: str | None = None) -> str:
        """Write the tables as a new snapshot and add it to the registry."""
        snapshot_id = snapshot_id or created_at.strftime("v_%Y%m%d_%H%M%S")
        for name, df in tables.items():
            out = df.withColumn("snapshot_id", F.lit(snapshot_id))
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_id").parquet(
                f"{self.root}/{name}"
            )
        # Counted from the files just written, which costs a footer read.
        groups = [
            (name, self._partition(name, snapshot_id).count(), len(df.columns), df.columns)
            for name, df in tables.items()
        ]
        features = [f"{r[1]}.{r[0]}" for r in FEATURE_REGISTRY if r[1] in tables]
        self.spark.createDataFrame([(snapshot_id, created_at, groups, features)], REGISTRY_SCHEMA).coalesce(
            1
        ).write.mode("append").parquet(self.registry_path)
        return snapshot_id

    def registry(self) -> DataFrame:
        return self.spark.read.schema(REGISTRY_SCHEMA).parquet(self.registry_path)

    def snapshots(self) -> DataFrame:
        return snapshot_list(self.registry())

    def latest(self) -> str:
        row = self.snapshots().filter("is_latest").first()
        if row is None:
            raise SnapshotNotFound("no snapshot registered")
        return row.snapshot_id

    def at_time(self, moment: datetime) -> str:
        row = snapshot_at(self.registry(), moment).first()
        if row is None:
            raise SnapshotNotFound(f"no snapshot at or before {moment}")
        return row.snapshot_id

    def _partition(self, table: str, snapshot_id: str) -> DataFrame:
        stored = self.spark.read.parquet(f"{self.root}/{table}")
        return stored.filter(F.col("snapshot_id") == snapshot_id)

    def table(self, name: str, snapshot_id: str | None = None) -> DataFrame:
        """One feature table of a snapshot, the latest by default; only its partition is read."""
        wanted = snapshot_id or self.latest()
        if self.registry().filter(F.col("snapshot_id") == wanted).isEmpty():
            raise SnapshotNotFound(f"snapshot {wanted} not found")
        return self._partition(name, wanted).drop("snapshot_id")

    def training_set(self, snapshot_id: str | None = None, sample: int | None = None) -> DataFrame:
        rows = training_set(self.table("interaction_features", snapshot_id), self.table("user_features", snapshot_id))
        return rows if sample is None else sample_rows(rows, sample, ["customer_unique_id", "product_id"])

    def users(self, ids: Sequence | DataFrame, snapshot_id: str | None = None) -> DataFrame:
        return rows_for_ids(self.table("user_features", snapshot_id), "customer_unique_id", ids)

    def items(self, ids: Sequence | DataFrame, snapshot_id: str | None = None) -> DataFrame:
        return rows_for_ids(self.table("item_features", snapshot_id), "product_id", ids)

    def interactions(self, user_id, snapshot_id: str | None = None) -> DataFrame:
        return self.table("interaction_features", snapshot_id).filter(F.col("customer_unique_id") == user_id)

    def status(self) -> DataFrame:
        """Rows and columns per snapshot and table."""
        flags = self.snapshots().select("snapshot_id", "is_latest")
        return (
            self.registry()
            .select("snapshot_id", "created_at", F.explode("feature_groups").alias("g"))
            .select("snapshot_id", "created_at", "g.feature_table", "g.row_count", "g.column_count")
            .join(flags, "snapshot_id")
        )
