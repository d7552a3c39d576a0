"""The stages from source tables to training data, as lazy frames."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchweave.functions.scalars import MONEY
from merchweave.operators import cleaning, features, transactions
from merchweave.operators.recommend import category_grid, train_test_split
from merchweave.session import configure, shared_dir, staged
from merchweave.sources import roles, store


class Shop:
    """Frames over one folder of tables. Nothing runs until a frame is used.

    ``rated`` and ``model_grid`` are written once per instance, like the training
    set and the grid a model is fitted on.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, one_hot: list[str] | None = None):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.one_hot = one_hot or features.TOP_CATEGORIES

    def table(self, name: str) -> DataFrame:
        return roles.read(self.spark, self.sf_dir, name)

    def role(self, name: str) -> DataFrame:
        return roles.ROLES[name](self.spark, self.sf_dir)

    @cached_property
    def sources(self) -> dict[str, DataFrame]:
        """The nine source tables as exported (without helper columns)."""
        tables = {name: self.role(name) for name in roles.ROLES}
        tables["geolocation"] = tables["geolocation"].drop("row_id")
        return tables

    def scratch(self, name: str) -> str:
        """A new folder in the shared folder."""
        return f"{shared_dir(self.spark)}/merchweave/{name}-{uuid.uuid4().hex}"

    @cached_property
    def customers(self) -> DataFrame:
        return cleaning.clean_customers(self.role("customers"))

    @cached_property
    def all_customers(self) -> DataFrame:
        return cleaning.tidy_places(self.role("customers"))

    @cached_property
    def products(self) -> DataFrame:
        return cleaning.clean_products(self.role("products"), self.role("categories"))

    @cached_property
    def product_categories(self) -> DataFrame:
        named = cleaning.translate_categories(self.role("products"), self.role("categories"))
        return named.select("product_id", "category_english")

    @cached_property
    def orders(self) -> DataFrame:
        return cleaning.clean_orders(self.role("orders"))

    @cached_property
    def reviews(self) -> DataFrame:
        return cleaning.clean_reviews(self.role("reviews"))

    @cached_property
    def payments(self) -> DataFrame:
        return cleaning.payments_per_order(self.role("payments"))

    def _joined(self, customers: DataFrame) -> DataFrame:
        wanted = ["product_weight_g", "product_photos_qty"]
        goods = cleaning.clean_products(self.role("products"), self.role("categories"), impute=wanted)
        return transactions.build_transactions(
            self.orders, self.role("order_items"), self.reviews, self.payments, customers, goods
        )

    @cached_property
    def transactions(self) -> DataFrame:
        return self._joined(self.customers)

    @cached_property
    def transactions_all_orders(self) -> DataFrame:
        return self._joined(self.all_customers)

    @cached_property
    def lines(self) -> DataFrame:
        return transactions.purchase_lines(
            self.orders, self.role("order_items"), self.reviews, self.customers, self.product_categories
        )

    @cached_property
    def all_lines(self) -> DataFrame:
        return transactions.purchase_lines(
            self.orders, self.role("order_items"), self.reviews, self.all_customers, self.product_categories
        )

    @cached_property
    def order_lines(self) -> DataFrame:
        """The lines without their category, which interactions do not need: no shuffle by product."""
        return transactions.purchase_lines(self.orders, self.role("order_items"), self.reviews, self.customers)

    @cached_property
    def interactions(self) -> DataFrame:
        return transactions.build_interactions(self.order_lines)

    @cached_property
    def user_features(self) -> DataFrame:
        return features.build_user_features(self.lines)

    @cached_property
    def item_features(self) -> DataFrame:
        return features.build_item_features(self.lines, self.products, self.one_hot)

    @cached_property
    def interaction_features(self) -> DataFrame:
        return features.build_interaction_features(self.interactions)

    @cached_property
    def feature_tables(self) -> dict[str, DataFrame]:
        """All three feature tables, from order lines that are joined and written once.

        The category joins afterwards: lines of users on their way to the user, and all lines where
        they meet at their product, which is the one shuffle that the item features need.
        """
        # Amounts are added up as decimals; as such they travel in fewer bytes.
        items = self.role("order_items").withColumns({c: F.col(c).cast(MONEY) for c in ("price", "freight_value")})
        lines = transactions.purchase_lines(self.orders, items, self.reviews, self.customers)
        # Which order it was matters to users only. Lines are joined by their order, so every line has one.
        owned = F.col("customer_unique_id").isNotNull()
        lines = lines.select(*features.LINE_COLUMNS).withColumn("order_id", F.when(owned, F.col("order_id")))
        lines = staged(lines, "lines", compression="zstd")
        own_lines = lines.filter(owned)
        of_users = transactions.line_categories(own_lines, self.product_categories).repartition("customer_unique_id")
        # Lines without a user count for the latest purchase only.
        latest = lines.agg(F.max("order_purchase_timestamp")).scalar()
        sold = lines.withColumn("order_id", F.lit(1))
        of_items = transactions.line_categories(sold.filter(F.col("product_id").isNotNull()), self.product_categories)
        # The lines of a pair meet once, with their orders.
        pairs = own_lines.repartition("customer_unique_id", "product_id")
        return {
            "user_features": features.build_user_features(of_users, latest, True),
            "item_features": features.build_item_features(of_items, self.products, self.one_hot),
            "interaction_features": features.build_interaction_features(transactions.build_interactions(pairs)),
        }

    @cached_property
    def rated(self) -> DataFrame:
        """All interactions with the category of the product, written once."""
        pairs = transactions.with_category(self.interactions, self.product_categories)
        return staged(
            pairs.select("customer_unique_id", "product_id", "category_english", "rating", "purchase_count"), "rated"
        )

    @cached_property
    def training(self) -> DataFrame:
        """Interactions of users with at least two categories, labelled train or test."""
        users = transactions.multi_category_users(self.rated)
        return train_test_split(store.training_set(self.rated, users))

    @cached_property
    def train(self) -> DataFrame:
        return self.training.filter(F.col("split") == "train")

    @cached_property
    def test(self) -> DataFrame:
        return self.training.filter(F.col("split") == "test")

    @cached_property
    def model_grid(self) -> DataFrame:
        """The training set holds qualified users only, so the grid needs no second check."""
        return staged(category_grid(self.train), "grid")
