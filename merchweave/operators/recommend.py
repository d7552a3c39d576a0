"""Recommendations from the neighbours' categories, as batch jobs over all users or requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.functions.ordering import positions
from merchweave.functions.scalars import hash_bucket, mean_of_tenths, round_half_even
from merchweave.operators.neighbours import (
    Profiles,
    build_profiles,
    nearest,
    profile_of_owner,
    profile_queries,
    request_vectors,
    weighted,
)
from merchweave.session import partitions, staged

NEIGHBOURS = 100
PER_CATEGORY = 2
TARGETS = 100_000  # categories of users that one task looks for items for


def train_test_split(training: DataFrame, train_percent: int = 80) -> DataFrame:
    """Label each interaction 'train' or 'test' by a hash of its ids: the same on every run."""
    bucket = hash_bucket(F.col("customer_unique_id"), F.col("product_id"))
    return training.withColumn("split", F.when(bucket < train_percent, F.lit("train")).otherwise(F.lit("test")))


def train_grid(interactions: DataFrame, train: DataFrame, min_categories: int = 2) -> DataFrame:
    """Mean rating per user and category.

    Users qualify by their categories in all interactions; the ratings come from
    the train part only. Both frames carry ``category_english``.
    """
    qualified = (
        interactions.groupBy("customer_unique_id")
        .agg(F.count_distinct("category_english").alias("_n"))
        .filter(F.col("_n") >= min_categories)
        .select("customer_unique_id")
    )
    return category_grid(train.join(qualified, "customer_unique_id", "left_semi"))


def category_grid(rated: DataFrame) -> DataFrame:
    return rated.groupBy("customer_unique_id", "category_english").agg(
        mean_of_tenths(F.col("rating")).alias("rating")
    )


def wide_grid(grid: DataFrame, categories: list[str]) -> DataFrame:
    """The grid with one column per category; no rating is 0."""
    return grid.groupBy("customer_unique_id").pivot("category_english", categories).agg(F.first("rating")).na.fill(0.0)


def popular_categories(grid: DataFrame) -> DataFrame:
    """Share of the grid's users with a positive rating, per category, and the category's place."""
    users = grid.agg(F.count_distinct("customer_unique_id")).scalar()
    counts = grid.groupBy("category_english").agg(F.count_if(F.col("rating") > 0).alias("n_users"))
    # One row per category of the catalogue.
    order = W.orderBy(F.desc("n_users"), "category_english")
    return counts.select(
        "category_english",
        "n_users",
        (F.try_divide(F.col("n_users").cast("double"), users.cast("double")) * 100).alias("share_pct"),
        F.row_number().over(order).alias("place"),
    )


def item_mean_ratings(training: DataFrame) -> DataFrame:
    return training.groupBy("product_id").agg(mean_of_tenths(F.col("rating")).alias("mean_rating"))


def items_by_category(training: DataFrame) -> DataFrame:
    """Products of each category in order of mean rating, then id, with their place from 1."""
    means = training.groupBy("category_english", "product_id").agg(
        mean_of_tenths(F.col("rating")).alias("mean_rating")
    )
    return positions(
        means,
        ["mean_rating", "product_id"],
        group=["category_english"],
        descending=["mean_rating"],
        name="item_place",
    )


def category_shares(lists: DataFrame, profiles: Profiles) -> DataFrame:
    """Per query and category: percentage of the neighbours with a positive rating there."""
    members = lists.select(
        "query_id", F.size("neighbours").alias("n_neighbours"), F.explode("neighbours.owner").alias("owner")
    )
    # One row per neighbour goes back to its query; its categories become rows only there.
    rated = members.join(profiles.vectors.select("owner", F.col("entries.cat").alias("_cats")), "owner")
    return (
        rated.select("query_id", "n_neighbours", "_cats")
        .repartition("query_id")
        .select("query_id", "n_neighbours", F.explode("_cats").alias("cat"))
        .groupBy("query_id", "cat")
        .agg(F.count("*").alias("n"), F.max("n_neighbours").alias("n_neighbours"))
        .join(profiles.index.withColumnRenamed("category", "category_english"), "cat")
        .select(
            "query_id",
            "category_english",
            "n",
            "n_neighbours",
            (F.try_divide(F.col("n").cast("double"), F.col("n_neighbours").cast("double")) * 100).alias("share_pct"),
        )
    )


def top_categories(shares: DataFrame, owned: DataFrame, catalogue: Column, limit: int) -> DataFrame:
    """The best categories a query does not own: share descending, then name.

    Categories no neighbour bought have share 0 and fill up the list in name
    order. ``owned`` has (query_id, owned) with one row per query; ``catalogue``
    is the sorted array of all categories.
    """
    ranked = shares.groupBy("query_id").agg(
        F.array_sort(
            F.collect_list(F.struct((-F.col("share_pct")).alias("minus"), F.col("category_english").alias("category")))
        ).alias("_ranked")
    )
    kept = F.filter(
        F.coalesce("_ranked", F.array().cast("array<struct<minus:double,category:string>>")),
        lambda x: ~F.array_contains("owned", x["category"]),
    )
    zero = F.transform(
        F.array_except(F.array_except("_all", "owned"), F.col("_kept.category")),
        lambda c: F.struct(F.lit(-0.0).alias("minus"), c.alias("category")),
    )
    return (
        owned.join(ranked, "query_id", "left")
        .withColumn("_kept", kept)
        .withColumn("_all", catalogue)
        .select("query_id", F.posexplode(F.slice(F.concat("_kept", zero), 1, limit)).alias("_at", "_c"))
        .select(
            "query_id",
            F.col("_c.category").alias("category_english"),
            F.abs(F.col("_c.minus")).alias("share_pct"),
            (F.col("_at") + 1).alias("category_place"),
        )
    )


def skipped_places(seen: DataFrame, key: list[str], k: int) -> DataFrame:
    """Per key: how a list of ``k`` unseen items must step over seen ones.

    The i-th seen item at place r leaves r - i unseen items before it, so only
    seen items with r - i < k matter. Gives an array of at most k counts by r - i.
    """
    numbered = positions(seen, ["item_place"], group=key, name="_i")
    gaps = (
        numbered.withColumn("_gap", F.col("item_place") - F.col("_i"))
        .filter(F.col("_gap") < k)
        .groupBy(*key, "_gap")
        .agg(F.count("*").alias("_n"))
    )
    return gaps.groupBy(*key).agg(F.collect_list(F.struct("_gap", "_n")).alias("_gaps"))


def unseen_items(targets: DataFrame, seen: DataFrame, items: DataFrame, key: list[str], group: list[str], k: int) -> DataFrame:
    """The first ``k`` items of each target's group that the target has not seen.

    ``key`` identifies a target and includes ``group``, the columns an item list
    belongs to. Each target produces k places; nothing is crossed. All targets of a
    group ask for the same few places, so only items up to the last place anybody
    needs take part: as a rule few enough for Spark to broadcast, and otherwise the
    adaptive skew join splits the targets.
    """
    gaps = skipped_places(seen, key, k)
    skipped = F.aggregate("_gaps", F.lit(0).cast("long"), lambda total, g: total + g["_n"])
    deepest = gaps.agg(F.coalesce(F.max(skipped), F.lit(0))).scalar()
    step = F.aggregate(
        F.filter(F.coalesce("_gaps", F.array().cast("array<struct<_gap:bigint,_n:bigint>>")), lambda g: g["_gap"] < F.col("_j")),
        F.lit(0).cast("long"),
        lambda total, g: total + g["_n"],
    )
    placed = (
        targets.join(gaps, key, "left")
        .withColumn("_j", F.explode(F.sequence(F.lit(1), F.lit(k))))
        .withColumn("item_place", F.col("_j") + step)
        .drop("_gaps", "_j")
    )
    return placed.join(items.filter(F.col("item_place") <= deepest + k), [*group, "item_place"])


def _final_list(scored: DataFrame, key: str, n_items: int, *also: str) -> DataFrame:
    order = W.partitionBy(key).orderBy(F.desc("score"), F.desc("share_pct"), "product_id")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n_items)
        .select(key, "rank", "product_id", "category_english", round_half_even(F.col("score"), 4).alias("score"), *also)
    )


def catalogue_of(profiles: Profiles) -> Column:
    """All categories of the grid as one sorted array."""
    return profiles.index.agg(F.sort_array(F.collect_list("category"))).scalar()


def _named(profiles: Profiles, queries: DataFrame) -> DataFrame:
    """Categories each query already has, by name."""
    named = queries.select("query_id", "cats").withColumn("_all", catalogue_of(profiles))
    return named.select("query_id", F.transform("cats", lambda c: F.element_at("_all", c + 1)).alias("owned"))


def seen_items(training: DataFrame, exclude: DataFrame | None = None) -> DataFrame:
    """Products a user bought, and those excluded on request."""
    bought = training.select("customer_unique_id", "product_id")
    return (bought if exclude is None else bought.unionByName(exclude)).distinct()


def recommend_users(
    training: DataFrame,
    grid: DataFrame,
    n_items: int = 10,
    exclude: DataFrame | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """Items for every user of the grid (or those in ``users``); a user outside the grid gets none.

    ``training`` carries ``category_english``. Neighbours and shares are worked
    out once per distinct rating profile; users join at the end.
    """
    profiles = build_profiles(grid, NEIGHBOURS)
    queries = profile_queries(profiles)
    lists = nearest(queries, profiles)
    wanted = top_categories(
        category_shares(lists, profiles), _named(profiles, queries), catalogue_of(profiles), n_items * 2
    )
    people = profile_of_owner(profiles).withColumnRenamed("owner", "customer_unique_id")
    if users is not None:
        people = people.join(users.select("customer_unique_id").distinct(), "customer_unique_id", "left_semi")
    # Targets are few bytes before their items join, so tasks are not merged by size but grow with the users.
    spark = grid.sparkSession
    tasks = max(partitions(spark), -(-profiles.vectors.count() * n_items * 2 // TARGETS))
    targets = people.join(wanted, F.col("profile_id") == F.col("query_id")).drop("profile_id", "query_id")
    targets = targets.repartition(tasks, "customer_unique_id", "category_english")
    items = staged(items_by_category(training), "items")
    seen = seen_items(training, exclude).join(
        items.select("category_english", "product_id", "item_place"), "product_id"
    )
    found = unseen_items(
        targets, seen.drop("product_id"), items, ["customer_unique_id", "category_english"], ["category_english"], PER_CATEGORY
    )
    scored = found.withColumn("score", F.col("mean_rating") + F.col("share_pct") / 100)
    return _final_list(scored, "customer_unique_id", n_items)


def request_shares(requests: DataFrame, grid: DataFrame) -> tuple[Profiles, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Neighbour shares of category requests; equal requests are answered once.

    Gives the profiles, (request_id, query_id), the queries, the shares and (request_id) of requests
    without a known category.
    """
    profiles = build_profiles(grid, NEIGHBOURS)
    asked = staged(request_vectors(requests, profiles), "requests")
    known = asked.filter(F.size("entries") > 0)
    same = staged(known.groupBy("entries").agg(F.min("query_id").alias("_first")), "equal-requests")
    answers = known.join(same, "entries").select(F.col("query_id").alias("request_id"), F.col("_first").alias("query_id"))
    queries = weighted(same.filter(F.col("_first").isNotNull()).select(F.col("_first").alias("query_id"), "entries"))
    # A request without an id is never known by it.
    unknown = asked.filter((F.size("entries") == 0) | F.col("query_id").isNull()).select(F.col("query_id").alias("request_id"))
    return profiles, answers, queries, category_shares(nearest(queries, profiles), profiles), unknown


def category_targets(requests: DataFrame, grid: DataFrame, limit: int) -> DataFrame:
    """Categories to offer per request; requests without a known category get the most popular ones."""
    profiles, answers, queries, shares, unknown = request_shares(requests, grid)
    wanted = top_categories(shares, _named(profiles, queries), catalogue_of(profiles), limit)
    matched = answers.join(wanted, "query_id").select(
        "request_id", "category_english", "share_pct", F.lit("KNN").alias("recommendation_type")
    )
    popular = popular_categories(grid).filter(F.col("place") <= limit)
    fallback = unknown.withColumn("place", F.explode(F.sequence(F.lit(1), F.lit(limit)))).join(popular, "place")
    return matched.unionByName(
        fallback.select("request_id", "category_english", "share_pct", F.lit("rank_based").alias("recommendation_type"))
    )


def recommend_categories(
    requests: DataFrame, training: DataFrame, grid: DataFrame, n_items: int = 10, exclude: DataFrame | None = None
) -> DataFrame:
    """Items for requests (request_id, category): an equal high rating in each category asked for.

    ``exclude`` has (request_id, product_id). Without it the best items of a
    category are the same for all requests.
    """
    targets = category_targets(requests, grid, n_items * 2)
    items = staged(items_by_category(training), "items")
    if exclude is None:
        found = targets.join(items.filter(F.col("item_place") <= PER_CATEGORY), "category_english")
    else:
        seen = exclude.distinct().join(items.select("category_english", "product_id", "item_place"), "product_id")
        found = unseen_items(
            targets, seen.drop("product_id"), items, ["request_id", "category_english"], ["category_english"], PER_CATEGORY
        )
    scored = found.withColumn("score", F.col("mean_rating") + F.col("share_pct") / 100)
    return _final_list(scored, "request_id", n_items, "recommendation_type")


def category_confidence(requests: DataFrame, grid: DataFrame, top: int = 5) -> DataFrame:
    """The report: best categories with a positive share for each request."""
    profiles, answers, queries, shares, _ = request_shares(requests, grid)
    wanted = top_categories(shares, _named(profiles, queries), catalogue_of(profiles), top)
    return (
        answers.join(wanted.filter(F.col("share_pct") > 0), "query_id")
        .select(
            "request_id",
            F.col("category_place").alias("rank"),
            "category_english",
            round_half_even(F.col("share_pct"), 2).alias("confidence_pct"),
        )
    )


def neighbour_scores(lists: DataFrame, grid: DataFrame) -> DataFrame:
    """Mean of the neighbours' ratings per user and category, missing ratings counting as 0.

    Only categories some neighbour rated; all others score 0.
    """
    rated = grid.filter(F.col("rating") > 0).select(
        F.col("customer_unique_id").alias("neighbour_id"), "category_english", "rating"
    )
    members = lists.select(
        "customer_unique_id", F.size("neighbours").alias("_k"), F.explode("neighbours.owner").alias("neighbour_id")
    )
    return (
        members.join(rated, "neighbour_id")
        .groupBy("customer_unique_id", "category_english")
        .agg(round_half_even(F.sum("rating") / F.max("_k"), 9).alias("score"))
    )

