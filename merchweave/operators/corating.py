"""Item-to-item neighbours by the users who rated both, and ratings predicted from them.

A product's vector has one entry per user, so there are as many dimensions as
users. Pairs are therefore found through the users they share, but only pairs
that can still reach the top k:

1. Products with vectors of the same direction (all those with a single, common
   rater, for one) share a profile. It is recognised by a fingerprint, so no
   list of raters is ever collected.
2. For each user the k best products by weight give a floor under the k-th
   similarity of every product that user rated.
3. Users are ordered by how many profiles they rated. If a user is the first one
   two products share, their similarity is at most the product of the norms of
   what remains of both vectors from that user on. Pairs below the floor are not
   formed. Users with very many products come last, where little remains.
4. At a product's last user the similarity of such a pair is the product of two
   weights, so the user's k best products are all it can need.

The bound holds for every pair, so the result is the exact top k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.functions.ordering import running_total
from merchweave.functions.scalars import clip, mean_of_tenths, round_half_even
from merchweave.operators.neighbours import nearest_owners
from merchweave.operators.ratings import SCALE
from merchweave.session import staged

NEIGHBOURS = 40
DIGITS = 9
EQUAL_DIGITS = 12
SLACK = 1e-8
LEVELS = 32


def unit_vectors(ratings: DataFrame) -> DataFrame:
    """(item, user, w): positive ratings over the length of the product's vector."""
    rated = ratings.filter(F.col("rating") > 0).select(
        F.col("product_id").alias("item"), F.col("customer_unique_id").alias("user"), F.col("rating").alias("r")
    )
    norms = rated.groupBy("item").agg(F.sqrt(F.sum(F.col("r") * F.col("r"))).alias("norm"))
    return rated.join(norms, "item").select("item", "user", (F.col("r") / F.col("norm")).alias("w"))


def _profiles(vectors: DataFrame, keep: int) -> tuple[DataFrame, DataFrame]:
    """(item, profile_id) and (profile_id, owners, raters), the first ``keep`` products of each profile."""

    def fingerprint(seed: int):
        return F.sum(F.xxhash64("user", same, F.lit(seed)).cast("decimal(20,0)")).alias(f"h{seed}")

    # Equal directions may differ in the last bit of a weight.
    same = F.round("w", EQUAL_DIGITS)

    key = ["raters", "h1", "h2"]
    items = vectors.groupBy("item").agg(F.count("*").alias("raters"), fingerprint(1), fingerprint(2))
    items = staged(items, "fingerprints")
    first = items.withColumn("_place", F.row_number().over(W.partitionBy(*key).orderBy("item"))).filter(
        F.col("_place") <= keep
    )
    table = first.groupBy(*key).agg(
        F.min("item").alias("profile_id"), F.sort_array(F.collect_list("item")).alias("owners")
    )
    table = staged(table, "corated-profiles")
    return items.join(table.select(*key, "profile_id"), key).select("item", "profile_id"), table.select(
        "profile_id", "owners", "raters"
    )


def _entries(vectors: DataFrame, owners: DataFrame) -> DataFrame:
    """Entries of the profiles with the norm of what remains from each user on, users ordered by use."""
    profiles = owners.select(F.col("profile_id").alias("item"), F.size("owners").alias("copies"), F.col("raters").alias("n"))
    chosen = vectors.join(profiles, "item")
    chosen = staged(chosen.withColumnRenamed("item", "p"), "profile-entries")
    use = chosen.groupBy("user").agg(F.count("*").alias("use"))
    ordered = chosen.join(use, "user").withColumn("sq", F.col("w") * F.col("w"))
    # Walk from the most used user back; what comes before is the rest of the vector.
    walked = running_total(
        ordered, ["use", "user"], "sq", group=["p"], descending=["use", "user"], total_before="_after"
    )
    return walked.select(
        "p", "user", "w", "copies", "n", F.sqrt(F.col("_after") + F.col("sq")).alias("rest"), (F.col("_after") == 0).alias("is_last")
    )


def _best_of_user(entries: DataFrame, keep: int) -> DataFrame:
    order = W.partitionBy("user").orderBy(F.round("w", EQUAL_DIGITS).desc(), "p")
    return (
        entries.select("user", "p", "w", "copies", "n")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= keep)
    )


def _floors(entries: DataFrame, best: DataFrame, keep: int) -> DataFrame:
    """Per profile a floor under its k-th similarity."""
    order = W.partitionBy("user").orderBy("place")
    reached = best.withColumn("_owners", F.sum("copies").over(order)).filter(F.col("_owners") >= keep)
    kth = reached.groupBy("user").agg(F.max("w").alias("kth"))
    return (
        entries.join(kth, "user", "left")
        .groupBy("p")
        .agg(F.max(F.col("w") * F.coalesce("kth", F.lit(0.0))).alias("floor"))
    )


def _pairs(entries: DataFrame, wanted: DataFrame, best: DataFrame, floors: DataFrame) -> DataFrame:
    """Pairs (a, b), a having no more raters than b, that can be among the nearest of one in ``wanted``."""
    asking = entries.join(wanted, "p", "left_semi")
    offered_last = best.select("user", F.col("p").alias("q"), F.col("n").alias("m"))
    at_last = asking.filter("is_last").select("p", "n", "user").join(offered_last, "user")
    needed = F.try_divide(F.col("floor") - F.lit(SLACK), F.col("rest"))
    open_ended = (
        asking.filter(~F.col("is_last"))
        .join(floors, "p")
        .withColumn("needed", F.greatest(needed, F.lit(0.0)))
        .filter(F.col("needed") <= 1.0)
        .select("p", "n", "user", "needed")
        .withColumn("level", F.explode(F.sequence(F.floor(F.col("needed") * LEVELS).cast("int"), F.lit(LEVELS))))
    )
    offered = entries.select(
        "user",
        F.col("p").alias("q"),
        F.col("n").alias("m"),
        "rest",
        F.least(F.floor(F.col("rest") * LEVELS).cast("int"), F.lit(LEVELS)).alias("level"),
    )
    before_last = open_ended.join(offered, ["user", "level"]).filter(F.col("rest") >= F.col("needed"))
    both = at_last.select("p", "q", "n", "m").unionByName(before_last.select("p", "q", "n", "m"))
    # A pair is compared once, whichever of the two asks: as the shorter vector and the other one.
    first = (F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("p") < F.col("q")))
    return (
        both.filter(F.col("p") != F.col("q"))
        .select(
            F.when(first, F.col("p")).otherwise(F.col("q")).alias("a"),
            F.when(first, F.col("q")).otherwise(F.col("p")).alias("b"),
        )
        .distinct()
    )


def _similarities(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """Cosine of each pair, walking the shorter vector of the two."""
    left = entries.select(F.col("p").alias("a"), "user", F.col("w").alias("wa"))
    right = entries.select(F.col("p").alias("b"), "user", F.col("w").alias("wb"))
    return (
        pairs.join(left, "a")
        .join(right, ["b", "user"])
        .groupBy("a", "b")
        .agg(round_half_even(F.sum(F.col("wa") * F.col("wb")), DIGITS).alias("similarity"))
    )


def item_neighbours(ratings: DataFrame, items: DataFrame | None = None, k: int = NEIGHBOURS) -> DataFrame:
    """The k nearest other products with a rater in common: (product_id, neighbour_id, similarity, place).

    ``items`` (product_id) limits for which products neighbours are sought, not among which.
    """
    keep = k + 1
    vectors = staged(unit_vectors(ratings), "unit-vectors")
    member, owners = _profiles(vectors, keep)
    if items is not None:
        member = member.join(items.select(F.col("product_id").alias("item")).distinct(), "item", "left_semi")
    member = staged(member, "members")
    wanted = member.select(F.col("profile_id").alias("p")).distinct()
    entries = staged(_entries(vectors, owners), "entries")
    best = _best_of_user(entries, keep)
    pairs = _pairs(entries, wanted, best, _floors(entries, best, keep))
    # Each pair counts for both of its products; a similarity that one did not ask for changes nothing.
    directions = F.array(
        *[F.struct(F.col(q).alias("query_id"), F.col(o).alias("profile_id")) for q, o in (("a", "b"), ("b", "a"))]
    )
    compared = _similarities(pairs, entries).select(F.inline(directions), "similarity")
    if items is not None:
        compared = compared.join(wanted.select(F.col("p").alias("query_id")), "query_id", "left_semi")
    found = (
        compared.unionByName(wanted.select(F.col("p").alias("query_id"), F.col("p").alias("profile_id"), F.lit(1.0).alias("similarity")))
    )
    near = nearest_owners(found, owners.drop("raters"), keep)
    lists = near.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "owner", "similarity"))).alias("_found")
    )
    return (
        member.join(lists, F.col("profile_id") == F.col("query_id"))
        .withColumn("_others", F.slice(F.filter("_found", lambda n: n["owner"] != F.col("item")), 1, k))
        .select(F.col("item").alias("product_id"), F.posexplode("_others").alias("_at", "_n"))
        .select(
            "product_id",
            F.col("_n.owner").alias("neighbour_id"),
            F.col("_n.similarity").alias("similarity"),
            (F.col("_at") + 1).alias("place"),
        )
    )


def predict_from_neighbours(pairs: DataFrame, train: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """Rating of each (user, product): the user's ratings of the product's neighbours, weighted.

    A neighbour the user has not rated counts as 0. Without any neighbour the
    user's mean rating is used, then the overall mean. The result is clipped.
    """
    near = staged(item_neighbours(train, pairs, k), "item-neighbours")
    weights = near.groupBy("product_id").agg(F.sum("similarity").alias("_weight"))
    mine = train.select("customer_unique_id", F.col("product_id").alias("neighbour_id"), "rating")
    sums = (
        pairs.select("customer_unique_id", "product_id")
        .distinct()
        .join(near.select("product_id", "neighbour_id", "similarity"), "product_id")
        .join(mine, ["customer_unique_id", "neighbour_id"])
        .groupBy("customer_unique_id", "product_id")
        .agg(F.sum(F.col("similarity") * F.col("rating")).alias("_sum"))
    )
    users = train.filter(F.col("rating") > 0).groupBy("customer_unique_id").agg(
        mean_of_tenths(F.col("rating")).alias("_user_mean")
    )
    overall = train.agg(mean_of_tenths(F.col("rating"))).scalar()
    weighted = F.coalesce("_sum", F.lit(0.0)) / (F.col("_weight") + F.lit(1e-9))
    estimate = F.when(F.col("_weight") > 1e-9, weighted).otherwise(F.coalesce("_user_mean", overall))
    return (
        pairs.join(weights, "product_id", "left")
        .join(sums, ["customer_unique_id", "product_id"], "left")
        .join(users, "customer_unique_id", "left")
        .withColumn("pred_rating", clip(estimate, *SCALE))
        .drop("_weight", "_sum", "_user_mean")
    )
