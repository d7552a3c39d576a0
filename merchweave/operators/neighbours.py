"""Exact nearest neighbours by cosine over sparse rating vectors.

Plan, for any number of owners (users, or products described by terms):

1. Owners whose ratings have the same direction (each is the same multiple of its
   largest one) share one *profile*. Only profiles are compared, so
   a third of all users with one and the same profile cost one comparison. Each
   profile keeps its first k owners by id, which is all a top-k can use.
2. Profiles are placed by their largest category (the *cell*) and cut by hash
   into blocks of bounded size. Cells too small for a block of their own are
   taken together.
3. Each query meets one block of its own cell. That gives a floor under its k-th
   similarity. A cell whose best possible cosine is below the floor is skipped;
   this loses nothing, because the bound holds for every vector of the cell.
4. Query blocks meet the blocks of the cells left over, one pair of blocks at a
   time. All visits of a query block are in one task, which keeps the best k per
   query, raises the floor as it goes, and gives out nothing else.

Similarities are rounded to nine digits. Ties go to the smaller owner id. Owners
without a shared category have similarity 0 and fill up lists that are too short.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchweave.functions.cosine import best_of_blocks, thresholds
from merchweave.session import arrow_rows, staged

BLOCK_ROWS = 2048
ROWS_PER_TASK = 256
# A row of the block work holds two whole blocks, so very few rows travel to Python at a time.
ROWS_PER_BATCH = 8


@dataclass(frozen=True)
class Profiles:
    """Distinct rating vectors and the numbering of their categories."""

    index: DataFrame  # category, cat
    table: DataFrame  # profile_id, entries, cats, weights, cell, owners
    vectors: DataFrame  # owner, entries (over the largest one)
    first_owners: Column  # scalar: the smallest owner ids, enough to fill up any list
    keep: int


def category_index(ratings: DataFrame, category: str) -> DataFrame:
    """Numbers of the categories in alphabetical order; one row per category of the catalogue."""
    names = ratings.select(F.col(category).alias("category")).filter(F.col("category").isNotNull()).distinct()
    return names.withColumn("cat", (F.row_number().over(W.orderBy("category")) - 1).cast("int"))


def rating_vectors(ratings: DataFrame, index: DataFrame, owner: str, category: str, rating: str) -> DataFrame:
    """One row per owner: its positive ratings over the largest of them as an array ordered by category number."""
    numbered = ratings.select(
        F.col(owner).alias("owner"), F.col(category).alias("category"), F.col(rating).cast("double").alias("rating")
    ).join(index, "category", "inner")
    entry = F.when(F.col("rating") > 0, F.struct(F.col("cat"), F.col("rating")))
    vectors = numbered.groupBy("owner").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    largest = F.array_max("entries.rating")
    scaled = F.transform(
        "entries", lambda e: F.struct(e["cat"].alias("cat"), F.try_divide(e["rating"], F.col("_largest")).alias("rating"))
    )
    return vectors.withColumn("_largest", largest).select("owner", scaled.alias("entries"))


def _with_weights(df: DataFrame) -> DataFrame:
    """Unit weights and the cell: the category with the largest weight, the first of equals."""
    norm = F.sqrt(F.aggregate("entries", F.lit(0.0), lambda total, e: total + e["rating"] * e["rating"]))
    largest = F.array_min(F.transform("entries", lambda e: F.struct((-e["rating"]).alias("minus"), e["cat"].alias("cat"))))
    return (
        df.withColumn("_norm", norm)
        .withColumn("cats", F.col("entries.cat"))
        .withColumn("weights", F.transform("entries", lambda e: F.try_divide(e["rating"], F.col("_norm"))))
        .withColumn("cell", largest["cat"])
        .drop("_norm")
    )


def build_profiles(
    ratings: DataFrame, keep: int, owner: str = "customer_unique_id", category: str = "category_english", rating: str = "rating"
) -> Profiles:
    index = staged(category_index(ratings, category), "category-index")
    vectors = staged(rating_vectors(ratings, index, owner, category, rating), "vectors")
    # The row_number filter is applied before the shuffle as well, so a profile
    # of any size sends at most ``keep`` owners per task.
    by_profile = W.partitionBy("entries").orderBy("owner")
    first = vectors.withColumn("_place", F.row_number().over(by_profile)).filter(F.col("_place") <= keep)
    table = first.groupBy("entries").agg(
        F.min("owner").alias("profile_id"), F.sort_array(F.collect_list("owner")).alias("owners")
    )
    smallest = vectors.select("owner").orderBy("owner").limit(2 * keep)
    return Profiles(
        index=index,
        table=staged(_with_weights(table), "profiles"),
        vectors=vectors,
        first_owners=smallest.agg(F.sort_array(F.collect_list("owner"))).scalar(),
        keep=keep,
    )


def profile_of_owner(profiles: Profiles) -> DataFrame:
    """(owner, profile_id). The join splits profiles shared by very many owners (adaptive skew join)."""
    return profiles.vectors.join(profiles.table.select("entries", "profile_id"), "entries").select("owner", "profile_id")


def _packed(rows: Column, prefix: str) -> list[Column]:
    return [
        rows["id"].alias(f"{prefix}_ids"),
        F.transform(rows, lambda r: F.size(r["cats"])).alias(f"{prefix}_sizes"),
        F.flatten(rows["cats"]).alias(f"{prefix}_cats"),
        F.flatten(rows["weights"]).alias(f"{prefix}_weights"),
    ]


def _arrow_type(data_type: T.DataType) -> pa.DataType:
    return {
        T.LongType(): pa.int64(),
        T.IntegerType(): pa.int32(),
        T.StringType(): pa.string(),
    }[data_type]


def nearest_owners(found: DataFrame, owners: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` best owners per query from (query_id, profile_id, similarity).

    ``owners`` has each profile's first ``keep`` owners in order. Gives (query_id,
    owner, similarity, place).
    """
    by_query = W.partitionBy("query_id")
    best = found.withColumn(
        "_place", F.row_number().over(by_query.orderBy(F.desc("similarity"), "profile_id"))
    ).filter(F.col("_place") <= keep)
    listed = best.drop("_place").join(owners, "profile_id")
    # Profiles behind ``keep`` better owners cannot contribute.
    through = F.sum(F.size("owners")).over(
        by_query.orderBy(F.desc("similarity")).rangeBetween(W.unboundedPreceding, W.currentRow)
    )
    level = F.sum(F.size("owners")).over(W.partitionBy("query_id", "similarity"))
    needed = listed.withColumn("_better", through - level).filter(F.col("_better") < keep)
    return (
        needed.select("query_id", "similarity", F.explode("owners").alias("owner"))
        .withColumn("place", F.row_number().over(by_query.orderBy(F.desc("similarity"), "owner")))
        .filter(F.col("place") <= keep)
    )


def _tasks(profiles: Profiles, most: int) -> int:
    """Tasks for the block work, which is heavy for its bytes and must not be merged by size."""
    return max(1, min(most, -(-profiles.table.count() // ROWS_PER_TASK)))


def _cell_groups(candidates: DataFrame, width: Column) -> DataFrame:
    """(cell, cell_group, n_profiles): large cells alone, small ones together under the next free number."""
    sizes = candidates.groupBy("cell").agg(F.count("*").alias("n_profiles"))
    small = F.col("n_profiles") * 2 < BLOCK_ROWS
    return sizes.withColumn("cell_group", F.when(small, width).otherwise(F.col("cell")).cast("int"))


def nearest(queries: DataFrame, profiles: Profiles) -> DataFrame:
    """The ``keep`` nearest owners of each query.

    ``queries`` has (query_id, cats, weights, cell). Gives (query_id, neighbours),
    an array of (owner, similarity) by similarity descending, then owner.
    """
    spark = queries.sparkSession
    keep = profiles.keep
    tasks = _tasks(profiles, int(spark.conf.get("spark.sql.shuffle.partitions")))
    query_type = queries.schema["query_id"].dataType
    owner_type = profiles.table.schema["profile_id"].dataType
    query_sql, owner_sql = query_type.simpleString(), owner_type.simpleString()
    width = profiles.index.agg(F.count("*").cast("int")).scalar()

    candidates = profiles.table.filter(F.size("cats") > 0)
    groups = _cell_groups(candidates, width)
    sizes = groups.groupBy("cell_group").agg(
        F.ceil(F.sum("n_profiles") / F.lit(BLOCK_ROWS)).cast("int").alias("n_blocks")
    )
    # The group of every category's cell, -1 where there is no candidate.
    lookup = groups.agg(F.map_from_entries(F.collect_list(F.struct("cell", "cell_group")))).scalar()
    group_list = F.transform(F.sequence(F.lit(0), F.col("n_categories") - 1), lambda c: F.coalesce(F.col("_groups")[c], F.lit(-1)))
    blocks = (
        candidates.join(groups.select("cell", "cell_group"), "cell")
        .join(sizes, "cell_group")
        .withColumn("block", F.pmod(F.xxhash64("profile_id"), F.col("n_blocks")).cast("int"))
        .groupBy("cell_group", "block")
        .agg(
            F.collect_list(
                F.struct(F.col("profile_id").alias("id"), F.size("owners").alias("copies"), "cats", "weights")
            ).alias("rows")
        )
        .select("cell_group", "block", F.col("rows")["copies"].alias("p_copies"), *_packed(F.col("rows"), "p"))
    )
    # A query whose own cell has no candidate starts at any group.
    searching = (
        queries.filter(F.size("cats") > 0)
        .withColumn("_groups", lookup)
        .withColumn("cell_group", F.coalesce(F.col("_groups")[F.col("cell")], F.array_min(F.map_values("_groups"))))
        .drop("_groups")
    )
    loads = searching.groupBy("cell_group").agg(F.count("*").alias("n_queries"))
    grouped = (
        searching.join(loads, "cell_group")
        .join(sizes, "cell_group")
        .withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("n_blocks")).cast("int"))
        .withColumn(
            "part",
            F.pmod(
                F.xxhash64("query_id", F.lit(1)), F.ceil(F.col("n_queries") / F.col("n_blocks") / F.lit(BLOCK_ROWS))
            ).cast("int"),
        )
        .groupBy("cell_group", "block", "part")
        .agg(F.collect_list(F.struct(F.col("query_id").alias("id"), "cats", "weights")).alias("rows"))
        .select("cell_group", "block", "part", *_packed(F.col("rows"), "q"))
    )
    visits = (
        grouped.join(blocks, ["cell_group", "block"])
        .repartition(tasks, "cell_group", "block", "part")
        .drop("cell_group", "block", "part")
        .withColumn("n_categories", width)
        .withColumn("_groups", lookup)
        .withColumn("cell_groups", group_list)
        .drop("_groups")
        .mapInArrow(
            thresholds(keep, _arrow_type(query_type)),
            f"cell_group int, q_block {query_sql}, q_total int, q_at array<int>, q_ids array<{query_sql}>, "
            "q_floors array<double>, q_sizes array<int>, q_cats array<int>, q_weights array<double>",
        )
        .join(sizes, "cell_group")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .drop("n_blocks")
    )
    pairs = (
        visits.join(blocks, ["cell_group", "block"])
        .drop("block", "p_copies")
        .withColumn("n_categories", width)
        .repartition(tasks, "q_block")
        .sortWithinPartitions("q_block", "cell_group")
        .mapInArrow(
            best_of_blocks(keep, _arrow_type(query_type), _arrow_type(owner_type)),
            f"query_id {query_sql}, profile_id {owner_sql}, similarity double",
        )
    )
    # Written here, because the setting holds when the work is done.
    with arrow_rows(spark, ROWS_PER_BATCH):
        found = staged(pairs, "nearest-found")
    ranked = nearest_owners(found, profiles.table.select("profile_id", "owners"), keep)
    lists = (
        ranked.groupBy("query_id").agg(
            F.array_sort(F.collect_list(F.struct("place", "owner", "similarity"))).alias("_found")
        )
    )
    none = F.array().cast(f"array<struct<owner:{owner_sql},similarity:double>>")
    own = F.coalesce(
        F.transform("_found", lambda x: F.struct(x["owner"].alias("owner"), x["similarity"].alias("similarity"))), none
    )
    fill = F.transform(
        F.array_except("_first", F.col("_own.owner")),
        lambda o: F.struct(o.alias("owner"), F.lit(0.0).alias("similarity")),
    )
    return (
        queries.select("query_id")
        .join(lists, "query_id", "left")
        .withColumn("_own", own)
        .withColumn("_first", profiles.first_owners)
        .select(
            "query_id",
            F.when(F.size("_own") >= keep, F.col("_own"))
            .otherwise(F.slice(F.concat("_own", fill), 1, keep))
            .alias("neighbours"),
        )
    )


def profile_queries(profiles: Profiles) -> DataFrame:
    return profiles.table.select(F.col("profile_id").alias("query_id"), "cats", "weights", "cell")


def request_queries(requests: DataFrame, profiles: Profiles) -> DataFrame:
    """Queries from (request_id, category): the same rating in each category of the grid, none for other requests."""
    return weighted(request_vectors(requests, profiles).filter(F.size("entries") > 0))


def request_vectors(requests: DataFrame, profiles: Profiles) -> DataFrame:
    """(query_id, entries) of every request; repeated categories count once, those the grid does not have not at all."""
    numbered = requests.select(F.col("request_id").alias("query_id"), "category").join(profiles.index, "category", "left")
    entry = F.when(F.col("cat").isNotNull(), F.struct("cat", F.lit(1.0).alias("rating")))
    return numbered.groupBy("query_id").agg(F.array_sort(F.collect_set(entry)).alias("entries"))


def weighted(vectors: DataFrame) -> DataFrame:
    """Queries from (query_id, entries)."""
    return _with_weights(vectors)


def owner_neighbours(profiles: Profiles, k: int) -> DataFrame:
    """The k nearest other owners of every owner: (owner, neighbours)."""
    lists = nearest(profile_queries(profiles), profiles)
    return (
        profile_of_owner(profiles)
        .join(lists, F.col("profile_id") == F.col("query_id"))
        .select(
            F.col("owner").alias("customer_unique_id"),
            F.slice(F.filter("neighbours", lambda n: n["owner"] != F.col("owner")), 1, k).alias("neighbours"),
        )
    )


def neighbour_rows(lists: DataFrame, key: str) -> DataFrame:
    """One row per neighbour, numbered from 1."""
    return lists.select(key, F.posexplode("neighbours").alias("_at", "_n")).select(
        key,
        (F.col("_at") + 1).alias("place"),
        F.col("_n.owner").alias("neighbour_id"),
        F.col("_n.similarity").alias("similarity"),
    )
