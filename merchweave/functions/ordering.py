"""Global ranks, running positions and exact medians without a single huge task.

Rows are range partitioned on the ordering, written with their slice number,
numbered inside each slice, and shifted by the sizes of the earlier slices. The
only single-task step works on one row per slice and group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchweave.session import staged

# Distinct values for which every task may hold all of them, and for which one task may.
TINY_DOMAIN = 10_000
SMALL_DOMAIN = 1_000_000


def running_total(
    df: DataFrame,
    order: Sequence[str],
    weight: str,
    group: Sequence[str] = (),
    descending: Sequence[str] = (),
    total_before: str = "n_before",
    group_total: str = "n_total",
) -> DataFrame:
    """Add the weight of all earlier rows of the group, and the group's weight.

    ``order`` must be unique within a group. A group of any size is spread over
    as many slices as its share of the rows. Whole weights give whole totals.
    """
    number = "double" if isinstance(df.schema[weight].dataType, T.DoubleType) else "long"
    zero = F.lit(0).cast(number)

    def direction(name: str) -> Column:
        return F.col(name).desc() if name in descending else F.col(name).asc()

    slices = staged(
        df.repartitionByRange(*[F.col(g).asc() for g in group], *[direction(o) for o in order]).withColumn(
            "_slice", F.spark_partition_id()
        ),
        "slices",
    )
    sizes = slices.groupBy(*group, "_slice").agg(F.sum(weight).cast(number).alias("_size"))
    by_group = W.partitionBy(*[F.col(g) for g in group])
    offsets = sizes.select(
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.col("_slice").alias("_s"),
        F.coalesce(
            F.sum("_size").over(by_group.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)), zero
        ).alias("_offset"),
        F.sum("_size").over(by_group).alias(group_total),
    )
    matches = F.col("_slice") == F.col("_s")
    for g in group:
        matches = matches & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    inside = W.partitionBy(*group, "_slice").orderBy(*[direction(o) for o in order])
    earlier = F.coalesce(F.sum(weight).over(inside.rowsBetween(W.unboundedPreceding, -1)), zero)
    return (
        slices.withColumn("_earlier", earlier)
        .join(offsets, matches, "inner")
        .withColumn(total_before, (F.col("_offset") + F.col("_earlier")).cast(number))
        .withColumn(group_total, F.col(group_total).cast(number))
        .drop("_slice", "_s", "_offset", "_earlier", "_size", *[f"_g_{g}" for g in group])
    )


def positions(
    df: DataFrame,
    order: Sequence[str],
    group: Sequence[str] = (),
    descending: Sequence[str] = (),
    name: str = "position",
) -> DataFrame:
    """Row number from 1 within the group, for groups of any size."""
    numbered = running_total(df.withColumn("_one", F.lit(1)), order, "_one", group, descending)
    return numbered.withColumn(name, F.col("n_before") + 1).drop("_one", "n_before", "n_total")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL numeric values per column: (column_name, value, n)."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    return long.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count("*").alias("n"))


def ranked_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column and distinct value: n, rows with a smaller value, rows in all."""
    return running_total(value_counts(df, columns), ["value"], "n", group=["column_name"])


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact interpolating medians as rows (column_name, median).

    Spark's exact percentile holds one entry per distinct value. Columns with very
    few values go there directly, columns with a moderate number are counted by
    value first, so that each value reaches it once, and the others are ranked in
    slices.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, median double")
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first().asDict()
    tiny = [c for c in columns if sizes[c] <= TINY_DOMAIN]
    small = [c for c in columns if TINY_DOMAIN < sizes[c] <= SMALL_DOMAIN]
    large = [c for c in columns if sizes[c] > SMALL_DOMAIN]
    parts = []
    if tiny:
        wide = df.agg(*[F.percentile(F.col(c).cast("double"), F.lit(0.5)).alias(c) for c in tiny])
        parts.append(wide.unpivot([], tiny, "column_name", "median"))
    if small:
        parts.append(medians_by_count(df, small))
    if large:
        parts.append(medians_by_rank(df, large))
    return reduce(DataFrame.unionByName, parts)


def _with_all_names(medians: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns without any value get a NULL median."""
    names = medians.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in columns])).alias("column_name")
    )
    return names.join(medians, "column_name", "left")


def medians_by_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = value_counts(df, columns)
    medians = counts.groupBy("column_name").agg(F.percentile("value", F.lit(0.5), F.col("n")).alias("median"))
    return _with_all_names(medians, columns)


def medians_by_rank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    ranked = ranked_values(df, columns)
    low, high = F.floor((F.col("n_total") - 1) / 2), F.ceil((F.col("n_total") - 1) / 2)

    def holds(rank: Column) -> Column:
        return (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))

    middle = ranked.groupBy("column_name").agg(
        ((F.max(F.when(holds(low), F.col("value"))) + F.max(F.when(holds(high), F.col("value")))) / 2).alias("median")
    )
    return _with_all_names(middle, columns)
