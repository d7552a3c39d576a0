"""Gaps between repeat purchases, and a split into earlier and later rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.functions.scalars import round_half_even
from merchweave.functions.selection import nth_smallest
from merchweave.session import staged

HOT = 1_000_000  # rows that one task may sort for one user


def _micros(time: Column) -> Column:
    # Wall-clock time has no zone; UTC keeps its differences.
    return F.unix_micros(F.to_utc_timestamp(time.cast("timestamp"), "UTC"))


def with_previous(rows: DataFrame, group: str, order: Sequence[str], columns: Sequence[str], hot: int = HOT) -> DataFrame:
    """Add ``previous_<column>`` of the row before in the group, NULL for the first; ``order`` is unique in a group.

    Groups of more than ``hot`` rows are cut into slices by range. A slice looks back inside itself, and its
    first row takes the last row of the slice before, which is handed on as one row per slice.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot).select(group)
    large = staged(sizes, "large-groups")
    inside = W.partitionBy(group).orderBy(*order)
    small = rows.join(large, group, "left_anti").select(
        "*", *[F.lag(c).over(inside).alias(f"previous_{c}") for c in columns]
    )
    if large.isEmpty():
        return small
    # Written with their slice, so that a task run again gives the same slices.
    sliced = staged(
        rows.join(large, group, "left_semi").repartitionByRange(group, *order).withColumn("_slice", F.spark_partition_id()),
        "group-slices",
    )
    last = sliced.groupBy(group, "_slice").agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_last"))
    handed = last.withColumn("_handed", F.lag("_last").over(W.partitionBy(group).orderBy("_slice"))).drop("_last")
    within = W.partitionBy(group, "_slice").orderBy(*order)
    first = F.row_number().over(within) == 1
    joined = sliced.withColumns({"_first": first, **{f"_p_{c}": F.lag(c).over(within) for c in columns}}).join(
        handed, [group, "_slice"]
    )
    looked = joined.select(
        *rows.columns,
        *[F.when(F.col("_first"), F.col(f"_handed.{c}")).otherwise(F.col(f"_p_{c}")).alias(f"previous_{c}") for c in columns],
    )
    return small.unionByName(looked)


def repeat_gaps(purchases: DataFrame, user: str, order: str, time: str, hot: int = HOT) -> DataFrame:
    """Every order of a user but the first: the order before it and the days between, rounded to six digits."""
    known = purchases.select(user, order, time).dropna().distinct()
    looked = with_previous(known, user, [time, order], [order, time], hot)
    days = (_micros(F.col(time)) - _micros(F.col(f"previous_{time}"))).cast("double") / 86_400_000_000
    return looked.filter(F.col(f"previous_{order}").isNotNull()).select(
        user, order, f"previous_{order}", round_half_even(days, 6).alias("gap_days")
    )


def temporal_split(rows: DataFrame, time: str, share: float = 0.8) -> DataFrame:
    """Add ``split``: train up to the moment by which ``share`` of the rows have happened, test after it.

    Rows of one moment stay together, so nothing in train is later than anything in test. Rows without a
    time get NULL. The rows are read several times to find that moment, so they are written once.
    """
    rows = staged(rows, "split-rows")
    stamped = rows.select(_micros(F.col(time)).alias("at"))
    n = stamped.filter(F.col("at").isNotNull()).count()
    cut = nth_smallest(stamped, "at", max(1, -int(-(n * share) // 1))) if n else None
    early = _micros(F.col(time)) <= F.lit(cut)
    return rows.withColumn("split", F.when(F.col(time).isNotNull(), F.when(early, "train").otherwise("test")))
