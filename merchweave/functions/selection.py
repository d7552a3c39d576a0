"""The n-th smallest value and the n first rows by counts per bucket, without a global sort.

Values are counted in a bounded number of buckets; only the bucket that holds the n-th value is looked into
further. Nothing is shuffled but one row per task and bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def nth_smallest(df: DataFrame, column: str, n: int, buckets: int = BUCKETS) -> int | None:
    """The ``n``-th smallest (from 1) of a column of whole numbers; NULLs do not count; None if there are fewer."""
    values = df.select(F.col(column).cast("long").alias("v")).filter(F.col("v").isNotNull())
    low, high, total = values.agg(F.min("v"), F.max("v"), F.count("*")).first()
    if not 1 <= n <= total:
        return None
    while low < high:
        width = -(-(high - low + 1) // buckets)
        inside = values.filter(F.col("v").between(low, high))
        # Differences of far apart values pass 64 bits.
        bucket = F.expr(f"(cast(v as decimal(20,0)) - {low}BD) div {width}BD")
        counts = inside.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()  # as many as buckets at most
        for b, count in sorted((r.b, r.n) for r in counts):
            if n <= count:
                low, high = low + b * width, min(high, low + (b + 1) * width - 1)
                break
            n -= count
    return low


def first_by_hash(df: DataFrame, hash_column: str, order: Sequence[str], n: int) -> DataFrame:
    """The ``n`` first rows by a column of hexadecimal digests, equal ones by ``order``.

    Rows are counted by the first digits. All rows of the earlier buckets belong to the result, and of the bucket that
    the n-th row is in only the rows missing are put in order.
    """
    digits = 3
    bucket = F.conv(F.substring(hash_column, 1, digits), 16, 10).cast("int")
    counts = df.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()  # 16 ** digits rows at most
    last, left = -1, n
    for b, count in sorted((r.b, r.n) for r in counts):
        if count > left:
            rest = df.filter(bucket == b).orderBy(hash_column, *order).limit(left)
            return df.filter(bucket <= last).unionByName(rest)
        last, left = b, left - count
    return df
