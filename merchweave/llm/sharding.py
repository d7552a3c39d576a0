"""Shards of bounded size by extendible hashing.

A row's hash is read as a string of bits. The directory starts as one bucket of all rows; a bucket
over the byte limit splits on its next bit until every bucket fits. A shard is named by its prefix
of bits, so shards that fit stay as they are when others split.

Splitting works on sums: rows are added up once per prefix of a depth a little beyond the expected
one, every shorter prefix is a sum of those, and only buckets that are too large even there are
read again with more bits.

The bits are 60 of the id's MD5 and 60 more that differ between rows of one id, so that repeated
ids, NULL ids and fully repeated rows can be split as well. A row larger than the limit has a shard
of its own, with ``shard_bytes`` over the limit. NULL texts have zero bytes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchweave.llm.common import aside, hash_bits
from merchweave.session import staged

ID_BITS = 60
ALL_BITS = 120
SPARE = 6  # bits beyond the expected depth

OWN = ("__shard_bits", "__shard_bytes", "__fine", "__leaf")


_LEAF = "struct<depth: int, shard: string, shard_bytes: bigint, shard_rows: bigint>"


def _bits(id_column: str):
    def digits(value):
        return F.lpad(F.bin(value), ID_BITS, "0")

    own = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << ID_BITS))
    return F.concat(digits(hash_bits(F.coalesce(F.col(id_column).cast("string"), F.lit("")), 15)), digits(own))


def _leaves(rows: DataFrame, start: int, depth: int, limit: int) -> DataFrame:
    """Per prefix of ``depth`` bits the first bucket, from ``start`` bits on, that fits; NULL where none does.

    The sums come first, and prefixes meet them only from the depth on at which any bucket fits: the root and
    the short prefixes, which all rows share, are no join keys.
    """
    fine = rows.groupBy(F.substring("__shard_bits", 1, depth).alias("fine")).agg(
        F.sum("__shard_bytes").alias("bytes"), F.count("*").alias("n")
    )
    spread = fine.withColumn("depth", F.explode(F.sequence(F.lit(start), F.lit(depth)))).withColumn(
        "shard", F.expr("substring(fine, 1, depth)")
    )
    sums = spread.groupBy("depth", "shard").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
    fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | (F.col("depth") == ALL_BITS)
    buckets = staged(sums.filter(fits), "shard-buckets")
    first = buckets.agg(F.min("depth")).first()[0]
    if first is None:
        return fine.select("fine", F.lit(None).cast(_LEAF).alias("leaf"), "bytes")
    tried = fine.withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(depth)))).withColumn(
        "shard", F.expr("substring(fine, 1, depth)")
    )
    return (
        tried.join(buckets, ["depth", "shard"], "left")
        .groupBy("fine")
        .agg(
            F.min(F.when(F.col("shard_rows").isNotNull(), F.struct("depth", "shard", "shard_bytes", "shard_rows"))).alias("leaf"),
            F.first("bytes").alias("bytes"),
        )
    )


def shard(df: DataFrame, limit: int, id_column: str = "doc_id", text: str = "text", size: str | None = None) -> DataFrame:
    """Add shard (its bits), shard_depth, shard_bytes and shard_rows to every row.

    A row's bytes are those of ``text``, or the column ``size`` if given. All other columns of the caller stay as they
    are, whatever their names; columns named like the four added ones are replaced. An empty table gives an empty
    result with the same columns.

    The rows are written once to the shared folder, because their own bits must not change when a
    task runs again; drop columns that are not needed before.
    """
    clash = {"shard", "shard_depth", "shard_bytes", "shard_rows"} & set(df.columns)
    if clash:
        df = df.drop(*clash)  # an earlier assignment is replaced
    df, back = aside(df, OWN)
    own_bytes = F.coalesce(F.col(size) if size else F.octet_length(text), F.lit(0)).cast("long")
    rows = staged(df.withColumns({"__shard_bits": _bits(id_column), "__shard_bytes": own_bytes}), "shard-rows")
    total = rows.agg(F.sum("__shard_bytes")).first()[0] or 0
    found, pending, start, largest = None, rows, 0, total
    while True:
        need = SPARE + max(0, math.ceil(math.log2(max(largest, 1) / limit)))
        # Buckets that stay too large usually hold one id: go past its bits at once.
        depth = min(ALL_BITS, need if start == 0 else ID_BITS if start < ID_BITS else start + need)
        leaves = staged(_leaves(pending, start, depth, limit), "shard-leaves")
        done = leaves.filter("leaf is not null")
        placed = (
            pending.withColumn("__fine", F.substring("__shard_bits", 1, depth))
            .join(done.select(F.col("fine").alias("__fine"), F.col("leaf").alias("__leaf")), "__fine")
            .select(
                *[F.col(f"`{c}`") for c in df.columns],
                F.col("__leaf.shard").alias("shard"),
                F.col("__leaf.depth").alias("shard_depth"),
                F.col("__leaf.shard_bytes").alias("shard_bytes"),
                F.col("__leaf.shard_rows").alias("shard_rows"),
            )
        )
        found = placed if found is None else found.unionByName(placed)
        rest = leaves.filter("leaf is null")
        largest = rest.agg(F.max("bytes")).first()[0]
        if largest is None:
            return found.withColumnsRenamed(back)
        pending = pending.withColumn("__fine", F.substring("__shard_bits", 1, depth)).join(
            rest.select(F.col("fine").alias("__fine")), "__fine", "left_semi"
        ).drop("__fine")
        start = depth


def directory(sharded: DataFrame) -> DataFrame:
    """One row per shard: its prefix, depth, bytes and rows; slots is its share of a directory of the largest depth."""
    shards = sharded.select("shard", "shard_depth", "shard_bytes", "shard_rows").distinct()
    deepest = shards.agg(F.max("shard_depth")).first()[0] or 0
    return shards.withColumn("slots", F.pow(F.lit(2.0), F.lit(deepest) - F.col("shard_depth")))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write every shard as one Parquet file in a folder of its own."""
    sharded.withColumn("bits", F.concat(F.lit("b"), "shard")).repartition("bits").write.partitionBy("bits").parquet(path)
