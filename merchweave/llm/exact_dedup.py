"""Exact deduplication by a two-pass Bloom filter.

The first pass sets, for every text, two positions given by its hash and keeps those that were
set at least twice. A text whose two positions are both kept is possibly repeated. In the second
pass only possibly repeated rows are shuffled and grouped by their whole hash; all other rows
pass straight through. The filter is broadcast: its size is fixed by ``max_bits`` whatever the
input, and a filter that is too small only sends more rows through the shuffle.

Texts are compared by SHA-256 of their UTF-8 bytes. NULL counts as the empty text. Of equal texts
the row with the largest id stays (NULL ids come last); of rows that also share the id, exactly
one stays. Empty tables give empty results; all other columns pass through untouched, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchweave.session import staged

HASHES = 2
BITMAP = 32_768  # positions in one bitmap of bitmap_construct_agg
BITS_PER_ROW = 16
MAX_BITS = 1 << 27  # 16 MB for each hash

KEY = "__dedup_sha"
POSSIBLE = "__dedup_possible"


def text_key(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _position(key: str, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(bits))


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """A power of two, 16 to 32 positions a row, within the fixed bounds."""
    return max(BITMAP, min(max_bits, 1 << max(0, BITS_PER_ROW * rows - 1).bit_length()))


def repeated_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """First pass: the positions that two rows or more have set, as bitmaps (part, bucket, bitmap)."""
    set_by = keys.select(
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("part"), _position(key, i, bits).alias("pos")) for i in range(HASHES)])
        ).alias("p")
    )
    twice = set_by.groupBy("p.part", "p.pos").agg(F.count("*").alias("n")).filter("n > 1")
    return twice.groupBy("part", F.expr(f"pos div {BITMAP}").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("pos") % BITMAP).alias("bitmap")
    )


def mark_possible(df: DataFrame, key: str, bitmaps: DataFrame, bits: int) -> DataFrame:
    """Second pass: add ``POSSIBLE``, true for every row whose key may occur again."""
    flags = F.lit(True)
    for i in range(HASHES):
        bucket, bitmap = f"__dedup_bucket{i}", f"__dedup_bitmap{i}"
        part = bitmaps.filter(F.col("part") == i).select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bitmap))
        pos = _position(key, i, bits)
        # At most bits / 8 bytes of bitmaps, fixed by max_bits.
        df = df.join(F.broadcast(part), F.floor(pos / BITMAP) == F.col(bucket), "left")
        byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(pos % BITMAP / 8) + 1).cast("int"), F.lit(1))), 16, 10)
        bit = F.floor(byte.cast("int") / F.pow(F.lit(2), pos % 8)).cast("int") % 2
        flags = flags & F.coalesce(bit == 1, F.lit(False))
    extra = [f"__dedup_{x}{i}" for x in ("bucket", "bitmap") for i in range(HASHES)]
    return df.withColumn(POSSIBLE, flags).drop(*extra)


def text_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    keys = staged(docs.select(F.col(id_column).alias("doc_id"), text_key(text).alias(KEY)), "text-keys")
    bits = filter_bits(keys.count(), max_bits)
    marked = mark_possible(keys, KEY, staged(repeated_filter(keys, KEY, bits), "bloom"), bits)
    alone = marked.filter(~F.col(POSSIBLE)).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col(KEY).alias("text_sha256"),
    )
    # Rows with equal id and text are interchangeable: they travel as one row and a count.
    rows = marked.filter(POSSIBLE).groupBy(KEY, "doc_id").agg(F.count("*").alias("__n"))
    groups = rows.groupBy(F.col(KEY).alias("__key")).agg(
        F.max("doc_id").alias("keep_id"), F.sum("__n").alias("group_size")
    )
    shared = (
        rows.join(groups, F.col(KEY) == F.col("__key"))
        .withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("__i") == 1)).alias("kept"),
            F.col(KEY).alias("text_sha256"),
        )
    )
    return alone.unionByName(shared)


def deduplicate(df: DataFrame, id_column: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows that stay, with all their columns.

    A possibly repeated row is reduced to the best of its group in each task before the shuffle, so a
    group of any size sends one row per task. Of rows equal in text and id the one with the largest
    hash over all columns stays.
    """
    keys = staged(df.select(text_key(text).alias(KEY)), "text-keys")
    bits = filter_bits(keys.count(), max_bits)
    marked = mark_possible(df.withColumn(KEY, text_key(text)), KEY, staged(repeated_filter(keys, KEY, bits), "bloom"), bits)
    hashed = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    best = (
        marked.filter(POSSIBLE)
        .groupBy(KEY)
        .agg(
            F.max_by(
                F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(F.col(id_column), F.xxhash64(*hashed))
            ).alias("__row")
        )
        .select(*[F.col(f"__row.`{c}`") for c in df.columns])
    )
    return marked.filter(~F.col(POSSIBLE)).select(*[F.col(f"`{c}`") for c in df.columns]).unionByName(best)
