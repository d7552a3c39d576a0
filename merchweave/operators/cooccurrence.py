"""What is bought together: the best partners of every item, with support, confidence and lift.

A pair never becomes a row. Items are dealt to blocks; a block gets, for every basket that holds one of its
items, those items and the whole basket as two lists, and counts its items' partners in numpy. Only the best ``k``
partners of an item leave the task. A basket of any size is cut into chunks whose lists meet chunk by chunk,
and an item with very many pairs has blocks of its own, each for one slice of its partners.

Where there are few different items (categories, say), every one of them has very many pairs. A basket is then a short
list whatever its lines, and every task adds its pairs up to one row per pair of items before anything is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.functions.scalars import round_half_even
from merchweave.session import staged

PAIRS = 2_000_000  # occurrences of pairs that a block counts, about
CHUNK = 256  # items of a basket in one list, about
HELD = 4_000_000  # pairs in a task before equal ones are added up
FEW_ITEMS = 500  # different items whose pairs every task may hold


class Codes(dict):
    """Items to numbers from 0 in order of arrival."""

    def __missing__(self, item: object) -> int:
        self[item] = number = len(self)
        return number


class PairCounts:
    """Counts of ordered pairs (item, partner) of one block."""

    def __init__(self) -> None:
        self.codes = Codes()
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, own: list[list], partners: list[list]) -> None:
        """All pairs of the lists of each row but an item with itself."""
        n_own = np.fromiter(map(len, own), np.int64, len(own))
        n_partners = np.fromiter(map(len, partners), np.int64, len(partners))
        code = self.codes.__getitem__
        left = np.fromiter((code(x) for row in own for x in row), np.int64, int(n_own.sum()))
        right = np.fromiter((code(x) for row in partners for x in row), np.int64, int(n_partners.sum()))
        # Every own item is repeated for each partner of its row, whose list starts at ``starts``.
        lengths = np.repeat(n_partners, n_own)
        starts = np.repeat(np.cumsum(n_partners) - n_partners, n_own)
        at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        left, right = np.repeat(left, lengths), right[at + np.repeat(starts, lengths)]
        differ = left != right
        pairs = left[differ] << 32 | right[differ]
        self.parts.append((pairs, np.ones(len(pairs), np.int64)))
        self.held += len(pairs)
        if self.held > HELD:
            self._sum()

    def _sum(self) -> tuple[np.ndarray, np.ndarray]:
        pairs = np.concatenate([p for p, _ in self.parts]) if self.parts else np.zeros(0, np.int64)
        n = np.concatenate([n for _, n in self.parts]) if self.parts else np.zeros(0, np.int64)
        found, place = np.unique(pairs, return_inverse=True)
        totals = np.zeros(len(found), np.int64)
        np.add.at(totals, place, n)
        self.parts, self.held = [(found, totals)], 0
        return found, totals

    def best(self, k: int) -> tuple[list, list, np.ndarray]:
        """The ``k`` partners of each item with most baskets in common, ties by the smaller partner."""
        pairs, n = self._sum()
        items = list(self.codes)
        left, right = pairs >> 32, pairs & 0xFFFFFFFF
        rank = np.empty(len(items), np.int64)
        rank[sorted(range(len(items)), key=items.__getitem__)] = np.arange(len(items))
        order = np.lexsort((rank[right], -n, left))
        left, right, n = left[order], right[order], n[order]
        new = np.concatenate([[True], left[1:] != left[:-1]]) if len(left) else np.zeros(0, bool)
        place = np.arange(len(left)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        chosen = place < k
        return [items[i] for i in left[chosen]], [items[i] for i in right[chosen]], n[chosen]


def partner_counts(dealt: DataFrame, kind: str, k: int) -> DataFrame:
    """(item, partner, n_both): the best partners of each block and slice; ``dealt`` has (block, slice, own, partners)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, counts = None, PairCounts()

        def found() -> pa.RecordBatch:
            items, partners, n = counts.best(k)
            return pa.RecordBatch.from_pydict({"item": items, "partner": partners, "n_both": pa.array(n)}, schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column("block").to_numpy(), batch.column("slice").to_numpy()])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            own, partners = (batch.column(c).to_pylist() for c in ("own", "partners"))
            for a, b in zip(cuts, cuts[1:], strict=False):
                if key is not None and key != tuple(keys[:, a]):
                    yield found()
                    counts = PairCounts()
                key = tuple(keys[:, a])
                counts.add(own[a:b], partners[a:b])
        if key is not None:
            yield found()

    names = ["item", "partner", "n_both"]
    element = dealt.schema["own"].dataType.elementType
    # The Arrow schema of the ids is that of an empty result.
    schema = pa.schema([(n, t) for n, t in zip(names, [*_arrow(element, 2), pa.int64()], strict=True)])
    sorted_ = dealt.repartition("block", "slice").sortWithinPartitions("block", "slice")
    return sorted_.mapInArrow(run, f"item {kind}, partner {kind}, n_both long")


def _arrow(spark_type, n: int) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(spark_type)] * n


def few_items_counts(held: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """(item, partner, n_both) of all pairs, (item, n_baskets) and the number of baskets.

    ``held`` has (basket, item); a basket's list has no more entries than there are different items.
    """
    lists = staged(held.groupBy("basket").agg(F.collect_set("item").alias("items")).select("items"), "basket-lists")
    items = lists.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n_baskets"))
    both = (
        lists.filter(F.size("items") > 1)
        .select("items", F.explode("items").alias("item"))
        .select("item", F.explode("items").alias("partner"))
        .filter("item <> partner")
        .groupBy("item", "partner")
        .agg(F.count("*").alias("n_both"))
    )
    return both, staged(items, "basket-items"), lists.agg(F.count("*")).scalar()


def bought_together(
    lines: DataFrame, basket: str, item: str, k: int = 10, pairs: int = PAIRS, chunk: int = CHUNK, few: int = FEW_ITEMS
) -> DataFrame:
    """(item, rank, partner, n_both, support, confidence, lift) of the ``k`` best partners of every item.

    An item counts once in a basket. ``support`` is the share of all baskets that hold both, ``confidence`` the
    share of the item's baskets, ``lift`` the confidence over the partner's share of all baskets. Lines without
    basket or item do not count. The item's column keeps its name, ``partner`` has its type. About ``few`` different
    items or less are counted without blocks; the result is the same.
    """
    kind = lines.schema[item].dataType.simpleString()
    held = lines.select(F.col(basket).alias("basket"), F.col(item).alias("item")).dropna()
    # Sets tell 0.0 from -0.0, which are one item.
    if kind not in ("float", "double") and held.agg(F.approx_count_distinct("item")).first()[0] <= few:
        counts, items, n_baskets = few_items_counts(held)
    else:
        counts, items, n_baskets = block_counts(held.distinct(), kind, k, pairs, chunk)
    # A sliced item has k partners from every slice.
    order = W.partitionBy("item").orderBy(F.desc("n_both"), F.asc("partner"))
    best = (
        counts.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .join(items.select("item", "n_baskets"), "item")
        .join(items.select(F.col("item").alias("partner"), F.col("n_baskets").alias("partner_baskets")), "partner")
    )
    both, all_ = F.col("n_both").cast("double"), n_baskets.cast("double")
    return best.select(
        F.col("item").alias(item),
        "rank",
        "partner",
        "n_both",
        round_half_even(both / all_, 9).alias("support"),
        round_half_even(both / F.col("n_baskets"), 9).alias("confidence"),
        round_half_even(both * all_ / (F.col("n_baskets") * F.col("partner_baskets")), 9).alias("lift"),
    )


def block_counts(held: DataFrame, kind: str, k: int, pairs: int, chunk: int) -> tuple[DataFrame, DataFrame, Column]:
    """As ``few_items_counts`` for any number of items, with the best ``k`` partners of each block and slice only."""
    sizes = held.groupBy("basket").agg(F.count("*").alias("n_items"))
    sized = staged(held.join(sizes, "basket"), "baskets")
    n_baskets = sized.agg(F.count_distinct("basket")).scalar()
    items = sized.groupBy("item").agg(F.count("*").alias("n_baskets"), F.sum(F.col("n_items") - 1).alias("pairs"))
    items = staged(items.withColumn("slices", F.greatest(F.lit(1), F.ceil(F.col("pairs") / F.lit(pairs)))), "basket-items")
    total = items.filter("slices = 1").agg(F.sum("pairs")).first()[0] or 0
    blocks = max(held.sparkSession.sparkContext.defaultParallelism, math.ceil(total / pairs))
    # Blocks behind the others belong to single items with many pairs.
    hashed = F.xxhash64("item")
    block = F.when(F.col("slices") > 1, F.pmod(hashed, F.lit(1 << 40)) + blocks).otherwise(F.pmod(hashed, F.lit(blocks)))
    placed = items.select("item", "slices", block.alias("block"))

    shared = sized.filter("n_items > 1")
    chunks = F.ceil(F.col("n_items") / F.lit(chunk))
    lists = (
        shared.withColumn("part", F.pmod(F.xxhash64("item", F.lit(1)), chunks))
        .groupBy("basket", "part")
        .agg(F.collect_list("item").alias("partners"))
        .drop("part")
    )
    own = (
        shared.withColumn("part", F.pmod(F.xxhash64("item", F.lit(2)), chunks))
        .join(placed, "item")
        .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
        .groupBy("basket", "block", "slices", "slice", "part")
        .agg(F.collect_list("item").alias("own"))
    )
    inside = F.filter("partners", lambda x: F.pmod(F.xxhash64(x, F.lit(3)), F.col("slices")) == F.col("slice"))
    met = own.join(lists, "basket").select(
        "block", "slice", "own", F.when(F.col("slices") > 1, inside).otherwise(F.col("partners")).alias("partners")
    )
    return partner_counts(met, kind, k), items, n_baskets
