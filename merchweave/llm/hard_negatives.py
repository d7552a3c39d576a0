"""Hard negatives by best-first search in STR-packed R-trees.

For every anchor the rows of its label with the highest inner products are its positives. For every positive
the negatives are the rows of other labels whose score lies in a window below the positive's score, highest
first, ties by the smaller id.

Rows are cut into tiles by sort-tile-recursive packing: slices of equal size along the label, then in each
slice along the coordinate that varies most, and so on; cuts are quantiles over all rows, and values that
tie are spread by the hash of the id, so a common label or value fills as many tiles as it needs. A task that
gets a tile packs its rows the same way into an R-tree. The bounding box of a node gives every coordinate's
product with the anchor an interval and their sum an interval for the score. A queue takes the node with
the highest bound first and drops those outside the window, of the wrong label, or strictly below the k-th
score found so far, so ties are never lost. Leaves are multiplied exactly. Each tile gives the best k of its
own and the best k of these are the result.

All rows of a tile come before its anchors in one sorted partition, and anchors stream past the tree, so a task
holds one tile and one batch whatever the number of anchors. Of rows that are equal in label and vector only the
smallest k + 1 ids can be in a result; the others are not sent on. Rows with equal id, label and vector count
once. Rows that share the anchor's id are none of its positives or negatives.

Rows with a NULL id, a NULL label, a NULL vector or a NULL component take no part; shorter vectors count as filled up with
zeros. Scores have to fit into 64 bits, otherwise an error is raised. An empty table gives an empty result. Other
columns are not looked at, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.llm.common import arrow_rows
from merchweave.session import staged

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # per cent of the positive's score
TILE = 16_384  # rows
SLICES = 16  # of a tile along one coordinate at most
LEAF = 64
FANOUT = 16
SPREAD = 3  # coordinates by which a tree sorts its rows, beside the label
ROWS = 4096  # to a Python worker at a time


def valid(rows: DataFrame, id_column: str, label: str, vector: str) -> DataFrame:
    """(id, label, v): the different rows that take part, vectors of whole numbers all equally long."""
    known = rows.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<bigint>").alias("v"),
    ).filter(
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("v").isNotNull()
        & ~F.coalesce(F.exists("v", lambda x: x.isNull()), F.lit(False))
    )
    size = F.array_max(F.transform("v", lambda x: F.abs(x.cast("decimal(20,0)"))))
    width, largest = known.agg(F.max(F.size("v")), F.max(size)).first()
    if width and 100 * width * int(largest or 0) ** 2 >= 1 << 63:
        raise ValueError(f"scores of vectors with components up to {largest} do not fit into 64 bits")
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width or 0) - F.size("v"))
    return known.withColumn("v", F.concat("v", zeros)).distinct()


def smallest(rows: DataFrame, copies: int) -> DataFrame:
    """Of rows equal in label and vector those with the smallest ids; every task sends ``copies`` of them at most."""
    order = W.partitionBy("label", "v").orderBy("id")
    return rows.withColumn("copy", F.row_number().over(order)).filter(F.col("copy") <= copies).drop("copy")


def tiles(rows: DataFrame, size: int = TILE) -> tuple[DataFrame, int]:
    """Rows with ``tile``, sort-tile-recursive slices of about ``size`` rows, and the number of tiles."""
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    wanted = math.ceil(n / size)
    levels = max(1, math.ceil(math.log(wanted, SLICES) - 1e-9)) if wanted > 1 else 0
    slices = math.ceil(wanted ** (1 / levels) - 1e-9) if levels else 1
    along: list[Column] = [F.col("label")]
    if levels > 1 and width:
        spread = rows.agg(*[F.var_pop(F.get("v", F.lit(i))).alias(str(i)) for i in range(width)]).first()
        along += [F.get("v", F.lit(i)) for i in sorted(range(width), key=lambda i: (-spread[i], i))]
    out, number = rows.withColumn("tile", F.pmod("id", F.lit(1))), 1  # all in tile 0
    for coordinate in along[:levels]:
        # Equal values are dealt by a fraction of one between them and the next.
        fraction = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        valued = out.withColumn("value", coordinate.cast("double") + fraction)
        steps = F.array(*[F.lit(i / slices) for i in range(1, slices)])
        cuts = valued.groupBy("tile").agg(F.percentile_approx("value", steps, F.lit(10_000)).alias("cuts"))
        place = F.size(F.filter("cuts", lambda c: c < F.col("value")))
        out = valued.join(cuts, "tile").withColumn("tile", F.col("tile") * slices + place).drop("value", "cuts")
        number *= slices
    return out, number


class Tree:
    """A packed R-tree: leaves are runs of ``LEAF`` rows in STR order, nodes above runs of ``FANOUT`` nodes below."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray):
        spread = np.argsort(-points.var(axis=0), kind="stable")[:SPREAD] if points.size else []
        keys = [labels, *(points[:, i] for i in spread)]
        order = self._packed(keys, np.arange(len(ids)), 0)
        self.ids, self.labels, self.points = ids[order], labels[order], points[order]
        self.levels = [self._boxes(self.points, self.points, self.labels, self.labels, LEAF)]
        while len(self.levels[-1][0]) > 1:
            self.levels.append(self._boxes(*self.levels[-1], FANOUT))

    @staticmethod
    def _packed(keys: list[np.ndarray], rows: np.ndarray, depth: int) -> np.ndarray:
        pages = math.ceil(len(rows) / LEAF)
        if pages <= 1 or depth == len(keys):
            return rows
        rows = rows[np.argsort(keys[depth][rows], kind="stable")]
        slabs = math.ceil(pages ** (1 / (len(keys) - depth)) - 1e-9)
        step = math.ceil(pages / slabs) * LEAF
        return np.concatenate([Tree._packed(keys, rows[i : i + step], depth + 1) for i in range(0, len(rows), step)])

    @staticmethod
    def _boxes(low: np.ndarray, high: np.ndarray, first: np.ndarray, last: np.ndarray, step: int) -> tuple[np.ndarray, ...]:
        at = np.arange(0, len(low), step)
        return (
            np.minimum.reduceat(low, at, axis=0),
            np.maximum.reduceat(high, at, axis=0),
            np.minimum.reduceat(first, at),
            np.maximum.reduceat(last, at),
        )


class Search:
    """Best-first searches of one anchor in one tree; boxes and leaves it has multiplied once are kept."""

    def __init__(self, tree: Tree, anchor: int, label: int, vector: np.ndarray):
        self.tree, self.anchor, self.label, self.vector = tree, anchor, label, vector
        self.up, self.down = np.maximum(vector, 0), np.minimum(vector, 0)
        self.bounds: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.scores: dict[int, np.ndarray] = {}

    def _children(self, level: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """The lowest and highest score that the boxes ``first`` to ``last`` of a level allow."""
        if (level, first) not in self.bounds:
            low, high = (x[first:last] for x in self.tree.levels[level][:2])
            self.bounds[level, first] = low @ self.up + high @ self.down, high @ self.up + low @ self.down
        return self.bounds[level, first]

    def _leaf(self, i: int) -> np.ndarray:
        if i not in self.scores:
            self.scores[i] = self.tree.points[i * LEAF : (i + 1) * LEAF] @ self.vector
        return self.scores[i]

    def best(self, k: int, same_label: bool, least: float = -math.inf, most: float = math.inf) -> list[tuple[int, int]]:
        """The first ``k`` (score, id) of the window, of the anchor's label or of all others."""
        tree, found, kth = self.tree, [], -math.inf
        queue: list[tuple[float, int, int]] = []

        def push(level: int, first: int, last: int) -> None:
            lowest, highest = self._children(level, first, last)
            _, _, smallest, largest = (x[first:last] for x in tree.levels[level])
            inside = (highest >= least) & (lowest <= most) & (highest >= kth)
            if same_label:
                inside &= (smallest <= self.label) & (largest >= self.label)
            else:
                inside &= (smallest != self.label) | (largest != self.label)
            for i in np.flatnonzero(inside).tolist():
                heapq.heappush(queue, (-min(highest[i], most), level, first + i))

        top = len(tree.levels) - 1
        push(top, 0, len(tree.levels[top][0]))
        while queue:
            bound, level, i = heapq.heappop(queue)
            if -bound < kth:
                break  # and so are all that are left
            if level:
                push(level - 1, i * FANOUT, min((i + 1) * FANOUT, len(tree.levels[level - 1][0])))
                continue
            score, own = self._leaf(i), slice(i * LEAF, (i + 1) * LEAF)
            labels, ids = tree.labels[own], tree.ids[own]
            fits = ((labels == self.label) == same_label) & (ids != self.anchor)
            fits &= (score >= max(least, kth)) & (score <= most)
            hit = np.flatnonzero(fits)
            if len(hit):
                found += [(-int(s), int(j)) for s, j in zip(score[hit].tolist(), ids[hit].tolist(), strict=True)]
                found.sort()
                del found[k:]
                if len(found) == k:
                    kth = -found[-1][0]
        return [(-s, j) for s, j in found]


def searched(tiled: DataFrame, anchors: DataFrame, schema: str, search) -> DataFrame:
    """Give every anchor (tile, aid, id, label, v, scores) to its tile; ``search(Search, scores)`` yields result rows."""
    columns = ["tile", "kind", "aid", "id", "label", "v", "scores"]
    none = F.lit(None).cast("array<bigint>")
    rows = tiled.withColumns({"kind": F.lit(0), "aid": F.lit(0).cast("long"), "scores": none}).select(*columns)
    both = rows.unionByName(anchors.withColumn("kind", F.lit(1)).select(*columns))
    fields = [f.split()[0] for f in schema.split(", ")]

    def arrays(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, labels = (part.column(c).to_numpy() for c in ("id", "label"))
        values = part.column("v").flatten().to_numpy()
        return ids, labels, values.reshape(len(ids), len(values) // len(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, parts, tree = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column("tile").to_numpy(), batch.column("kind").to_numpy()])
            starts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:], strict=False):
                part = batch.slice(a, b - a)
                if key[0, a] != tile:
                    tile, parts, tree = key[0, a], [], None
                if key[1, a] == 0:
                    parts.append(arrays(part))
                    continue
                if tree is None:
                    if not parts:
                        continue
                    ids, labels, points = (np.concatenate(x) for x in zip(*parts, strict=True))
                    # Doubles are exact up to 2**53 and multiply faster.
                    exact = points.shape[1] * int(np.abs(points).max(initial=0)) ** 2 < 1 << 53
                    tree = Tree(ids, labels, points.astype(np.float64) if exact else points)
                found = []
                for aid, scores, i, label, v in zip(
                    part.column("aid").to_pylist(), part.column("scores").to_pylist(), *arrays(part), strict=True
                ):
                    one = Search(tree, int(i), int(label), v.astype(tree.points.dtype))
                    found += [(aid, *row) for row in search(one, scores)]
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(fields, row, strict=True)) for row in found],
                    pa.schema([(f, pa.int64()) for f in fields]),
                )

    dealt = both.repartition("tile").sortWithinPartitions("tile", "kind")
    return dealt.mapInArrow(run, schema)


def first(rows: DataFrame, k: int, score: str, id_column: str, *group: str) -> DataFrame:
    """The first ``k`` of each group, with their ``rank``."""
    order = W.partitionBy(*group).orderBy(F.desc(score), F.asc(id_column))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchor: Column,
    id_column: str = "id",
    label: str = "label",
    vector: str = "v",
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    size: int = TILE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` tells anchors by the columns id and label. A negative's score has at least ``low`` and at most
    ``high`` per cent of the positive's. Vectors hold whole numbers.
    """
    spark = rows.sparkSession
    every = valid(rows, id_column, label, vector)
    with arrow_rows(spark, ROWS):
        # Written once: quantiles and the jobs after them must see the same rows and tiles.
        every = staged(every, "vectors")
        tiled, n_tiles = tiles(staged(smallest(every, max(n_positives, n_negatives) + 1), "different-vectors"), size)
        tiled = staged(tiled, "vector-tiles")
        anchors = staged(every.filter(anchor).withColumn("aid", F.monotonically_increasing_id()), "anchors")
        homes = tiled.select("tile", "label").distinct()
        asked = anchors.join(homes, "label").withColumn("scores", F.lit(None).cast("array<bigint>"))
        near = searched(
            tiled,
            asked,
            "aid long, positive_score long, positive_id long",
            lambda one, _: one.best(n_positives, same_label=True),
        )
        positives = staged(first(near, n_positives, "positive_score", "positive_id", "aid").drop("rank"), "positives")
        wanted = positives.groupBy("aid").agg(F.collect_set("positive_score").alias("scores"))  # n_positives at most
        # The anchors against all rows, in tiles: each searches the tree of every tile.
        asked = anchors.join(wanted, "aid").withColumn(
            "tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_tiles - 1).cast("long")))
        )

        def windows(one: Search, scores: list[int]) -> Iterator[tuple[int, int, int]]:
            for s in scores:
                for score, i in one.best(n_negatives, False, -(-low * s // 100), high * s // 100):
                    yield s, score, i

        hard = staged(
            searched(tiled, asked, "aid long, positive_score long, negative_score long, negative_id long", windows),
            "negatives",
        )
    best = first(hard, n_negatives, "negative_score", "negative_id", "aid", "positive_score")
    return (
        positives.join(best, ["aid", "positive_score"])
        .join(anchors.select("aid", F.col("id").alias("anchor_id")), "aid")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
