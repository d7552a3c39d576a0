"""Toxicity by a classifier chain over the label columns.

The chain has one linear model per category. The first sees the text, every later one also the
probabilities of the categories before it. In training those come from models that have not seen
the document (``FOLDS`` folds), in scoring from the final models.

A text's features are the character 5-grams of its distinct words, with marks at both ends of a
word, so stems count whatever their endings. The chain is fitted on at most ``SAMPLE`` labelled
documents, those with the smallest hash of their id, rows equal in id and text being one; on these the ``FEATURES`` grams that tell most
about any category are chosen by a chi-square count and the models fitted by logistic regression.
Grams that may as well be chance are left out by their exact (hypergeometric) probability, so that at
most ``CHANCE`` of the chosen are expected to be such: with few labels or a rare category few documents
are enough, among many grams more are asked for.
A document is put into a category if its probability is over ``THRESHOLD``. All documents are scored,
whole.

Labels with a NULL are left out; of repeated labels the largest counts. Without labels, or with one
class only, a category's probability is its share and nothing is rejected. NULL texts are empty; an
empty text has no features. Rows with equal texts have equal scores. Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchweave.session import staged

GRAM = 5
SAMPLE = 20_000
FEATURES = 512
LEAST_DOCS = 3  # that hold a gram
CHANCE = 0.1  # share of the chosen grams that may be there by chance
FOLDS = 5
ROUNDS = 120
RATE = 0.2
DECAY = 1e-4
THRESHOLD = 0.5
WORDS_KEPT = 300_000

CATEGORIES = {"junk": "quality = 0", "toxic": "toxic = 1"}

_WORD = re.compile(r"\w+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def grams(word: str) -> list[str]:
    marked = f"^{word}$"
    return [marked[i : i + GRAM] for i in range(max(1, len(marked) - GRAM + 1))]


class Lookup:
    """Indices of the chosen grams in a text; what a word holds is kept for words seen lately."""

    def __init__(self, features: Sequence[str]):
        self.index = {g: i for i, g in enumerate(features)}
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> list[int]:
        known, index, found = self.known, self.index, set()
        if len(known) > WORDS_KEPT:
            known.clear()
        for w in words(text):
            hit = known.get(w)
            if hit is None:
                hit = known[w] = tuple({index[g] for g in grams(w) if g in index})
            if hit:
                found.update(hit)
        return sorted(found)


@dataclass
class Model:
    weights: np.ndarray  # of the grams
    earlier: np.ndarray  # of the probabilities before it
    bias: float

    def margin(self, rows: np.ndarray, cols: np.ndarray, n: int, earlier: np.ndarray) -> np.ndarray:
        return self.bias + np.bincount(rows, self.weights[cols], n) + earlier @ self.earlier


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(rows: np.ndarray, cols: np.ndarray, earlier: np.ndarray, y: np.ndarray, n_features: int) -> Model:
    """Logistic regression by full-batch Adam; a constant where there is one class only."""
    n, share = len(y), float(y.mean()) if len(y) else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(n_features), np.zeros(earlier.shape[1]), 30.0 if share else -30.0)
    # At most SAMPLE by FEATURES numbers and the few columns of the chain.
    inputs = np.zeros((n, n_features + earlier.shape[1] + 1), np.float32)
    inputs[rows, cols] = 1
    inputs[:, n_features:-1] = earlier
    inputs[:, -1] = 1
    at = np.zeros(inputs.shape[1])
    at[-1] = np.log(share / (1 - share))
    first, second = np.zeros_like(at), np.zeros_like(at)
    for t in range(1, ROUNDS + 1):
        off = probability(inputs @ at.astype(np.float32)) - y
        slope = (off.astype(np.float32) @ inputs).astype(np.float64) / n
        slope[:-1] += DECAY * at[:-1]
        first += 0.1 * (slope - first)
        second += 0.001 * (slope * slope - second)
        at = at - RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Model(at[:n_features], at[n_features:-1], float(at[-1]))


@dataclass
class Chain:
    """A fitted chain; small enough to travel with every task."""

    categories: list[str]
    features: list[str]
    models: list[Model]

    def score(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities and decisions, documents by categories."""
        n = len(lists)
        rows = np.repeat(np.arange(n), [len(x) for x in lists])
        cols = np.fromiter((i for x in lists for i in x), np.int64, len(rows))
        chances = np.zeros((n, 0))
        for model in self.models:
            chances = np.column_stack([chances, probability(model.margin(rows, cols, n, chances))])
        return chances, chances > THRESHOLD


def labelled_sample(
    docs: DataFrame, labels: DataFrame, categories: Mapping[str, str], id_column: str, text: str, sample: int
) -> DataFrame:
    """(doc_id, text, one 0/1 column per category) of at most ``sample`` documents, rows equal in id and text once."""
    own = labels.select(
        F.col("doc_id").alias("__id"), *[F.expr(c).cast("int").alias(name) for name, c in categories.items()]
    ).dropna()
    own = own.groupBy("__id").agg(*[F.max(name).alias(name) for name in categories])
    # An id that has no document must not use up the sample, and one with many rows counts once per text.
    keyed = docs.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__hash")
    )
    there = keyed.join(own, F.col("doc_id") == F.col("__id")).select("__id", "__hash", *categories).distinct()
    chosen = there.orderBy(F.xxhash64("__id"), "__id", "__hash").limit(sample)
    texts = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    same = (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    once = texts.join(F.broadcast(chosen), same).groupBy("__id", "__hash", *categories).agg(F.min("text").alias("text"))
    return staged(once.select(F.col("__id").alias("doc_id"), "text", *categories), "labelled")


def by_chance(n: int, held: int, positive: int, total: int) -> float:
    """Probability that of ``n`` documents drawn from ``total``, ``held`` or a less likely number are positive.

    On the side of ``held`` only: as many or more if it is over the expected number, else as many or fewer.
    """
    low, high = max(0, n + positive - total), min(n, positive)
    k = np.arange(held, high + 1) if held * total >= n * positive else np.arange(low, held + 1)
    of = np.cumsum(np.log(np.maximum(np.arange(total + 1), 1)))  # logarithms of the factorials
    every = of[total] - of[n] - of[total - n]
    ways = of[positive] - of[k] - of[positive - k] + of[total - positive] - of[n - k] - of[total - positive - n + k]
    return min(1.0, float(np.exp(ways - every).sum()))


def not_by_chance(chances: Sequence[float], tried: int) -> int:
    """How many of the ascending ``chances`` of ``tried`` grams to take (Benjamini and Hochberg)."""
    return max((k for k, p in enumerate(chances, 1) if p * tried <= CHANCE * k), default=0)


def choose_features(rows: DataFrame, names: list[str], most: int) -> list[str]:
    """The grams with the largest chi-square for any category, as far as they are not there by chance."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            n = Counter()
            of = [Counter() for _ in names]
            labels = [batch.column(name).to_pylist() for name in names]
            for i, value in enumerate(batch.column("text").to_pylist()):
                if len(known) > WORDS_KEPT:
                    known.clear()
                own: set[str] = set()
                for w in words(value):
                    hit = known.get(w)
                    if hit is None:
                        hit = known[w] = grams(w)
                    own.update(hit)
                n.update(own)
                for c, y in zip(of, labels, strict=True):
                    if y[i]:
                        c.update(own)
            columns = [pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())]
            columns += [pa.array([c[g] for g in n], pa.int64()) for c in of]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "n", *names])

    counts = staged(
        rows.select("text", *names)
        .mapInArrow(count, f"gram string, n bigint, {', '.join(f'`{x}` bigint' for x in names)}")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"), *[F.sum(x).alias(x) for x in names])
        .filter(F.col("n") >= LEAST_DOCS),
        "gram-counts",
    )
    total, *positive = rows.agg(F.count("*"), *[F.sum(x) for x in names]).first()
    tried = counts.count()

    def chi_square(name: str, p: int | None) -> Column:
        p = p or 0
        expected = F.col("n") * F.lit(p / max(total, 1))
        spread = expected * F.lit(1 - p / max(total, 1)) * (1 - F.col("n") / F.lit(max(total, 1))) + F.lit(1.0)
        return F.pow(F.col(name) - expected, F.lit(2)) / spread

    each = max(1, most // max(1, len(names)))
    found: dict[str, None] = {}
    for name, p in zip(names, positive, strict=True):
        telling = counts.withColumn("chi", chi_square(name, p))
        best = telling.orderBy(F.col("chi").desc(), "gram").limit(each).select("gram", "n", name).collect()
        ranked = sorted((by_chance(r["n"], r[name], p or 0, total), r["gram"]) for r in best)
        found.update((gram, None) for _, gram in ranked[: not_by_chance([x for x, _ in ranked], tried)])
    return list(found)


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Mapping[str, str] = CATEGORIES,
    id_column: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
) -> Chain:
    names = list(categories)
    rows = labelled_sample(docs, labels, categories, id_column, text, sample)
    features = choose_features(rows, names, FEATURES)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(features)
        for batch in batches:
            lists = [look(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("order"), *[batch.column(x) for x in names], pa.array(lists, pa.list_(pa.int32()))],
                ["order", *names, "found"],
            )

    # At most ``sample`` rows of at most FEATURES numbers come to the driver.
    got = (
        rows.select(F.xxhash64("doc_id", "text").alias("order"), "text", *names)
        .mapInArrow(look_up, f"order bigint, {', '.join(f'`{x}` int' for x in names)}, found array<int>")
        .toPandas()
        .sort_values("order", kind="stable")
    )
    n = len(got)
    sizes = got["found"].map(len).to_numpy(np.int64) if n else np.zeros(0, np.int64)
    cols = np.concatenate(got["found"].to_list()).astype(np.int64) if n else np.zeros(0, np.int64)
    row_of = np.repeat(np.arange(n), sizes)
    fold = np.arange(n) % FOLDS
    held_out, models = np.zeros((n, 0)), []
    for name in names:
        y = got[name].to_numpy(np.float64) if n else np.zeros(0)
        margins = np.zeros(n)
        for k in range(FOLDS):
            seen = fold != k
            place = np.cumsum(seen) - 1
            of_seen = seen[row_of]
            model = fit(place[row_of[of_seen]], cols[of_seen], held_out[seen], y[seen], len(features))
            margins[~seen] = model.margin(row_of, cols, n, held_out)[~seen]
        models.append(fit(row_of, cols, held_out, y, len(features)))
        held_out = np.column_stack([held_out, probability(margins)])
    return Chain(names, features, models)


def score(docs: DataFrame, chain: Chain, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, and per category its probability ``p_<name>`` and decision ``<name>``."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(chain.features)
        for batch in batches:
            chances, chosen = chain.score([look(t) for t in batch.column(1).to_pylist()])
            columns = [batch.column(0)]
            columns += [pa.array(chances[:, i]) for i in range(len(chain.categories))]
            columns += [pa.array(chosen[:, i]) for i in range(len(chain.categories))]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", *[f"p_{c}" for c in chain.categories], *chain.categories]
            )

    fields = [f"doc_id {kind}", *[f"`p_{c}` double" for c in chain.categories], *[f"`{c}` boolean" for c in chain.categories]]
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, ", ".join(fields)
    )


def reject(docs: DataFrame, chain: Chain, category: str = "toxic", text: str = "text") -> DataFrame:
    """The rows the chain does not put into ``category``, with all their columns."""
    at, place = chain.categories.index(category), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(chain.features)
        for batch in batches:
            _, chosen = chain.score([look(t) for t in batch.column(place).to_pylist()])
            yield batch.filter(pa.array(~chosen[:, at]))

    return docs.mapInArrow(run, docs.schema)
