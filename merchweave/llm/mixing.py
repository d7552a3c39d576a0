"""Mixing sources to target weights by iterative proportional fitting.

Tokens are added up per cell (source, language, topic). The cells' weights are raked: scaled to the
target of each source, then of each language, then of each topic, again and again until all three
agree. A document is kept with the probability that its cell's raked weight asks for, so that about
``keep`` of all tokens stay; cells that would need more than all they have are kept whole and the
others fill up. Whether a document is kept depends on its id's hash only, so it is the same on
every run.

A target is the value's share of the tokens raised to ``power``, below 1 in favour of the rare
ones. NULL is a value like any other. A document weighs its words and one end, so empty texts count
too. Rows with one id share their fate if they share a cell. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.llm.common import aside, hash_bits, n_words
from merchweave.session import staged

POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
MARKS = ("__topic", "__tokens", "__probability", "__kept")
KEEP = 0.7
SWEEPS_A_JOB = 4
MAX_JOBS = 12
TOLERANCE = 1e-9

LEGAL = "licen[cs]e|copyright"
CONTACT = "[a-z0-9.]@[a-z0-9]"


def topic(text: str) -> Column:
    """A coarse topic from marks in the text and its length in words."""
    lower, words = F.lower(F.coalesce(F.col(text), F.lit(""))), n_words(text)
    return (
        F.when(lower.rlike(LEGAL), "legal")
        .when(lower.rlike(CONTACT), "contact")
        .when(words < 100, "note")
        .when(words < 1000, "article")
        .otherwise("book")
    )


def rake(cells: DataFrame, powers: Mapping[str, float]) -> DataFrame:
    """Cells (the columns of ``powers``, tokens) with their raked weight; the weights add up to the tokens."""
    total = cells.agg(F.sum("tokens")).first()[0]
    targets = cells
    for dim, power in powers.items():
        of_value = F.sum("tokens").over(W.partitionBy(dim))
        targets = targets.withColumn(f"share_{dim}", F.pow(of_value / F.lit(total or 1), F.lit(power)))
    for dim in powers:
        # Each value's share once, not once per cell.
        sums = targets.groupBy(dim).agg(F.first(f"share_{dim}").alias("s")).agg(F.sum("s")).first()[0]
        targets = targets.withColumn(f"target_{dim}", F.col(f"share_{dim}") * F.lit(total or 1) / F.lit(sums or 1.0))
    state = staged(targets.withColumn("weight", F.col("tokens").cast("double")), "rake")
    for _ in range(MAX_JOBS):
        for _ in range(SWEEPS_A_JOB):
            for dim in powers:
                now = F.sum("weight").over(W.partitionBy(dim))
                state = state.withColumn("weight", F.col("weight") * F.col(f"target_{dim}") / now)
        state = staged(state, "rake")
        off = [
            F.max(F.abs(F.col(f"now_{dim}") / F.col(f"target_{dim}") - 1)).alias(f"off_{dim}") for dim in powers
        ]
        worst = state.withColumns({f"now_{dim}": F.sum("weight").over(W.partitionBy(dim)) for dim in powers}).agg(*off)
        if max(x or 0.0 for x in worst.first()) <= TOLERANCE:
            break
    return state.select(*powers, "tokens", "weight")


def probabilities(raked: DataFrame, keep: float) -> DataFrame:
    """Add probability, weight / tokens times one factor and 1 at most, for ``keep`` of the tokens in all."""
    ratio = F.col("weight") / F.col("tokens")
    total = raked.agg(F.sum("tokens")).first()[0] or 0
    factor, full = float(keep), -1
    while True:
        capped = ratio * F.lit(factor) >= 1
        n, held, free = raked.agg(
            F.count(F.when(capped, 1)), F.sum(F.when(capped, F.col("tokens"))), F.sum(F.when(~capped, F.col("weight")))
        ).first()
        if n == full or not free:
            break
        full, factor = n, (keep * total - (held or 0)) / free
    return raked.withColumn("probability", F.least(F.lit(1.0), ratio * F.lit(factor)))


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    powers: Mapping[str, float] = POWERS,
    keep: float = KEEP,
    topics: Column | None = None,
) -> DataFrame:
    """Add the columns ``MARKS`` to every row of ``docs``; its own columns of these names are replaced."""
    return _mixed(_marked(docs, text, topics), id_column, powers, keep)


def judge(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    powers: Mapping[str, float] = POWERS,
    keep: float = KEEP,
    topics: Column | None = None,
) -> DataFrame:
    """What ``mix`` gives without the texts, each of which is read once: its marks are written and used for both steps."""
    return _mixed(staged(_marked(docs, text, topics).drop(text), "marks"), id_column, powers, keep)


def _marked(docs: DataFrame, text: str, topics: Column | None) -> DataFrame:
    return docs.withColumns({"__topic": topics if topics is not None else topic(text), "__tokens": n_words(text) + 1})


def _mixed(marked: DataFrame, id_column: str, powers: Mapping[str, float], keep: float) -> DataFrame:
    names = {dim: "__topic" if dim == "topic" else dim for dim in powers}
    cells = staged(
        marked.groupBy(*[F.col(c).alias(dim) for dim, c in names.items()]).agg(F.sum("__tokens").alias("tokens")), "cells"
    )
    found = staged(probabilities(rake(cells, powers), keep), "mix").select(
        *[F.col(dim).alias(f"__cell_{dim}") for dim in powers], F.col("probability").alias("__probability")
    )
    same = F.lit(True)
    for dim, c in names.items():
        same = same & F.col(c).eqNullSafe(F.col(f"__cell_{dim}"))
    uniform = hash_bits(F.concat(F.lit("mix:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 13) / F.lit(
        float(16**13)
    )
    return (
        marked.join(found, same)
        .withColumn("__kept", uniform < F.col("__probability"))
        .drop(*[f"__cell_{dim}" for dim in powers])
    )


def sample(docs: DataFrame, **options) -> DataFrame:
    """The documents kept by ``mix``, with the columns they came with, whatever their names."""
    plain, back = aside(docs, (*MARKS, *[f"__cell_{dim}" for dim in options.get("powers", POWERS)]))
    kept = mix(plain, **options).filter("__kept").select(*[F.col(f"`{c}`") for c in plain.columns])
    return kept.withColumnsRenamed(back)
