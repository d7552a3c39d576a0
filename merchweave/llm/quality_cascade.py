"""Quality rules as a short-circuit cascade.

A rule says of one text whether it is rejected. A text is kept if no rule rejects it, so the order of
the rules changes the work and never the verdict. ``plan`` times every rule on a sample of at most
``SAMPLE`` documents, notes which of them it rejects, and puts first the rule that rejects most per
second; the next are chosen on what the earlier ones left, so rules that reject the same texts do not
both come early. ``keep`` and ``verdicts`` then stop at the first rule that rejects.

``measures`` gives counts of every text beside the verdict. What a rule needs is computed when first
asked for and shared with the rules after it.

Words are what ASCII white space separates, lines what line feeds separate; only lines with a word
count. Whole texts are read; nothing is shuffled. NULL and empty texts have no words and fall to the rule
on few words. Ids may be NULL or repeat, every row is judged by its own text. Empty tables give empty
results. ``keep`` returns the rows untouched, whatever their columns are called; ``verdicts`` and
``measures`` return the id and columns of their own only.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 2000  # documents on which costs and rejections are measured
WINDOW = 8  # words
SYMBOLS = b"#*$%&|<>"
BULLETS = tuple(c.encode() for c in "-*•‣▪●○")
ELLIPSES = (b"...", "…".encode())

_SPACE = b" \t\n\x0b\x0c\r"
# Bytes of letters and of everything beyond ASCII stay, white space stays, all others go.
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_NEITHER = bytes(sorted(set(range(256)) - set(_LETTERS) - set(_SPACE)))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Text:
    """One text in UTF-8 and what rules ask of it."""

    def __init__(self, data: bytes | None):
        self.data = data or b""

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()  # of bytes: at ASCII white space only

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.data.split(b"\n") if line.strip()]

    @cached_property
    def _bytes(self) -> np.ndarray:
        return np.bincount(np.frombuffer(self.data, np.uint8), minlength=256)

    def n_bytes(self, of: bytes) -> int:
        return int(self._bytes[np.frombuffer(of, np.uint8)].sum())

    @cached_property
    def word_chars(self) -> int:
        """Code points in words: no white space, and every code point has one byte that is no continuation."""
        return len(self.data) - int(self._bytes[0x80:0xC0].sum()) - self.n_bytes(_SPACE)

    @cached_property
    def n_symbols(self) -> int:
        return self.n_bytes(SYMBOLS)

    @cached_property
    def n_capitals(self) -> int:
        return int(self._bytes[65:91].sum())

    @cached_property
    def n_latin(self) -> int:
        return int(self._bytes[65:91].sum() + self._bytes[97:123].sum())

    @cached_property
    def n_lettered(self) -> int:
        """Words with a letter A-Z, a-z or any character beyond ASCII."""
        return len(self.data.translate(None, _NEITHER).split())

    @cached_property
    def n_stutters(self) -> int:
        """Words equal to the word before them."""
        return sum(map(eq, self.words, self.words[1:]))

    @cached_property
    def n_dup_lines(self) -> int:
        """Lines equal to an earlier line."""
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_bullets(self) -> int:
        return sum(line.lstrip().startswith(BULLETS) for line in self.lines)

    @cached_property
    def n_ellipses(self) -> int:
        return sum(line.rstrip().endswith(ELLIPSES) for line in self.lines)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of ``WINDOW`` words that the text has twice or more, the first of them included."""
        words, n = self.words, self.n_words - WINDOW + 1
        if n < 2:
            return 0
        known = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        rolled = known[:n].copy()
        for k in range(1, WINDOW):
            rolled = rolled * _MIX + known[k : k + n]
        ordered = np.sort(rolled)
        repeated = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(repeated):
            return 0
        # Equal hashes may still be different windows: the words decide.
        places = np.flatnonzero(np.isin(rolled, repeated)).tolist()
        windows = [tuple(words[i : i + WINDOW]) for i in places]
        found = Counter(windows)
        inside = np.zeros(len(words) + 1, np.int64)
        starts = np.asarray([i for i, w in zip(places, windows, strict=True) if found[w] > 1], np.int64)
        np.add.at(inside, starts, 1)
        np.add.at(inside, starts + WINDOW, -1)
        return int((np.cumsum(inside) > 0).sum())


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true of the texts that go."""

    name: str
    rejects: Callable[[Text], bool]


FEW_WORDS = Rule("few_words", lambda t: t.n_words < 20)
REPEATED_WORDS = Rule("repeated_words", lambda t: 100 * t.n_repeat_words > 30 * t.n_words)
BASE = [FEW_WORDS, REPEATED_WORDS]
# The other rules compare two counts of a text, so long texts are not judged by their length. The limits are
# the usual ones of published web corpora, wider where short clean texts with one repeated line fall under them.
RULES = [
    *BASE,
    Rule("word_length", lambda t: not 3 * t.n_words <= t.word_chars <= 10 * t.n_words),
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("letters", lambda t: 10 * t.n_lettered < 8 * t.n_words),
    Rule("capitals", lambda t: 2 * t.n_capitals > t.n_latin),
    Rule("stutters", lambda t: 10 * t.n_stutters > 3 * t.n_words),
    Rule("repeated_lines", lambda t: 2 * t.n_dup_lines > len(t.lines)),
    Rule("bullets", lambda t: 10 * t.n_bullets > 9 * len(t.lines)),
    Rule("ellipses", lambda t: 10 * t.n_ellipses > 3 * len(t.lines)),
]


def trial(docs: DataFrame, rules: Sequence[Rule], text: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """(seconds, rejected), each documents x rules, for a sample of at most ``sample`` documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seconds, rejected = [], []
            for data in batch.column(0).to_pylist():
                times, verdict = [], []
                for rule in rules:
                    alone = Text(data)  # a rule pays for all that it needs
                    began = time.perf_counter()
                    verdict.append(bool(rule.rejects(alone)))
                    times.append(time.perf_counter() - began)
                seconds.append(times)
                rejected.append(verdict)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seconds, pa.list_(pa.float64())), pa.array(rejected, pa.list_(pa.bool_()))],
                ["seconds", "rejected"],
            )

    texts = docs.select(F.col(text).cast("binary").alias("text"))
    n = texts.count()
    if n > sample:  # a tenth more than needed, so that the limit is what decides
        texts = texts.sample(min(1.0, 1.1 * sample / n), seed=7).limit(sample)
    rows = texts.mapInArrow(run, "seconds array<double>, rejected array<boolean>").collect()
    shape = (len(rows), len(rules))
    return (
        np.asarray([r.seconds for r in rows], float).reshape(shape),
        np.asarray([r.rejected for r in rows], bool).reshape(shape),
    )


def order(rules: Sequence[Rule], seconds: np.ndarray, rejected: np.ndarray) -> list[Rule]:
    """Always the rule next that rejects most of what is left per second of its cost there."""
    left, out, todo = np.ones(len(seconds), bool), [], list(range(len(rules)))
    while todo:
        gone, cost = rejected[left][:, todo].sum(axis=0), seconds[left][:, todo].sum(axis=0)
        # Among rules that reject nothing the cheap ones first.
        best = max(range(len(todo)), key=lambda i: (gone[i] / max(cost[i], 1e-9), -cost[i]))
        chosen = todo.pop(best)
        out.append(rules[chosen])
        left &= ~rejected[:, chosen]
    return out


def plan(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample: int = SAMPLE) -> list[Rule]:
    """The rules in the order in which they are cheapest to apply."""
    return order(rules, *trial(docs, rules, text, sample))


def first_rejection(t: Text, rules: Sequence[Rule]) -> str | None:
    return next((rule.name for rule in rules if rule.rejects(t)), None)


def keep(docs: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """The rows no rule rejects, with all their columns."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([first_rejection(Text(t), rules) is None for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def verdicts(docs: DataFrame, rules: Sequence[Rule], id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, rejected_by): the first rule in the given order that rejects the text, NULL if none does."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [first_rejection(Text(t), rules) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "rejected_by"])

    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {kind}, rejected_by string"
    )


def measures(docs: DataFrame, rules: Sequence[Rule], id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of every text, whether the base rules reject it, and whether all rules keep it."""
    kind = docs.schema[id_column].dataType.simpleString()
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(len(counts) + 2)]
            for data in batch.column(1).to_pylist():
                t = Text(data)
                failed = first_rejection(t, BASE) is not None
                kept = not failed and first_rejection(t, rules) is None
                for column, value in zip(columns, [*(getattr(t, c) for c in counts), failed, kept], strict=True):
                    column.append(value)
            arrays = [pa.array(c, pa.int64()) for c in columns[: len(counts)]]
            arrays += [pa.array(c, pa.bool_()) for c in columns[len(counts) :]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *counts, "base_failed", "kept"])

    schema = f"doc_id {kind}, {', '.join(f'{c} long' for c in counts)}, base_failed boolean, kept boolean"
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(run, schema)
