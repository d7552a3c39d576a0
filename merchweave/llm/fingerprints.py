"""Document fingerprints of closed syncmers.

A text's units are cut into windows of ``WINDOW`` units. The hashes of the pairs of neighbouring units
inside a window order its inner substrings; the window is chosen if the smallest of them stands at
its start or its end. Whether a window is chosen depends on its own units only, so what two texts
share is chosen in both, wherever it stands; of nine units in a row, at least one window is chosen. The
set of the chosen windows' hashes (62 bits and the kind) is the fingerprint, and the likeness of two
fingerprints is the Jaccard index of their sets. The chosen windows of words can also be had with their positions (``anchors``);
the likeness does not look at positions.

What a unit is follows the length of the text, with runs of white space as one blank. Up to ``2 * TINY`` code points
all runs of three code points count; from ``TINY`` up to ``2 * SHORT`` there are windows of code points; from
``SHORT`` on there are windows of words, with words longer than ``LONG_WORD`` taken as single code points (scripts
without blanks, encoded text). The ranges overlap, so a text of half to twice another's length has a kind of
unit in common with it. The last two bits of a hash name its kind, and two
fingerprints are compared in the kinds that both have; without one their likeness is 0. A fingerprint thus follows
from its text alone, and a likeness from two fingerprints alone. Words are what ASCII white space separates; a run of it
counts as one blank, at the ends as nothing. A text without any window has its whole text's hash, a kind
of its own. NULL counts as empty.

The next document is the next one in ascending id; of rows that share an id the order is that of the
text's hash, NULL ids come first, the last row is followed by the first. Ids are numbers. Rows are dealt
into slices of the id range by quantiles of the ids, and each slice also gets the first row of the one
that follows. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.llm.common import let, partitions

WINDOW = 6  # units
PAIRS = WINDOW - 1  # inner substrings of two units in a window
TINY, SHORT = 48, 256  # code points
LONG_WORD = 16  # code points
SLICES_A_PARTITION = 4

_SPACE = r"' \t\n\u000b\f\r'"


def _chosen(size: str = "size(g)") -> str:
    """SQL text: the positions of the chosen windows, given the pairs' hashes ``g``."""
    first = " AND ".join(f"g[i] <= g[i + {j}]" for j in range(1, PAIRS))
    last = " AND ".join(f"g[i + {PAIRS - 1}] <= g[i + {j}]" for j in reversed(range(PAIRS - 1)))
    return f"filter(sequence(0, {size} - {PAIRS}), i -> ({first}) OR ({last}))"


def _plain(text: str) -> str:
    return rf"regexp_replace(btrim(coalesce({text}, ''), {_SPACE}), '[\\x20\\x09-\\x0D]+', ' ')"


def _with_pairs(units: str, body: str, otherwise: str) -> str:
    pairs = "transform(sequence(0, size(w) - 2), j -> hash(w[j], w[j + 1]))"
    return let(units, "w", f"if(size(w) < {WINDOW}, {otherwise}, {let(pairs, 'g', body)})")


_HASH = "xxhash64(" + ", ".join(f"g[i + {j}]" for j in dict.fromkeys([*range(0, PAIRS, 2), PAIRS - 1])) + ")"


def anchors(text: str) -> Column:
    """Array of (position in words, hash) of the chosen windows of words, in order."""
    body = f"transform({_chosen()}, i -> named_struct('position', i, 'hash', {_HASH}))"
    empty = "cast(array() AS array<struct<position: int, hash: bigint>>)"
    return F.expr(_with_pairs(f"split({_plain(text)}, ' ')", body, empty))


def _of_kind(kind: int, hashes: str) -> str:
    return f"transform({hashes}, h -> (h & -4L) | {kind}L)"


def fingerprint(text: str) -> Column:
    """Sorted array of the distinct hashes of the kinds that the text's length asks for."""
    none = "cast(array() AS array<bigint>)"
    runs = "transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))"
    tiny = let("split(p, '')", "w", f"if(size(w) < 3, {none}, {runs})")
    windows = f"transform({_chosen()}, i -> {_HASH})"
    cut = f"flatten(transform(v, x -> if(char_length(x) > {LONG_WORD}, split(x, ''), array(x))))"
    words = let("split(p, ' ')", "v", f"if(exists(v, x -> char_length(x) > {LONG_WORD}), {cut}, v)")
    points_of, words_of = (_of_kind(k, _with_pairs(u, windows, none)) for k, u in ((1, "split(p, '')"), (2, words)))
    found = let(
        "char_length(p)",
        "n",
        f"concat(if(n <= {2 * TINY}, {_of_kind(0, tiny)}, {none}), "
        f"if(n >= {TINY} AND n <= {2 * SHORT}, {points_of}, {none}), "
        f"if(n >= {SHORT}, {words_of}, {none}))",
    )
    chosen = let(found, "f", "if(size(f) = 0, array(xxhash64(p) | 3L), sort_array(array_distinct(f)))")
    return F.expr(let(_plain(text), "p", chosen))


def likeness(a: str, b: str) -> Column:
    """Jaccard index of the hashes in the kinds that both fingerprints have."""
    jaccard = let("size(array_intersect(x, y))", "n", "n / cast(size(x) + size(y) - n AS double)")
    kinds = "array_distinct(transform({}, h -> h & 3L))"
    shared = "filter({}, h -> array_contains(k, h & 3L))"
    common = let(shared.format(a), "x", let(shared.format(b), "y", jaccard))
    return F.expr(let(f"array_intersect({kinds.format(a)}, {kinds.format(b)})", "k", f"if(size(k) = 0, 0D, {common})"))


def as_text(fingerprint: str) -> Column:
    """Sixteen hex digits per hash."""
    return F.expr(f"lower(array_join(transform({fingerprint}, v -> lpad(hex(v), 16, '0')), ''))")


def _slice(column: str, bounds: list[float]) -> Column:
    """How many bounds are not above the value: first among groups of bounds, then within the group."""
    if not bounds:
        return F.lit(0)
    size = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + size] for i in range(0, len(bounds), size)]
    heads = ", ".join(f"{g[0]!r}D" for g in groups)
    within = ", ".join(f"array({', '.join(f'{b!r}D' for b in g)})" for g in groups)
    value = f"cast({column} AS double)"
    group = f"size(filter(array({heads}), b -> b <= {value}))"
    inside = f"size(filter(element_at(array({within}), k), b -> b <= {value}))"
    return F.coalesce(F.expr(let(group, "k", f"if(k = 0, 0, (k - 1) * {size} + {inside})")), F.lit(0))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with fingerprint ``f``, next_text and next_f."""
    spark = docs.sparkSession
    n = partitions(spark)
    slices = SLICES_A_PARTITION * n
    bounds = sorted(set(docs.approxQuantile("doc_id", [i / slices for i in range(1, slices)], 0.2 / slices)))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"slice": _slice("doc_id", bounds), "h": F.xxhash64("text"), "ahead": F.lit(False)})
    # One row per slice, as many as the bounds above.
    firsts = rows.groupBy("slice").agg(F.min(F.struct("doc_id", "h")).alias("first")).orderBy("slice").collect()
    heads = [
        (firsts[i - 1]["slice"], r["first"]["doc_id"], r["first"]["h"]) for i, r in enumerate(firsts)
    ]
    kind = docs.schema["doc_id"].dataType.simpleString()
    head = spark.createDataFrame(heads, f"slice int, head_id {kind}, head_h bigint")
    follows = (
        rows.drop("slice", "ahead")
        .join(F.broadcast(head), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h")))
        .dropDuplicates(["slice"])
        .select("doc_id", "text", "slice", "h", F.lit(True).alias("ahead"))
    )
    dealt = rows.unionByName(follows).repartition(n, "slice").withColumn("f", fingerprint("text"))
    order = W.partitionBy("slice").orderBy("ahead", F.col("doc_id").asc_nulls_first(), "h")
    return (
        dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in ("text", "f")})
        .filter("not ahead")
        .select("doc_id", "text", "f", "next_text", "next_f")
    )


def edited(docs: DataFrame) -> DataFrame:
    """Every document beside its edited text, whose last half is the beginning of the next document."""
    half = "(char_length(text) div 2)"
    changed = F.expr(f"concat(left(text, char_length(text) - {half}), left(next_text, cast({half} AS int)))")
    return (
        with_next(docs)
        .withColumn("edited", changed)
        .withColumn("edited_f", fingerprint("edited"))
        .withColumns({"near_edited": likeness("f", "edited_f"), "near_next": likeness("f", "next_f")})
    )
