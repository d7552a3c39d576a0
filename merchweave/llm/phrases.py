"""Phrase collocations, counted by broadcast double-array tries.

Texts become blocks once: of one language, up to ``BLOCK`` word numbers in a row with a zero wherever a
piece of text ends, and the block's own words. Everything after reads blocks with numpy.

*Candidates* are found length by length. A phrase can only be frequent if both parts one word shorter may be
(Apriori) and if the occurrences of all phrases with its hash together reach the least count. The hashes are
summed over the blocks as plain numbers; those that reach the count go into a bitmap of bounded size, by which
the next length knows its parts. Where hashes or bitmap positions meet, there is a candidate too many, never
one too few.

The candidates of all lengths, at most ``MOST`` at a time, go into a double-array trie that is broadcast. Each
task starts all positions of a block at the root and moves them all by one word at a time; whoever has no
such edge is out. Accepting states are counted by bincount and the blocks' counts are summed. These counts decide.

A candidate's score is that of its weakest cut in two. A candidate inside a longer one that occurs as
often is dropped. Counts are multiplied as decimals of 38 digits.

A-Z are lower-cased; pieces end at ``.,;:!?`` and at line breaks (``\\x0A-\\x0D``); words are separated by blanks
and tabs. Languages are kept apart, NULL counts as ``und``. NULL and empty texts have no words. Ids play no part,
so rows may repeat and ids may be NULL; every row counts. Other columns are not looked at, whatever their names. Empty
tables give empty results. The longest text has to fit into a task's memory.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.llm.common import BATCH, arrow_rows
from merchweave.session import staged

LEAST = 100  # occurrences
LONGEST = 5  # words
SHARE = 100  # per cent of its occurrences that a longer phrase takes from a dropped one
TOP = 2000  # phrases reported of each language
BLOCK = 1 << 19  # symbols of a block
MOST = 500_000  # candidates in one trie
BLOCKS = 8  # that go to a Python worker at a time
MAX_BITS = 27  # of positions in a bitmap: 16 MB at any size of the corpus
HASH_BITS = 40  # of a phrase hash that is summed over the corpus
BITMAP = 32_768  # positions in one bitmap of bitmap_construct_agg

_MIX = np.uint64(0x9E3779B97F4A7C15)
_PIECES = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", b"......... ")


class Numbers(dict):
    """Words to numbers from 1 in order of arrival; the mark between pieces is 0."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def tokens(text: bytes) -> list[bytes]:
    """The words, and b"." wherever a piece ends."""
    out = text.lower().translate(_PIECES).replace(b".", b" . ").split()
    out.append(b".")
    return out


def blocks(docs: DataFrame, lang: str = "lang", text: str = "text", size: int = BLOCK) -> DataFrame:
    """(lang, n_words, words, symbols): ``symbols`` are 32-bit numbers of the words, which are joined by blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, tuple[Numbers, list[np.ndarray]]] = {}
        held: dict[str, int] = {}

        def close(of: str) -> pa.RecordBatch:
            numbers, parts = open_.pop(of)
            held.pop(of)
            symbols = np.concatenate(parts)
            words = b" ".join(list(numbers)[1:])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([of], pa.string()),
                    pa.array([int((symbols > 0).sum())], pa.int64()),
                    pa.array([words], pa.binary()),
                    pa.array([symbols.tobytes()], pa.binary()),
                ],
                ["lang", "n_words", "words", "symbols"],
            )

        for batch in batches:
            for of, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = tokens(value or b"")
                if len(found) == 1:
                    continue
                numbers, parts = open_.setdefault(of, (Numbers(), []))
                parts.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                held[of] = held.get(of, 0) + len(found)
                while sum(held.values()) > size:  # the languages of a task share its memory
                    yield close(max(held, key=held.get))
        for of in list(open_):
            yield close(of)

    return docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text")
    ).mapInArrow(run, "lang string, n_words long, words binary, symbols binary")


def encoded(docs: DataFrame, lang: str = "lang", text: str = "text", size: int = BLOCK) -> DataFrame:
    """The blocks, written once. Parquet would put a hundred of these long rows into one page; here a page takes few."""
    return staged(blocks(docs, lang, text, size), "phrase-blocks", **{"parquet.page.size.row.check.min": "1"})


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    for of, words, symbols in zip(*(batch.column(c) for c in ("lang", "words", "symbols")), strict=True):
        yield of.as_py(), words.as_py().split(b" "), np.frombuffer(symbols.as_py(), np.int32)


Bitmap = tuple[np.ndarray, int]  # bytes, and how many bits of a hash give a place


def holds(bitmap: Bitmap, hashes: np.ndarray) -> np.ndarray:
    """Whether the bitmap has both places of a hash: its first and its last bits."""
    found, bits = bitmap
    out = np.ones(len(hashes), bool)
    for place in (hashes >> np.uint64(HASH_BITS - bits), hashes & np.uint64((1 << bits) - 1)):
        out &= (found[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return out


def possible(
    of: str, words: list[bytes], symbols: np.ndarray, length: int, parts: Bitmap | None
) -> tuple[np.ndarray, np.ndarray]:
    """Where phrases of ``length`` words start that have both parts in the bitmap, and their hashes."""
    # Number 0 stands for no word.
    known = np.fromiter((0, *map(xxhash.xxh3_64_intdigest, words)), np.uint64, len(words) + 1)
    start = np.uint64(xxhash.xxh3_64_intdigest(of.encode()) * int(_MIX) & 0xFFFFFFFFFFFFFFFF)

    def rolled(places: np.ndarray | slice, n: int) -> np.ndarray:
        """Hashes of the ``n`` words at these places, ``HASH_BITS`` long."""
        out = start + known[symbols[places]]
        for k in range(1, n):
            shifted = slice(k, len(symbols) - n + 1 + k) if isinstance(places, slice) else places + k
            out = out * _MIX + known[symbols[shifted]]
        return out >> np.uint64(64 - HASH_BITS)

    if length == 1:
        starts = np.flatnonzero(symbols)
    elif len(symbols) < length:
        starts = np.zeros(0, np.int64)
    else:
        good = holds(parts, rolled(slice(0, len(symbols) - length + 2), length - 1))
        gaps = np.concatenate([[0], np.cumsum(symbols == 0)])
        good &= gaps[length - 1 :] == gaps[: len(good)]
        starts = np.flatnonzero(good[:-1] & good[1:])
    return starts, rolled(starts, length)


def gathered(corpus: DataFrame) -> DataFrame:
    """The blocks in two tasks a core at most: what a task adds up in memory is sent once from each."""
    return corpus.coalesce(2 * corpus.sparkSession.sparkContext.defaultParallelism)


def hash_sums(corpus: DataFrame, length: int, parts: Bitmap | None) -> DataFrame:
    """(hash, n): how often all phrases of a hash occur that have both parts in the bitmap."""
    shared = corpus.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _unpacked(batch):
                hashes, n = np.unique(possible(*block, length, shared.value)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "n"])

    return corpus.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def observed(corpus: DataFrame, length: int, parts: Bitmap | None, own: Bitmap) -> DataFrame:
    """(lang, phrase) with the phrase's hash in the bitmap ``own`` and both its parts in ``parts``."""
    shared = corpus.sparkSession.sparkContext.broadcast((parts, own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, own = shared.value
        sent: dict[str, set[bytes]] = {}
        for batch in batches:
            for of, words, symbols in _unpacked(batch):
                starts, hashes = possible(of, words, symbols, length, parts)
                starts = starts[holds(own, hashes)]
                # Whole phrases as one number each: never more than block size times number of words.
                code = symbols[starts].astype(np.int64)
                for k in range(1, length):
                    if k > 1:
                        code = np.unique(code, return_inverse=True)[1]
                    code = code * (len(words) + 1) + symbols[starts + k]
                first = starts[np.unique(code, return_index=True)[1]]
                phrase = [symbols[first + k].tolist() for k in range(length)]
                known = sent.setdefault(of, set())
                fresh = {b" ".join([words[w - 1] for w in row]) for row in zip(*phrase, strict=True)} - known
                known |= fresh
                yield pa.RecordBatch.from_arrays(
                    [pa.array([of] * len(fresh), pa.string()), pa.array(list(fresh), pa.string())], ["lang", "phrase"]
                )

    return gathered(corpus).mapInArrow(run, "lang string, phrase string").distinct()


class Trie:
    """A double-array trie of rows of codes from 1, short rows being filled up with 0.

    The child of state ``s`` over code ``c`` is ``base[s] + c``, if ``check`` there says that its parent is ``s``.
    ``accept`` gives the row that ends in a state, counted from 1, or 0.
    """

    def __init__(self, rows: np.ndarray):
        order = np.lexsort(rows.T[::-1])
        rows = rows[order]
        n, length = rows.shape
        self.top = int(rows.max()) if n else 0
        # No child lies at a code's own number, so that states without children lead nowhere.
        self.hint = self.top + 1
        self.base, self.check = np.zeros(0, np.int32), np.full(0, -1, np.int32)
        self._room(2 * self.top + 2)
        state, ends = np.zeros(n, np.int64), (rows > 0).sum(axis=1)
        for depth in range(length):
            own = np.flatnonzero(ends > depth)
            new = np.ones(len(own), bool)
            new[1:] = (rows[own[1:], : depth + 1] != rows[own[:-1], : depth + 1]).any(axis=1)
            parents, codes = state[own][new], rows[own, depth][new].astype(np.int64)
            self._children(parents, codes)
            state[own] = (self.base[parents] + codes)[np.cumsum(new) - 1]
        self.accept = np.zeros(len(self.check), np.int32)
        self.accept[state] = order + 1

    def _room(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])

    def _children(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """Place the children of one level; those of a parent stand together and in ascending order."""
        starts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]])) if len(parents) else np.zeros(0, int)
        sizes = np.diff(np.append(starts, len(parents)))
        for i in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())].tolist():
            own = codes[starts[i] : starts[i] + sizes[i]]
            at = self._fit(own - own[0])
            self.base[parents[starts[i]]] = at - own[0]
            self.check[at + own - own[0]] = parents[starts[i]]
        # Single children fill the gaps, one after the other.
        single = starts[sizes == 1]
        self._room(self.hint + len(single) + int((self.check >= 0).sum()) + 2 * self.top + 2)
        gaps = np.flatnonzero(self.check[self.hint :] < 0)[: len(single)] + self.hint
        self.base[parents[single]] = gaps - codes[single]
        self.check[gaps] = parents[single]
        self._room(int(self.base.max()) + self.top + 1)

    def _fit(self, offsets: np.ndarray) -> int:
        """The first place where all children find a free slot."""
        at, width = self.hint, 4096
        while True:
            self._room(at + width + self.top + 1)
            free = np.flatnonzero(self.check[at : at + width] < 0)
            if at == self.hint and len(free) < width // 20:
                self.hint += width  # nearly full: later nodes start behind
            tried = free[: max(1, (1 << 16) // len(offsets))] + at
            fits = (self.check[tried[:, None] + offsets] < 0).all(axis=1)
            if fits.any():
                return int(tried[fits.argmax()])
            at += width

    def advance(self, state: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which states have a child over their code, and these children."""
        child = self.base[state] + codes
        moved = self.check[child] == state
        return moved, child[moved]


def trie_counts(corpus: DataFrame, candidates: DataFrame) -> DataFrame:
    """(cid, a): how often each of at most ``MOST`` candidates (cid, lang, phrase) occurs."""
    rows = candidates.select("cid", "lang", "phrase").toPandas()
    words = " ".join(rows.phrase).encode().split(b" ") if len(rows) else []
    ends = np.asarray([p.count(" ") + 1 for p in rows.phrase], np.int64)
    longest = int(ends.max()) if len(rows) else 0
    # Frequent words get small numbers, which packs nodes closely. A tab tells languages from words.
    marks = [b"\t" + of.encode() for of in rows.lang]
    found = Counter(marks) + Counter(words)
    codes = {w: i + 1 for i, (w, _) in enumerate(found.most_common())}
    matrix = np.zeros((len(rows), longest + 1), np.int32)
    matrix[:, 0] = [codes[m] for m in marks]
    place = np.arange(len(words)) - np.repeat(np.cumsum(ends) - ends, ends)
    matrix[np.repeat(np.arange(len(rows)), ends), place + 1] = [codes[w] for w in words]
    shared = corpus.sparkSession.sparkContext.broadcast((Trie(matrix), codes, rows.cid.to_numpy(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, codes, cids = shared.value
        n = np.zeros(len(cids) + 1, np.int64)
        for batch in batches:
            for of, words, symbols in _unpacked(batch):
                root = codes.get(b"\t" + of.encode())
                if root is None:
                    continue
                code = np.fromiter((0, *(codes.get(w, 0) for w in words)), np.int32, len(words) + 1)[symbols]
                code = np.concatenate([code, np.zeros(longest, np.int32)])
                place = np.flatnonzero(code)
                state = np.full(len(place), trie.base[0] + root, np.int32)
                for k in range(longest):
                    moved, state = trie.advance(state, code[place + k])
                    place = place[moved]
                    n += np.bincount(trie.accept[state], minlength=len(n))
        hit = np.flatnonzero(n[1:])
        yield pa.RecordBatch.from_arrays([pa.array(cids[hit]), pa.array(n[1:][hit])], ["cid", "n"])

    return gathered(corpus).mapInArrow(run, "cid long, n long").groupBy("cid").agg(F.sum("n").alias("a"))


def counted(corpus: DataFrame, candidates: DataFrame, least: int, most: int = MOST) -> DataFrame:
    """(lang, phrase, a) of the candidates that reach the least count. Each trie is one pass over the blocks."""
    named = staged(candidates.withColumn("cid", F.monotonically_increasing_id()), "phrase-candidates")
    shards = max(1, math.ceil(named.count() / most))
    # A quarter more shards than needed, as they are dealt by hash and not filled to the brim.
    shards = math.ceil(1.25 * shards) if shards > 1 else 1
    dealt = named.withColumn("shard", F.pmod(F.xxhash64("lang", "phrase"), F.lit(shards)))
    parts = []
    for i in range(shards):
        own = dealt.filter(F.col("shard") == i)
        sums = trie_counts(corpus, own).filter(F.col("a") >= least)
        parts.append(staged(own.join(sums, "cid").select("lang", "phrase", "a"), "phrase-counts"))
    return reduce(DataFrame.unionByName, parts)


def bitmap_of(hashes: DataFrame, n: int) -> Bitmap:
    bits = min(MAX_BITS, max(15, (64 * n).bit_length()))
    places = F.array(F.expr(f"shiftrightunsigned(hash, {HASH_BITS - bits})"), F.expr(f"hash & {(1 << bits) - 1}L"))
    rows = (
        hashes.select(F.explode(places).alias("p"))
        .groupBy(F.expr(f"p div {BITMAP}").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("p") % BITMAP).alias("bitmap"))
        .collect()  # at most 2**(MAX_BITS - 15) rows of 4 KB
    )
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:
        out[r.bucket * BITMAP // 8 : (r.bucket + 1) * BITMAP // 8] = np.frombuffer(r.bitmap, np.uint8)
    return out, bits


def candidates(corpus: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame | None:
    """(lang, phrase): all phrases that may occur ``least`` times, and a few more."""
    out, parts = [], None
    for length in range(1, longest + 1):
        sums = staged(hash_sums(corpus, length, parts).filter(F.col("n") >= least), "phrase-hashes")
        n = sums.count()
        if not n:
            break
        own = bitmap_of(sums, n)
        out.append(staged(observed(corpus, length, parts, own), "phrases"))
        parts = own
    return reduce(DataFrame.unionByName, out) if out else None


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words and more, at their weakest cut."""
    every = phrases.select("lang", "phrase", "a")
    words = F.split("phrase", " ")
    long = every.filter(F.size(words) > 1)
    cuts = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(words) - 1))).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("k") + 1, F.size(words)), " ").alias("right"),
    )
    first = every.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    rest = every.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(n as decimal(17,0))) div "
                   "(cast(l as decimal(17,0)) * cast(r as decimal(17,0)))")
    weakest = (
        cuts.join(first, ["lang", "left"])
        .join(rest, ["lang", "right"])
        .join(totals, "lang")
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    )
    return weakest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def swallowed(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, within): the count of the most frequent longer phrase that holds the phrase."""
    words = F.split("phrase", " ")
    longer = phrases.filter(F.size(words) > 2)
    inner = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.size(words) - 1))).withColumn(
        "at", F.explode(F.sequence(F.lit(1), F.size(words) - F.col("size") + 1))
    )
    return (
        inner.select("lang", F.array_join(F.slice(words, F.col("at"), F.col("size")), " ").alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("within"))
    )


def mine(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    longest: int = LONGEST,
    share: int = SHARE,
    top: int = TOP,
    most: int = MOST,
    size: int = BLOCK,
) -> DataFrame:
    """Each language's best phrases: (lang, rank, phrase, a, l, r, n, score)."""
    spark = docs.sparkSession
    with arrow_rows(spark, BATCH):
        corpus = encoded(docs, lang, text, size)
    with arrow_rows(spark, BLOCKS):
        found = candidates(corpus, least, longest)
        if found is None:
            return _nothing(spark)
        frequent = counted(corpus, found, least, most)
    totals = corpus.groupBy("lang").agg(F.sum("n_words").alias("n"))
    inside = (F.col("within") * 100 >= F.lit(share) * F.col("a")) & F.col("within").isNotNull()
    left = scored(frequent, totals).join(swallowed(frequent), ["lang", "phrase"], "left").filter(~inside)
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    return (
        left.withColumn("rank", place)
        .filter(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
