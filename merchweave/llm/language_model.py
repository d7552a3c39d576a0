"""Scoring of whole documents by a gated recurrent language model.

The corpus is counted first: how often each word occurs in the training documents. The base score of a
token is its smoothed unigram probability from these counts. The ``VOCABULARY`` most frequent words, the
end of a document and one mark for all other words are the model's symbols; a word behind the mark has
the mark's probability times its share of the unigram mass of all such words, so every text has a
proper probability.

The network has one gated recurrent layer. Its softmax is factored: first the class of the next symbol,
then the symbol within its class; classes are runs of equal length in order of frequency. Biases start
at the unigram probabilities. It is trained by truncated backpropagation: documents run through many
lanes side by side, gradients go back ``STEPS`` tokens, the state is carried on and set to zero where a
document begins. Every training document is read once, in ``ROUNDS`` rounds; in a round every task
starts from the same weights, trains on its own documents, and the weights are averaged by the number
of tokens. In scoring the state is carried from a document's first token to its last.

Words are what ASCII white space separates, A-Z lower-cased; each document ends with one end token.
NULL texts are empty and consist of the end alone. NULL ids are in the training part. Rows with
equal ids are scored one by one. Without training documents all words are unknown, and the network keeps
its starting weights. Empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchweave.llm.tokens import slices
from merchweave.session import staged

HIDDEN = 16
CLASSES = 32
CLASS_SIZE = 32
SYMBOLS = CLASSES * CLASS_SIZE
VOCABULARY = SYMBOLS - 2
END, RARE = 0, 1
KNOWN = 100_000  # words whose counts every task has at hand; the others are looked up by a join
LANES = 256
STEPS = 16
SCORE_STEPS = 64  # taken at a time in scoring; does not change results
BLOCK = 2_000_000  # tokens after which documents go to the lanes
ROUNDS = 2
RATE = 0.01
HELD_OUT = 2  # remainder of the id's CRC-32 by 7

SHAPES = {
    "E": (SYMBOLS, 3 * HIDDEN),
    "U": (HIDDEN, 3 * HIDDEN),
    "Wc": (HIDDEN, CLASSES),
    "bc": (CLASSES,),
    "Ww": (CLASSES, HIDDEN, CLASS_SIZE),
    "bw": (CLASSES, CLASS_SIZE),
}


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of binary texts one after the other, and the places where each text's words begin and end."""
    large = pa.types.is_large_binary(texts.type)
    plain = pc.ascii_lower(pc.fill_null(texts, b"").view(pa.large_string() if large else pa.string()))
    parts = pc.ascii_split_whitespace(plain)
    found = parts.flatten()
    there = pc.greater(pc.binary_length(found), 0)  # white space at either end leaves an empty one
    places = np.cumsum(np.append(0, there.to_numpy(zero_copy_only=False)))[parts.offsets.to_numpy()]
    return found.filter(there).view(texts.type), places


def documents(symbols: np.ndarray, places: np.ndarray) -> Iterator[np.ndarray]:
    """The symbols of every text with an end."""
    every = np.insert(symbols, places[1:], END)
    ends = (places + np.arange(len(places))).tolist()
    return (every[a:b] for a, b in zip(ends, ends[1:], strict=False))


# ---- the network ----


def start_weights(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Small fixed weights, and biases that give the symbols' shares."""
    rng = np.random.default_rng(0)
    out = {name: (rng.standard_normal(shape) * 0.1).astype(np.float32) for name, shape in SHAPES.items()}
    share = (counts + 0.5).reshape(CLASSES, CLASS_SIZE)
    out["bc"] = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
    out["bw"] = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)
    return out


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[name].ravel() for name in SHAPES])


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = math.prod(shape)
        out[name] = values[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def _exponentials(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns shifted to a maximum of zero, their exponentials and the sums of these."""
    x -= x.max(axis=0)
    e = np.exp(x)
    return x, e, e.sum(axis=0)


def forward(w: dict, h: np.ndarray, inputs: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list]:
    """States after every step (steps, lanes, hidden), and what going back needs."""
    # Both parts on their own, each in one piece of memory.
    x_gates, x_new = (np.ascontiguousarray(e)[inputs] for e in np.split(w["E"], [2 * HIDDEN], axis=1))
    kept = []
    u_gates, u_new = w["U"][:, : 2 * HIDDEN], w["U"][:, 2 * HIDDEN :]
    states = np.empty((len(inputs), len(h), HIDDEN), np.float32)
    for t in range(len(inputs)):
        if first[t].any():
            h = np.where(first[t][:, None], np.float32(0), h)
        gates = h @ u_gates
        gates += x_gates[t]
        np.exp(np.negative(gates, out=gates), out=gates)
        gates += 1
        np.divide(1, gates, out=gates)
        z, r = np.ascontiguousarray(gates[:, :HIDDEN]), np.ascontiguousarray(gates[:, HIDDEN:])
        reset = r * h
        n = reset @ u_new
        n += x_new[t]
        np.tanh(n, out=n)
        kept.append((h, z, r, n, reset))
        h = np.add(h, z * (n - h), out=states[t])
    return states, kept


def log_probabilities(w: dict, states: np.ndarray, targets: np.ndarray, back: bool = False):
    """Natural log-probability of each target after its state; with ``back``, also the gradients of their sum."""
    # Tokens stand in the columns of the softmax, in order of their target's class.
    classes, places = np.divmod(targets, CLASS_SIZE)
    order = np.argsort(classes.astype(np.int16), kind="stable")
    states, classes, places, column = states[order], classes[order], places[order], np.arange(len(targets))
    x, e, total = _exponentials(w["Wc"].T @ states.T + w["bc"][:, None])
    found = x[classes, column] - np.log(total)
    grad, d_states = {}, None
    if back:
        d = e / -total
        d[classes, column] += 1
        grad = {"Wc": (d @ states).T, "bc": d.sum(axis=1), "Ww": np.zeros_like(w["Ww"]), "bw": np.zeros_like(w["bw"])}
        d_states = d.T @ w["Wc"].T
    ends = np.cumsum(np.bincount(classes, minlength=CLASSES))
    for c in range(CLASSES):
        rows = slice(ends[c - 1] if c else 0, ends[c])
        own, at = states[rows], places[rows]
        if not len(own):
            continue
        x, e, total = _exponentials(w["Ww"][c].T @ own.T + w["bw"][c][:, None])
        found[rows] += x[at, column[: len(own)]] - np.log(total)
        if back:
            d = e / -total
            d[at, column[: len(own)]] += 1
            grad["Ww"][c], grad["bw"][c] = (d @ own).T, d.sum(axis=1)
            d_states[rows] += d.T @ w["Ww"][c].T
    out = np.empty_like(found)
    out[order] = found
    if not back:
        return out
    d_out = np.empty_like(d_states)
    d_out[order] = d_states
    return out, grad, d_out


def backward(w: dict, kept: list, inputs: np.ndarray, first: np.ndarray, d_states: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the recurrent part, back to the window's first step."""
    d_x = np.empty((*inputs.shape, 3 * HIDDEN), np.float32)
    back_gates, back_new = w["U"][:, : 2 * HIDDEN].T, w["U"][:, 2 * HIDDEN :].T
    d_h = np.zeros_like(d_states[0])
    for t in reversed(range(len(inputs))):
        h, z, r, n, _ = kept[t]
        d_h = d_h + d_states[t]
        d_z, d_r, d_n = d_x[t, :, :HIDDEN], d_x[t, :, HIDDEN : 2 * HIDDEN], d_x[t, :, 2 * HIDDEN :]
        by_z = d_h * z
        np.multiply(by_z, 1 - n * n, out=d_n)
        np.multiply(by_z * (1 - z), n - h, out=d_z)
        d_reset = d_n @ back_new
        by_r = d_reset * r
        np.multiply(by_r * (1 - r), h, out=d_r)
        d_h = d_h - by_z + by_r + d_x[t, :, : 2 * HIDDEN] @ back_gates
        d_h[first[t]] = 0
    gates, new = d_x[:, :, : 2 * HIDDEN].reshape(-1, 2 * HIDDEN), d_x[:, :, 2 * HIDDEN :].reshape(-1, HIDDEN)
    d_u = np.concatenate(
        [np.concatenate([k[0] for k in kept]).T @ gates, np.concatenate([k[4] for k in kept]).T @ new], axis=1
    )
    symbols, rows = inputs.ravel(), d_x.reshape(-1, 3 * HIDDEN)
    order = np.argsort(symbols.astype(np.int16), kind="stable")
    symbols = symbols[order]
    starts = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
    d_e = np.zeros_like(w["E"])
    d_e[symbols[starts]] = np.add.reduceat(rows[order], starts, axis=0)
    return {"E": d_e, "U": d_u}


class Lanes:
    """Documents laid end to end in lanes of about equal length, longest lane first."""

    def __init__(self, docs: list[np.ndarray], lanes: int = LANES):
        load = [(0, i) for i in range(min(lanes, len(docs)))]
        members: list[list[int]] = [[] for _ in load]
        for d in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
            size, lane = load[0]
            members[lane].append(d)
            heapq.heapreplace(load, (size + len(docs[d]), lane))
        members.sort(key=lambda m: -sum(len(docs[d]) for d in m))
        self.order = [d for m in members for d in m]
        sizes = np.asarray([len(docs[d]) for d in self.order], np.int64)
        self.starts = np.cumsum([0, *sizes])[:-1]
        self.targets = np.concatenate([docs[d] for d in self.order]) if docs else np.empty(0, np.int64)
        self.first = np.zeros(len(self.targets), bool)
        self.first[self.starts] = True
        self.inputs = np.concatenate([[END], self.targets[:-1]]).astype(np.int64) if docs else self.targets
        self.inputs[self.first] = END
        self.length = np.asarray([sum(len(docs[d]) for d in m) for m in members], np.int64)
        self.at = np.cumsum([0, *self.length])[:-1]

    def windows(self, steps: int = STEPS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (steps, lanes still running) in the token arrays, and which of them exist."""
        for t in range(0, int(self.length[0]) if len(self.length) else 0, steps):
            running = int((self.length > t).sum())
            step = np.arange(t, t + steps)[:, None]
            there = step < self.length[None, :running]
            yield self.at[None, :running] + np.minimum(step, self.length[None, :running] - 1), there


def log_likelihoods(w: dict, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log-probability of every document."""
    lanes = Lanes(docs)
    found = np.zeros(len(lanes.targets), np.float64)
    h = np.zeros((len(lanes.length), HIDDEN), np.float32)
    for places, there in lanes.windows(SCORE_STEPS):
        states, _ = forward(w, h[: places.shape[1]], lanes.inputs[places], lanes.first[places])
        h = states[-1]
        found[places[there]] = log_probabilities(w, states[there], lanes.targets[places[there]])
    out = np.zeros(len(docs))
    if docs:
        out[lanes.order] = np.add.reduceat(found, lanes.starts)
    return out


def blocks(docs: Iterable[np.ndarray], most: int = BLOCK) -> Iterator[list[np.ndarray]]:
    """Runs of whole documents, each run closed by the document that brings it to ``most`` tokens."""
    held, size = [], 0
    for doc in docs:
        held.append(doc)
        size += len(doc)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def learn(w: dict, docs: list[np.ndarray], moments: dict, t: int) -> int:
    """One pass over the documents, changing ``w`` and Adam's moments in place; gives the new step number."""
    lanes = Lanes(docs)
    h = np.zeros((len(lanes.length), HIDDEN), np.float32)
    for places, there in lanes.windows():
        inputs, first = lanes.inputs[places], lanes.first[places]
        states, kept = forward(w, h[: places.shape[1]], inputs, first)
        h = states[-1]
        _, grad, d_there = log_probabilities(w, states[there], lanes.targets[places[there]], back=True)
        d_states = np.zeros_like(states)
        d_states[there] = d_there
        grad |= backward(w, kept, inputs, first, d_states)
        t += 1
        # A window of few lanes moves the weights less.
        scale = RATE * min(1.0, len(d_there) / (LANES * STEPS / 4)) * math.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        for name, g in grad.items():
            g = g / np.float32(len(d_there))
            m, v = moments[name]
            m += np.float32(0.1) * (g - m)
            v += np.float32(0.001) * (g * g - v)
            w[name] += np.float32(scale) * m / (np.sqrt(v) + np.float32(1e-6))
    return t


# ---- the corpus ----


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over the texts of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(0)):
                seen = split(texts)[0].value_counts()
                yield pa.RecordBatch.from_arrays([seen.field("values").cast(pa.binary()), seen.field("counts")], ["word", "c"])

    return docs.select("text").mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


class Symbols:
    """Words to symbols, and the counts of the words at hand."""

    def __init__(self, common: list[tuple[bytes, int]]):
        ranked = sorted(common, key=lambda x: (-x[1], x[0]))
        self.words = pa.array([word for word, _ in ranked], pa.binary())
        self.counts = np.asarray([c for _, c in ranked], np.int64)

    def places(self, found: pa.Array, most: int | None = None) -> np.ndarray:
        """Each word's place among those at hand (the first ``most`` of them) or -1."""
        at_hand = self.words[:most].cast(found.type)
        return pc.fill_null(pc.index_in(found, at_hand), -1).to_numpy().astype(np.int64)

    @staticmethod
    def symbols(places: np.ndarray) -> np.ndarray:
        return np.where((places >= 0) & (places < VOCABULARY), places + 2, RARE)

    def training(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The symbols of every text, from the few words that have one."""
        found, at = split(texts)
        return documents(self.symbols(self.places(found, VOCABULARY)), at)


def common_words(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The words above the smallest count that at most ``most`` words exceed."""
    room, least = most, 0
    for row in counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.col("c").desc()).toLocalIterator():
        if row["n"] > room:
            least = row["c"]
            break
        room -= row["n"]
    return [(bytes(r["word"]), r["c"]) for r in counts.filter(F.col("c") > least).toLocalIterator()]


def score(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    crc = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary"))
    texts = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(text).cast("binary").alias("text"),
        (crc % 7 == HELD_OUT).alias("held_out"),
        (F.floor(crc / 7) % ROUNDS).cast("int").alias("round"),
    )
    training = texts.filter(~F.col("held_out"))
    counts = staged(count_words(training), "word-counts")
    n_docs = training.count()
    n_words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, kinds = n_words + n_docs, distinct + (1 if n_docs else 0)
    table = Symbols(common_words(counts, KNOWN))
    shared = spark.sparkContext.broadcast(table)  # at most KNOWN words
    denominator = total + kinds + 1

    top = table.counts[:VOCABULARY]
    start = np.zeros(SYMBOLS)
    start[END], start[2 : 2 + len(top)] = n_docs, top
    start[RARE] = max(0, n_words - int(top.sum()))
    # The unigram mass that is left for words behind the mark.
    rare_mass = max(1e-12, 1 - (n_docs + 1 + int((top + 1).sum())) / denominator)

    weights = flat(start_weights(start))
    for k in range(ROUNDS):
        now = spark.sparkContext.broadcast(weights.astype(np.float32))

        def train(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            w, seen, t = shaped(now.value.copy()), 0, 0
            moments = {name: (np.zeros_like(x), np.zeros_like(x)) for name, x in w.items()}
            symbols = shared.value
            for batch in batches:
                for lists in blocks(chain.from_iterable(map(symbols.training, slices(batch.column(0))))):
                    t = learn(w, lists, moments, t)
                    seen += sum(map(len, lists))
            if seen:
                values = flat(w).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seen], pa.int64()), pa.array([values], pa.list_(pa.float64()))], ["n", "weights"]
                )

        trained = staged(
            training.filter(F.col("round") == k).select("text").mapInArrow(train, "n bigint, weights array<double>"),
            "weights",
        )
        mean = (
            trained.select("n", F.posexplode("weights").alias("at", "x"))
            .groupBy("at")
            .agg((F.sum(F.col("n") * F.col("x")) / F.sum("n")).alias("x"))
            .orderBy("at")
            .collect()  # as many numbers as the network has
        )
        if mean:
            weights = np.asarray([r["x"] for r in mean])

    final = spark.sparkContext.broadcast(weights.astype(np.float32))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, symbols = shaped(final.value.copy()), shared.value
        base = np.log10((symbols.counts + 1) / denominator)
        end = math.log10((n_docs + 1) / denominator)
        for batch in batches:
            sums: list[np.ndarray] = [np.zeros((5, 0))]
            rare_words, rare_n, rare_ends = [pa.array([], pa.binary())], [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]

            def read(texts: pa.Array) -> Iterator[np.ndarray]:
                for part in slices(texts):
                    found, at = split(part)
                    places, text_of = symbols.places(found), np.repeat(np.arange(len(part)), np.diff(at))
                    there, further = places >= 0, places >= VOCABULARY
                    own = np.zeros(len(places))
                    own[there] = base[places[there]]
                    behind = np.where(further, own, 0.0)
                    sums.append(
                        np.stack([np.bincount(text_of, x, len(part)) for x in (None, there, own, behind, ~there | further)])
                    )
                    missing = np.flatnonzero(~there)
                    coded = found.take(pa.array(missing)).dictionary_encode()
                    kinds_here = max(1, len(coded.dictionary))
                    pairs, n = np.unique(text_of[missing] * kinds_here + coded.indices.to_numpy(), return_counts=True)
                    owner, code = np.divmod(pairs, kinds_here)
                    rare_words.append(coded.dictionary.take(pa.array(code)).cast(pa.binary()))
                    rare_n.append(n)
                    rare_ends.append(rare_ends[-1][-1] + np.searchsorted(owner, np.arange(len(part)), side="right"))
                    yield from documents(symbols.symbols(places), at)

            parts = [log_likelihoods(w, lists) for lists in blocks(read(batch.column(1)))]
            size, known, base_sum, behind, n_behind = np.concatenate(sums, axis=1)
            network = np.concatenate(parts or [np.zeros(0)]) / math.log(10)
            network += behind - n_behind * math.log10(rare_mass)
            rare = pa.StructArray.from_arrays(
                [pa.concat_arrays(rare_words), pa.array(np.concatenate(rare_n))], ["word", "n"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(size.astype(np.int64) + 1),
                    pa.array(known.astype(np.int64) + (1 if n_docs else 0)),
                    pa.array(base_sum + end),
                    pa.array(network),
                    pa.ListArray.from_arrays(pa.array(np.concatenate(rare_ends), pa.int32()), rare),
                ],
                ["doc_id", "held_out", "n_tokens", "known", "base", "network", "rare"],
            )

    rows = staged(
        texts.select("doc_id", "text", "held_out")
        .mapInArrow(
            run,
            f"doc_id {kind}, held_out boolean, n_tokens bigint, known bigint, base double, network double, "
            "rare array<struct<word: binary, n: bigint>>",
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "scored",
    )
    c = F.coalesce("c", F.lit(0))
    looked_up = (
        rows.select("row", F.inline("rare"))
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("known_rare"),
            F.sum(F.col("n") * F.log10((c + 1) / F.lit(float(denominator)))).alias("base_rare"),
        )
    )
    zero = F.lit(0.0)
    return rows.drop("rare").join(looked_up, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("known_rare", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_rare", zero)).alias("base_score"),
        (F.col("network") + F.coalesce("base_rare", zero)).alias("score"),
    )
