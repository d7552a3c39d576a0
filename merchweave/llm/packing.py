"""Packing documents into sequences of a fixed number of tokens by the sum-of-squares rule.

A document longer than a sequence is cut; its first piece takes the remainder and all others fill a
sequence each. What is left of every document is packed, longest first: among the open sequences
(counted by free tokens) and a new one, it goes where the sum over all gaps of the squared number
of open sequences with that gap becomes smallest; ties go to the smallest gap left.

Documents are dealt by hash into blocks of about ``BLOCK`` and each block is packed by itself, so a
task's memory is bounded. The rule keeps sequences of many gaps open for pieces yet to come; when
no more come, those left unfilled are opened again and their pieces, with those of the other
blocks, put longest first into the fullest sequence that takes them.

NULL text is empty; an empty document is its end id alone. Rows with equal ids are packed as
different documents. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchweave.llm import tokens
from merchweave.session import staged

LENGTH = 1024
BLOCK = 200_000  # documents


def lengths(docs: DataFrame, id_column: str, text: str, tokenizer: str, length: int) -> DataFrame:
    """doc_id, n_tokens (with the end id), first (length of piece 0) and the CRC-32 of every piece's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer).batch
        for batch in batches:
            at = 0
            for ids, places in encode(batch.column(1)):
                n = np.diff(places)
                first = (n - 1) % length + 1
                raw, crcs = memoryview(ids).cast("B"), []
                for start, cut, end in zip(places[:-1].tolist(), (places[:-1] + first).tolist(), places[1:].tolist(), strict=True):
                    starts = [start, *range(cut, end, length)]
                    crcs.append([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, [*starts[1:], end], strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(n)),
                        pa.array(n, pa.int64()),
                        pa.array(first, pa.int32()),
                        pa.array(crcs, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_tokens", "first", "crcs"],
                )
                at += len(n)

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, first int, crcs array<bigint>"
    )


def sum_of_squares(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of every size, in the order given, and the free tokens of every sequence."""
    count = np.zeros(length + 1, np.int64)  # open sequences by free tokens
    stacks: list[list[int]] = [[] for _ in range(length + 1)]
    sequence, offset, free = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int32), []
    far = np.iinfo(np.int64).max
    for i, size in enumerate(sizes.tolist()):
        new = 2 * count[length - size] + 1 if size < length else 0
        best, gap = far, 0
        if size < length:
            here = count[size:length]
            change = 2 * (count[: length - size] - here) + 2
            change[0] = 1 - 2 * here[0]  # nothing stays open
            change[here == 0] = far
            gap = int(change.argmin())
            best = change[gap]
        if best <= new and best != far:
            old = gap + size
            s = stacks[old].pop()
            count[old] -= 1
        else:
            old, gap, s = length, length - size, len(free)
            free.append(length)
        if gap:
            stacks[gap].append(s)
            count[gap] += 1
        sequence[i], offset[i], free[s] = s, length - old, gap
    return sequence, offset, np.asarray(free, np.int64)


def best_fit(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``sum_of_squares``, but every size goes to the sequence with the smallest gap that takes it."""
    count = np.zeros(length + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(length + 1)]
    sequence, offset, free = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int32), []
    for i, size in enumerate(sizes.tolist()):
        old = size + int((count[size:length] > 0).argmax()) if size < length else length
        if old < length and count[old]:
            s = stacks[old].pop()
            count[old] -= 1
        else:
            old, s = length, len(free)
            free.append(length)
        gap = old - size
        if gap:
            stacks[gap].append(s)
            count[gap] += 1
        sequence[i], offset[i], free[s] = s, length - old, gap
    return sequence, offset, np.asarray(free, np.int64)


def _packed(pieces: DataFrame, blocks: int, length: int, round_no: int) -> DataFrame:
    """Place (key, first) of every row; ``closed`` is false where the sequence has free tokens left."""
    schema = T.StructType(
        [
            *pieces.schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.IntegerType()),
            T.StructField("closed", T.BooleanType()),
        ]
    )

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("first", "descending"), ("key", "ascending")])
        place = best_fit if round_no else sum_of_squares
        sequence, offset, free = place(table.column("first").to_numpy(), length)
        block = (round_no << 60) + (table.column("__block")[0].as_py() << 32)
        table = table.drop_columns(["__block"])
        table = table.append_column("sequence_id", pa.array(sequence + block, pa.int64()))
        table = table.append_column("offset", pa.array(offset, pa.int32()))
        return table.append_column("closed", pa.array(free[sequence] == 0))

    block = F.pmod(F.xxhash64("key", F.lit(round_no)), F.lit(blocks))
    return pieces.withColumn("__block", block).groupBy("__block").applyInArrow(run, schema)


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    length: int = LENGTH,
    block: int = BLOCK,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    # The row's own key must not change when a task runs again, so it is written with the lengths.
    known = staged(
        lengths(docs, id_column, text, tokenizer or tokens.default_path(), length).withColumn(
            "key", F.monotonically_increasing_id()
        ),
        "lengths",
    )
    n = known.count()
    open_pieces = known.filter(F.col("first") < length).select("key", "first")
    blocks = math.ceil(max(n, 1) / block)
    placed = staged(_packed(open_pieces, blocks, length, 0), "packed")
    rest = placed.filter("not closed").select("key", "first")
    again = _packed(rest, math.ceil(max(rest.count(), 1) / block), length, 1)
    placed = placed.filter("closed").unionByName(again)
    firsts = placed.select("key", "sequence_id", "offset")
    alone = F.lit(1 << 61)
    rows = known.join(firsts, "key", "left").select("*", F.posexplode("crcs").alias("piece", "ids_crc32"))
    packed = F.col("sequence_id").isNotNull() & (F.col("piece") == 0)
    own = alone + F.monotonically_increasing_id()  # a full piece is a sequence of its own
    return rows.select(
        "doc_id",
        "piece",
        F.when(F.col("piece") == 0, F.lit(0))
        .otherwise(F.col("first") + (F.col("piece") - 1) * F.lit(length))
        .cast("long")
        .alias("start"),
        F.when(F.col("piece") == 0, F.col("first")).otherwise(F.lit(length)).cast("long").alias("length"),
        "ids_crc32",
        F.when(packed, F.col("sequence_id")).otherwise(own).alias("sequence_id"),
        F.when(packed, F.col("offset")).otherwise(F.lit(0)).cast("long").alias("offset"),
    )
