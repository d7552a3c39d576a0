"""Token ids of a corpus as patched frame-of-reference blocks, in ascending order of document.

Format. A row of the table is a segment: whole documents in order, at least ``SEGMENT`` ids unless it
is the last of its part. ``payload`` is a sequence of blocks of ``BLOCK_IDS`` ids (the last may be
shorter); ``block_starts`` has the byte at which every block starts, so that any id can be reached
without reading those before it. All numbers are little-endian:

    u32 base        smallest id of the block
    u8  width       bits of a packed value
    u16 n           ids in the block
    u16 exceptions  ids whose value above the base needs more than width bits
    the low width bits of every value above the base, first value in the lowest bits, in whole bytes
    u16 position of each exception
    u32 high part (value >> width) of each exception

The width is the smallest one that holds ``PERCENTILE`` percent of the block's values; the others are
exceptions of 48 bits. ``doc_ids`` and ``doc_lengths`` list a
segment's documents. Segments are written by Spark as Parquet, so a lost task leaves no half-written
files and any store that Spark writes to will do.

NULL text is empty; every document ends with id 2. Documents of equal id are ordered by their text's
hash. NULL ids come first. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.llm import tokens
from merchweave.session import shared_dir

BLOCK_IDS = 1024
PERCENTILE = 90
SEGMENT = 1 << 18  # ids
HEAD = 9  # bytes before the packed values
_POWERS = np.asarray([1 << i for i in range(32)], np.uint32)
_BITS = np.searchsorted(_POWERS, np.arange(1 << 16), side="right").astype(np.uint8)


def _needed(values: np.ndarray) -> np.ndarray:
    """The bits of every value; by a table where all are below 16 bits, as most ids are."""
    return _BITS[values] if values.max() < len(_BITS) else np.searchsorted(_POWERS, values, side="right")


def _widths(need: np.ndarray) -> np.ndarray:
    """The smallest width of every row that holds ``PERCENTILE`` percent of its values; ``need`` has their bits."""
    rows, n = need.shape
    at_width = np.bincount((np.arange(rows)[:, None] * 33 + need).ravel(), minlength=rows * 33).reshape(rows, 33)
    over = n - np.cumsum(at_width, axis=1)  # exceptions by width
    return np.argmax(over <= n * (100 - PERCENTILE) / 100, axis=1)


def _packed(values: np.ndarray, w: int) -> np.ndarray:
    """The low ``w`` bits of all values of a row one after the other, in whole bytes: eight values are ``w`` bytes."""
    rows, n = values.shape
    wide = np.uint32 if w + 7 <= 32 else np.uint64
    eights = np.zeros((rows, (n + 7) // 8 * 8), wide)
    eights[:, :n] = values & np.uint32((1 << w) - 1)
    eights = eights.reshape(rows, -1, 8)
    out = np.zeros((*eights.shape[:2], w), np.uint8)
    for i in range(8 if w else 0):
        byte, bit = divmod(i * w, 8)
        moved = eights[:, :, i] << wide(bit)
        for j in range(byte, (i * w + w - 1) // 8 + 1):
            out[:, :, j] |= moved.astype(np.uint8)
            moved >>= wide(8)
    return out.reshape(rows, -1)[:, : (n * w + 7) // 8]


def _unpacked(packed: np.ndarray, n: int, w: int) -> np.ndarray:
    """The ``n`` values of every row that ``_packed`` made: each is cut out of the four or eight bytes it begins in."""
    rows, size = packed.shape
    wide = np.dtype("<u4" if w + 7 <= 32 else "<u8")
    padded = np.zeros((rows, size + wide.itemsize), np.uint8)
    padded[:, :size] = packed
    byte, bit = np.divmod(np.arange(n) * w, 8)
    values = np.ndarray((rows, size + 1), wide, padded, strides=(padded.shape[1], 1))[:, byte]
    values >>= bit.astype(wide)
    values &= wide.type((1 << w) - 1)
    return values.astype(np.uint32, copy=False)


def _pack_rows(ids: np.ndarray) -> list[bytes]:
    """The blocks of an array with one block per row; rows of one width are packed together."""
    n = ids.shape[1]
    base = ids.min(axis=1)
    values = ids - base[:, None]
    need = _needed(values)
    width = _widths(need)
    out: list[bytes] = [b""] * len(ids)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        own = values[rows]
        packed = _packed(own, w)
        where, odd = np.nonzero(need[rows] > w)
        ends = np.searchsorted(where, np.arange(len(rows) + 1))
        high = (own[where, odd].astype(np.uint64) >> np.uint64(w)).astype("<u4")
        odd = odd.astype("<u2")
        for i, row in enumerate(rows.tolist()):
            a, b = ends[i], ends[i + 1]
            head = int(base[row]).to_bytes(4, "little") + bytes([w]) + n.to_bytes(2, "little") + int(b - a).to_bytes(2, "little")
            out[row] = head + packed[i].tobytes() + odd[a:b].tobytes() + high[a:b].tobytes()
    return out


def pack_ids(ids: np.ndarray) -> tuple[bytes, list[int]]:
    """The blocks of all ids, and the byte at which each starts."""
    ids = ids.astype(np.uint32, copy=False)
    whole = len(ids) // BLOCK_IDS * BLOCK_IDS
    blocks = _pack_rows(ids[:whole].reshape(-1, BLOCK_IDS)) if whole else []
    if whole < len(ids):
        blocks += _pack_rows(ids[None, whole:])
    starts = np.cumsum([0, *[len(b) for b in blocks]])[:-1]
    return b"".join(blocks), starts.tolist()


def unpack_ids(payload: bytes, starts: list[int]) -> np.ndarray:
    """The ids of the blocks at ``starts``; blocks of one width and length are unpacked together."""
    alike: dict[tuple[int, int], list[int]] = {}
    for i, at in enumerate(starts):
        alike.setdefault((payload[at + 4], int.from_bytes(payload[at + 5 : at + 7], "little")), []).append(i)
    out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(starts)
    for (w, n), members in alike.items():
        size = (n * w + 7) // 8
        packed = np.frombuffer(b"".join([payload[starts[i] + HEAD : starts[i] + HEAD + size] for i in members]), np.uint8)
        values = _unpacked(packed.reshape(len(members), size), n, w)
        for row, i in zip(values, members, strict=True):
            at = starts[i]
            odd = int.from_bytes(payload[at + 7 : at + 9], "little")
            if odd:
                where = np.frombuffer(payload, "<u2", odd, at + HEAD + size)
                high = np.frombuffer(payload, "<u4", odd, at + HEAD + size + 2 * odd).astype(np.uint64)
                row[where] |= (high << np.uint64(w)).astype(np.uint32)
            out[i] = row + np.uint32(int.from_bytes(payload[at : at + 4], "little"))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def write(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> None:
    """Write the corpus to ``path``, a folder of any store Spark knows."""
    tokenizer = tokenizer or tokens.default_path()
    kind = docs.schema[id_column].dataType.simpleString()
    schema = (
        f"segment bigint, n_tokens bigint, payload binary, block_starts array<bigint>, "
        f"doc_ids array<{kind}>, doc_lengths array<bigint>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer).batch
        held: list[np.ndarray] = []
        names: list = []
        size, segment, id_type = 0, 0, None

        def close() -> pa.RecordBatch:
            payload, starts = pack_ids(np.concatenate(held))
            columns = [
                pa.array([segment], pa.int64()),
                pa.array([size], pa.int64()),
                pa.array([payload], pa.binary()),
                pa.array([starts], pa.list_(pa.int64())),
                pa.array([names], pa.list_(id_type)),
                pa.array([[len(b) for b in held]], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(
                columns, ["segment", "n_tokens", "payload", "block_starts", "doc_ids", "doc_lengths"]
            )

        for batch in batches:
            id_type = batch.column(0).type
            every = iter(batch.column(0).to_pylist())
            for ids, places in encode(batch.column(1)):
                ends = places.tolist()
                for a, b, name in zip(ends, ends[1:], every, strict=False):
                    held.append(ids[a:b])
                    names.append(name)
                    size += b - a
                    if size >= SEGMENT:
                        yield close()
                        held, names, size, segment = [], [], 0, segment + 1
        if held:
            yield close()

    ordered = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    # The order of parts is the order of documents, so the part's number is written with its segments.
    ordered.mapInArrow(run, schema).withColumn("part", F.spark_partition_id()).write.option(
        "compression", "none"
    ).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, ids (array), in segments as written: part, segment, place."""
    table = spark.read.parquet(path)
    kind = table.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_ids(row["payload"], row["block_starts"])
                ends = np.cumsum([0, *row["doc_lengths"]])
                n = len(row["doc_ids"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array([row["segment"]] * n, pa.int64()),
                        pa.array(range(n), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int64), pa.int64())),
                    ],
                    ["doc_id", "part", "segment", "place", "ids"],
                )

    return table.mapInArrow(run, f"doc_id {kind}, part int, segment bigint, place bigint, ids array<bigint>")


def summary(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    table = spark.read.parquet(path)
    kind = table.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = memoryview(unpack_ids(row["payload"], row["block_starts"]).astype("<u4").tobytes())
                ends = np.cumsum([0, *row["doc_lengths"]]).tolist()
                n = len(row["doc_ids"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array([row["segment"]] * n, pa.int64()),
                        pa.array(ends[:-1], pa.int64()),
                        pa.array(row["doc_lengths"], pa.int64()),
                        pa.array([zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(ends, ends[1:], strict=False)], pa.int64()),
                    ],
                    ["doc_id", "part", "segment", "inside", "n_tokens", "ids_crc32"],
                )

    rows = table.mapInArrow(
        run, f"doc_id {kind}, part int, segment bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    )
    # One row per part: parts are as many as the write had tasks, whatever the number of documents.
    parts = table.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before_part = parts.select(
        "part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before_part")
    )
    inside_part = W.partitionBy("part").orderBy("segment")
    segments = (
        table.select("part", "segment", "n_tokens")
        .withColumn("before_segment", F.sum("n_tokens").over(inside_part) - F.col("n_tokens"))
        .drop("n_tokens")
        .join(before_part, "part")
    )
    return rows.join(segments, ["part", "segment"]).select(
        "doc_id",
        (F.col("before_part") + F.col("before_segment") + F.col("inside")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def new_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/merchweave/token-files-{uuid.uuid4().hex}"
