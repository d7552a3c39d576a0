"""Near-duplicates by SimHash, found through deletion-variant signatures.

A text's fingerprint has 64 bits, a bit being set where more than half of its shingles' hashes have
it set. Two fingerprints are linked if they differ in at most two bits. Cut into two halves, such a
pair agrees in one half up to a single bit. So each half is indexed under 32 signatures, one per bit
left out; fingerprints that share a signature meet in an equality join and are verified.

Only distinct fingerprints are joined, copies ride along. A signature shared by more than ``FEW``
fingerprints is not joined within itself, which would make pairs with the square of its size. Its
fingerprints are linked through points instead: two fingerprints differ in at most two bits exactly if
changing at most one bit of each can give the same point, and all that share a point are linked to its
smallest, one row each. Both ways are exact, so no link is lost. Spark does not see in its estimates that a
fingerprint has 64 signatures and 65 points, and would broadcast them all; their joins are merge joins at every size.

Links are joined to components by repeatedly linking every node to the smallest of its neighbours, in
tables written to the shared folder.

Words are what ASCII white space separates, A-Z lower-cased; shingles are three words, or all words
of a shorter text. NULL and empty texts have fingerprint zero, linked like any other. Rows with NULL
ids are members of their group but never name it, unless all ids are NULL. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchweave.llm.common import partitions
from merchweave.session import staged

WORDS = 3
SEED = 42
FEW = 8
DEALT = 10_000  # fingerprints of one task, about
SLICE = 65_536  # hashes whose bits are counted at once


def fingerprint(text: bytes, words: int = WORDS) -> int:
    found = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not found:
        return 0
    if len(found) <= words:
        hashes = np.asarray([xxhash.xxh64_intdigest(b" ".join(found), SEED)], np.uint64)
    else:
        joined = b" ".join(found)
        ends = np.cumsum([len(w) + 1 for w in found]) - 1
        starts = [0, *(ends[: len(found) - words] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)),
            np.uint64,
            len(starts),
        )
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), SLICE):
        bits = np.unpackbits(hashes[i : i + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    chosen = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(chosen.view("<i8")[0])


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, a hash of the text, and the fingerprint as a signed 64-bit number."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t or b"", words) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["doc_id", "text_hash", "fp"]
            )

    return docs.select(
        F.col(id_column).alias("doc_id"), text_hash(text).alias("text_hash"), F.col(text).cast("binary").alias("text")
    ).mapInArrow(run, f"doc_id {kind}, text_hash bigint, fp bigint")


def signatures(distinct: DataFrame) -> DataFrame:
    """(signature, fp): 64 rows per fingerprint, one for each bit left out of the half that holds it."""
    bit = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit")
    half = F.expr("shiftrightunsigned(fp, if(bit < 32, 0, 32)) & 4294967295")
    left_out = F.expr("bit % 32")
    kept = half.bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, bit % 32)")))
    return distinct.select("fp", bit).select(
        # The half's other 31 bits below, which half and which bit above.
        (kept + F.shiftleft(left_out.cast("long"), 32) + F.shiftleft((F.col("bit") >= 32).cast("long"), 37)).alias(
            "signature"
        ),
        "fp",
    )


def links(distinct: DataFrame, few: int = FEW) -> DataFrame:
    """Pairs (a, b) that connect all fingerprints differing in at most two bits."""
    # A task adds up 64 signatures of each of its fingerprints in memory, so no task gets very many fingerprints.
    tasks = max(partitions(distinct.sparkSession), -(-distinct.count() // DEALT))
    variants = signatures(distinct.repartition(tasks, "fp"))
    sizes = variants.groupBy("signature").agg(F.count("*").alias("n")).filter("n > 1")
    shared = staged(variants.hint("merge").join(sizes, "signature"), "signatures")
    small = shared.filter(F.col("n") <= few)
    close = (
        small.select("signature", F.col("fp").alias("a"))
        .hint("merge")
        .join(small.select("signature", F.col("fp").alias("b")), "signature")
        .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2))
        .select("a", "b")
        .distinct()
    )
    crowded = shared.filter(F.col("n") > few).select("fp").distinct()
    around = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    points = crowded.select(F.col("fp").alias("b"), F.explode(around).alias("point"))
    stars = points.groupBy("point").agg(F.min("b").alias("a"), F.count("*").alias("n")).filter("n > 1").drop("n")
    through = points.hint("merge").join(stars, "point").filter("a < b").select("a", "b").distinct()
    return close.unionByName(through)


def components(pairs: DataFrame) -> DataFrame:
    """(node, root): the smallest node that can be reached, for every node in ``pairs``."""
    edges = staged(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    before = None
    while True:
        # Larger neighbours, then smaller ones, move to the smallest neighbour of each node.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Every node has a smallest neighbour; in a left join the table of all edges is never broadcast.
        larger = both.join(least, "u", "left").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(down, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = staged(smaller.filter("u <> v").distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, text_hash, fp, component_id (the smallest id of the group), first_hash."""
    known = staged(fingerprints(docs, id_column, text), "fingerprints")
    # NULL ids come last; of texts that share an id the smaller hash is first.
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    distinct = staged(known.groupBy("fp").agg(first), "distinct-fingerprints")
    found = components(links(distinct.select("fp")))
    rooted = distinct.join(found, distinct.fp == found.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first").alias("best"))
    by_fp = rooted.join(names, "root").select(
        F.col("fp").alias("__fp"), F.col("best.doc_id").alias("component_id"), F.col("best.text_hash").alias("first_hash")
    )
    # Every fingerprint is there; in a left join the table of all rows, which copies make small on disk, is never broadcast.
    return known.join(by_fp, F.col("fp") == F.col("__fp"), "left").drop("__fp")


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of every group, the one with the smallest id, with all its columns.

    Rows equal in both id and text are one document and stay or go together.
    """
    found = groups(docs, id_column, text)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))
    gone = found.filter(~stays).select(F.col("doc_id").alias("__gone_id"), F.col("text_hash").alias("__gone_hash"))
    same = F.col(id_column).eqNullSafe(F.col("__gone_id")) & (text_hash(text) == F.col("__gone_hash"))
    return docs.join(gone.hint("merge"), same, "left_anti")  # the same join at every size
