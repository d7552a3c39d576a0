"""Line deduplication against levelled sorted runs of line hashes.

Documents come in batches, largest ids first. A run is a table of line hashes, bucketed and sorted by
hash, with the number of documents that hold the line and the document it belongs to. A new batch is
merge-joined with every run; hashes that no run has are new, and their owner is the batch's largest
document that holds them. The batch then becomes a run of its own. When a level has ``FAN_IN`` runs
they are merged into one of the next level, so a batch meets a number of runs that grows with the
logarithm of the batches. Runs are bucketed alike, so neither joining nor merging shuffles them.

At the end a line that enough documents hold stays in its owner, with all its repeats there, and goes
from all others.

A line's key is the line without ASCII white space at its ends and with A-Z lower-cased, hashed to
128 bits; only keys of at least ``LEAST_CHARS`` code points are looked at. NULL and empty texts are
one empty line. Rows that share an id count as one document; NULL ids count as one document that comes
last. Empty tables give empty results; other columns pass through untouched.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchweave.llm.common import aside, partitions
from merchweave.session import staged

LEAST_CHARS = 40
LEAST_DOCS = 5
BATCHES = 4
FAN_IN = 2


def line_key(line: bytes, least: int = LEAST_CHARS) -> bytes | None:
    """The hash of a line's key, or None if the key is too short."""
    key = line.strip().lower()  # of bytes: ASCII only
    if len(key) < least or (len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least):
        return None
    return xxhash.xxh3_128_digest(key)


def document_keys(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, key), each key once per row of ``docs``."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                own = {line_key(line, least) for line in (value or b"").split(b"\n")} - {None}
                at += [i] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(found, pa.binary())], ["doc_id", "key"]
            )

    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {kind}, key binary"
    )


class LineRuns:
    """Levelled runs of (key, n_docs, owner). ``owner`` is set in the run that saw the key first."""

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN):
        self.spark, self.fan_in = spark, fan_in
        self.buckets = partitions(spark)
        self.name = f"line_run_{uuid.uuid4().hex}"
        self.written = 0
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame) -> str:
        table = f"{self.name}_{self.written}"
        self.written += 1
        rows.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key").saveAsTable(table)
        return table

    def tables(self) -> list[str]:
        return [t for level in self.levels for t in level]

    def _merged(self, tables: list[str]) -> DataFrame:
        # A full join of tables bucketed and sorted alike is a merge of sorted runs, without a shuffle.
        merged = self.spark.table(tables[0]).select("key", "n_docs", "owner")
        for t in tables[1:]:
            run = self.spark.table(t).select("key", F.col("n_docs").alias("__n"), F.col("owner").alias("__owner"))
            merged = merged.join(run, "key", "full_outer").select(
                "key",
                (F.coalesce("n_docs", F.lit(0)) + F.coalesce("__n", F.lit(0))).alias("n_docs"),
                F.coalesce("owner", "__owner").alias("owner"),
            )
        return merged

    def _compact(self, level: int, tables: list[str]) -> None:
        merged = self._write(self._merged(tables))
        for t in tables:
            self.spark.sql(f"DROP TABLE {t}")
        self.levels[level] = []
        if len(self.levels) == level + 1:
            self.levels.append([])
        self.levels[level + 1].append(merged)
        if len(self.levels[level + 1]) >= self.fan_in:
            self._compact(level + 1, self.levels[level + 1])

    def add(self, lines: DataFrame, give: bool = True) -> DataFrame | None:
        """Take in a batch's (doc_id, key); with ``give``, give the keys no earlier batch had: (key, n_docs, owner)."""
        arrived = lines.groupBy("key", "doc_id").agg(F.lit(1).alias("__one"))
        arrived = arrived.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("owner"))
        known = F.lit(False)
        for i, table in enumerate(self.tables()):
            run = self.spark.table(table).select(F.col("key").alias(f"__key{i}"))
            arrived = arrived.join(run, F.col("key") == F.col(f"__key{i}"), "left")
            known = known | F.col(f"__key{i}").isNotNull()
        # A row that meets no run is what an anti-join would give; the others only add their counts.
        rows = arrived.select("key", "n_docs", F.when(~known, F.col("owner")).alias("owner"), (~known).alias("fresh"))
        table = self._write(rows)
        if not self.levels:
            self.levels.append([])
        fresh = staged(self.spark.table(table).filter("fresh").drop("fresh"), "fresh-lines") if give else None
        self.levels[0].append(table)
        if len(self.levels[0]) >= self.fan_in:
            self._compact(0, self.levels[0])
        return fresh

    def totals(self) -> DataFrame:
        return self._merged(self.tables())

    def drop(self) -> None:
        for t in self.tables():
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
        self.levels = []


def batch_bounds(docs: DataFrame, id_column: str, batches: int) -> list[float]:
    """Ids that cut the documents into batches of about equal size."""
    found = docs.approxQuantile(id_column, [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    return sorted(set(found))


def dropped_keys(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", least_docs: int = LEAST_DOCS, batches: int = BATCHES
) -> DataFrame:
    """(doc_id, keys): the keys whose lines go, for every document that loses any."""
    bounds = batch_bounds(docs, id_column, batches)
    batch = reduce(lambda c, b: c + F.when(F.col("doc_id") >= b, 0).otherwise(1), bounds, F.lit(0))
    keys = staged(
        document_keys(docs, id_column, text).withColumn("batch", F.coalesce(batch, F.lit(len(bounds)))), "line-keys"
    )
    runs = LineRuns(docs.sparkSession)
    try:
        for i in range(len(bounds) + 1):
            runs.add(keys.filter(F.col("batch") == i).select("doc_id", "key"), give=False)
        return staged(_gone(keys, runs.totals(), least_docs), "dropped-lines")
    finally:
        runs.drop()


def _gone(keys: DataFrame, totals: DataFrame, least_docs: int) -> DataFrame:
    frequent = totals.filter(F.col("n_docs") >= least_docs).select(F.col("key").alias("__key"), "owner")
    # No document has more keys than lines.
    return (
        keys.join(frequent, F.col("key") == F.col("__key"))
        .filter(~F.col("doc_id").eqNullSafe(F.col("owner")))
        .groupBy(F.col("doc_id").alias("__doc"))
        .agg(F.collect_set("key").alias("__gone"))
    )


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns, ``text`` without the dropped lines, with n_lines (before) and n_dropped.

    Columns of the caller may have any names; only ones named n_lines or n_dropped are replaced. Ids are numbers.
    """
    gone = dropped_keys(docs, id_column, text)
    docs, back = aside(docs, ("__doc", "__gone"))
    # The same join at every size: merged, never one side sent to all.
    same = F.col(id_column).eqNullSafe(F.col("__doc"))
    joined = docs.drop("n_lines", "n_dropped").hint("merge").join(gone, same, "left").drop("__doc")
    place, last = joined.columns.index(text), len(joined.columns) - 1
    schema = joined.drop("__gone").schema.add("n_lines", "long").add("n_dropped", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for value, keys in zip(batch.column(place).to_pylist(), batch.column(last).to_pylist(), strict=True):
                lines = (value or "").split("\n")
                stay = lines
                if keys:
                    drop = set(keys)
                    stay = [x for x in lines if line_key(x.encode()) not in drop]
                kept.append("\n".join(stay))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            columns = list(batch.columns)[:last]
            columns[place] = pa.array(kept, columns[place].type)
            names = batch.schema.names[:last]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*names, "n_lines", "n_dropped"]
            )

    return joined.mapInArrow(run, schema).withColumnsRenamed(back)
