"""Incremental ingest and running counts over the event files, with Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchweave.sources.files import write_table
from merchweave.sources.lake import AUDIT_SCHEMA, audit_record, landing_path, table_checksum

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def event_stream(spark: SparkSession, folder: str, pattern: str = "events*.parquet") -> DataFrame:
    """New event files of a folder. Event time is a timestamp with zone, as watermarks need."""
    raw = spark.readStream.schema(EVENTS).option("pathGlobFilter", pattern).parquet(folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def ingest(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append everything not seen yet to the raw layer, then stop.

    The checkpoint remembers the files already read, so a file that has not
    changed is not read again.
    """
    drain(stream.withColumn("ingest_date", F.to_date("ts")), target, checkpoint)


def land_stream(stream: DataFrame, root: str, source: str, checkpoint: str, date: str = "ts") -> None:
    """Land everything not seen yet in the raw layer, one folder per date and batch, with one audit row per batch.

    Rows and checksum are observed while a batch is written. A batch that is run again writes the folders of
    its own number only, data and audit row alike, so it replaces both; its audit row comes last.
    """
    path = landing_path(root, source, "stream")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        observed = Observation(f"land-{source}-{batch_id}-{uuid.uuid4().hex}")
        seen = batch.observe(
            observed, F.count(F.lit(1)).alias("rows"), table_checksum(batch.columns).alias("checksum")
        )
        dated = seen.withColumns({"ingest_date": F.to_date(date), "batch_id": F.lit(batch_id)})
        write_table(dated, path, "parquet", ["ingest_date", "batch_id"])
        facts = observed.get
        row = audit_record(batch, source, source, path, facts["rows"], facts["checksum"], "SUCCESS", None)
        audit = spark.createDataFrame([tuple(row[f.split()[0]] for f in AUDIT_SCHEMA.split(", "))], AUDIT_SCHEMA)
        audit.coalesce(1).write.mode("overwrite").json(f"{_stream_audit(root, source)}/batch_id={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_stream_audit(spark: SparkSession, root: str, source: str) -> DataFrame:
    """One audit row per batch landed."""
    return spark.read.schema(AUDIT_SCHEMA + ", batch_id bigint").json(_stream_audit(root, source))


def _stream_audit(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/_stream_audit/{source}"


def windowed_counts(stream: DataFrame, window: str = "1 day", lateness: str = "1 hour") -> DataFrame:
    """Events and their value per window and type; state older than the lateness is dropped."""
    return (
        stream.withWatermark("ts", lateness)
        .groupBy(F.window("ts", window), "event_type")
        .agg(F.count("*").alias("n_events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value"))
        .select(F.col("window.start").alias("window_start"), "event_type", "n_events", "total_value")
    )


def without_repeats(stream: DataFrame, key: str = "event_id", lateness: str = "1 hour") -> DataFrame:
    """Each event once, though it may be delivered again within the lateness."""
    return stream.withWatermark("ts", lateness).dropDuplicatesWithinWatermark([key])


def drain(df: DataFrame, target: str, checkpoint: str, output_mode: str = "append") -> None:
    """Run a streaming frame over all files available, one folder of results per batch.

    A batch that is run again replaces its folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(target)

    query = (
        df.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def newest_version(updates: DataFrame, key: list[str]) -> DataFrame:
    """Last update of each key from the results of an update-mode stream."""
    rest = [c for c in updates.columns if c not in key and c != "batch_id"]
    return (
        updates.groupBy(*key)
        .agg(F.max_by(F.struct(*rest), "batch_id").alias("_v"))
        .select(*key, *[F.col(f"_v.{c}") for c in rest])
    )
