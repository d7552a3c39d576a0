"""The raw layer: landing, audit records, catalogue, checksums and statistics."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from merchweave.functions.scalars import human_size
from merchweave.sources.files import write_table

AUDIT_SCHEMA = (
    "source_name string, source string, destination string, ingested_at timestamp, row_count bigint, "
    "checksum string, status string, columns array<string>, column_count int, error string"
)


# Scheme and host of a path, and the slashes after them.
_STORE = "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*"


def row_digest(columns: list[str]) -> Column:
    """MD5 over a row's values, each with its length before it; a NULL has none, so no two rows read alike."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def table_checksum(columns: list[str]) -> Column:
    """Aggregate: checksum of a table that does not depend on row order or file layout.

    Both 64-bit halves of the rows' digests are summed, so that equal rows count as often as they occur.
    """
    digest = row_digest(columns)
    sums = [
        F.sum(F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").cast("string")
        for at in (1, 17)
    ]
    return F.concat_ws("-", *[F.coalesce(x, F.lit("0")) for x in sums])


def landing_path(root: str, source: str, data_type: str) -> str:
    return f"{root.rstrip('/')}/{source}/{data_type}"


def land(
    df: DataFrame, root: str, source: str, data_type: str = "table", ingest_date: str | None = None, origin: str = ""
) -> dict:
    """Write one source into its date partition and give its audit record.

    Row count and checksum are observed while the rows are written. A second run
    on the same date replaces that date only.
    """
    path = landing_path(root, source, data_type)
    observed = Observation(f"land-{source}")
    day = F.current_date() if ingest_date is None else F.lit(ingest_date).cast("date")
    out = df.observe(
        observed, F.count(F.lit(1)).alias("rows"), table_checksum(df.columns).alias("checksum")
    ).withColumn("ingest_date", day)
    write_table(out, path, "parquet", ["ingest_date"])
    facts = observed.get
    return audit_record(df, source, origin or path, path, facts["rows"], facts["checksum"], "SUCCESS", None)


def audit_record(df, source, origin, destination, rows, checksum, status, error) -> dict:
    columns = [] if df is None else df.columns
    return {
        "source_name": source,
        "source": origin,
        "destination": destination,
        "ingested_at": datetime.now(UTC).replace(tzinfo=None),
        "row_count": rows,
        "checksum": checksum,
        "status": status,
        "columns": columns,
        "column_count": len(columns),
        "error": error,
    }


def ingest_all(
    spark: SparkSession,
    sources: Mapping[str, Callable[[], DataFrame]],
    root: str,
    ingest_date: str | None = None,
    at_once: int = 4,
) -> DataFrame:
    """Land every source, a few at a time; one that fails is recorded and the others go on.

    Gives the audit table, one row per source.
    """

    def one(name: str) -> dict:
        try:
            return land(sources[name](), root, name, ingest_date=ingest_date)
        except Exception as problem:  # noqa: BLE001 - any failure of one source is recorded
            return audit_record(None, name, "", "", 0, None, "FAILED", str(problem))

    with ThreadPoolExecutor(at_once) as pool:
        records = list(pool.map(inheritable_thread_target(one), sources))
    return spark.createDataFrame(
        [tuple(r[f.split()[0]] for f in AUDIT_SCHEMA.split(", ")) for r in records], AUDIT_SCHEMA
    )


def run_summary(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "SUCCESS").alias("success"),
        F.count_if(F.col("status") != "SUCCESS").alias("failed"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows_ingested"),
    )


def read_landed(spark: SparkSession, root: str, source: str, data_type: str = "table") -> DataFrame:
    return spark.read.parquet(landing_path(root, source, data_type))


def lake_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Every file under the layer, with source, type and date from its path.

    Only the listing is read; file contents are never loaded. Paths are cut after the root's own path, whatever
    store the root names or leaves to the default.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", F.col("length").alias("size_bytes"), "modificationTime")
    )
    base = re.sub(_STORE, "/", root).rstrip("/") + "/"
    parts = F.split("relative_path", "/")
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.substring(F.regexp_replace("path", _STORE, "/"), len(base) + 1, 1 << 20).alias("relative_path"),
        "size_bytes",
    ).select(
        "file_name",
        "relative_path",
        F.coalesce(F.get(parts, F.lit(0)), F.lit("unknown")).alias("source_name"),
        F.when(F.size(parts) > 2, F.get(parts, F.lit(1))).otherwise("unknown").alias("data_type"),
        F.when(F.size(parts) > 3, F.regexp_replace(F.get(parts, F.lit(2)), "^ingest_date=", "")).otherwise("unknown").alias("partition_date"),
        "size_bytes",
        human_size(F.col("size_bytes")).alias("size_human"),
        F.col("file_name").endswith(".meta.json").alias("is_metadata"),
    )


def write_sidecars(audit: DataFrame, root: str) -> None:
    """Audit records as JSON files of their own."""
    audit.write.mode("append").json(f"{root.rstrip('/')}/_audit")


def read_sidecars(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).json(f"{root.rstrip('/')}/_audit")


def with_audit(catalog: DataFrame, audit: DataFrame) -> DataFrame:
    """Files of the catalogue with the audit record of their source."""
    latest = audit.groupBy("source_name").agg(
        F.max_by(F.struct("row_count", "checksum", "status"), "ingested_at").alias("audit")
    )
    return catalog.join(latest, "source_name", "left")


def verify_checksums(tables: Mapping[str, DataFrame], audit: DataFrame) -> DataFrame:
    """Recompute the checksum of each landed table: verified, mismatched, or skipped without a record.

    Tables are matched by their full source name.
    """
    parts = None
    for name, df in tables.items():
        columns = [c for c in df.columns if c != "ingest_date"]
        one = df.agg(F.count("*").alias("actual_rows"), table_checksum(columns).alias("actual_checksum")).withColumn(
            "source_name", F.lit(name)
        )
        parts = one if parts is None else parts.unionByName(one)
    expected = audit.filter(F.col("checksum").isNotNull()).groupBy("source_name").agg(
        F.max_by("checksum", "ingested_at").alias("expected_checksum")
    )
    return parts.join(expected, "source_name", "left").withColumn(
        "result",
        F.when(F.col("expected_checksum").isNull(), F.lit("skipped"))
        .when(F.col("expected_checksum") == F.col("actual_checksum"), F.lit("verified"))
        .otherwise(F.lit("mismatched")),
    )


def lake_stats(catalog: DataFrame, audit: DataFrame | None = None) -> DataFrame:
    """Files and bytes in all, by source and by type, with the rows on record per source."""
    stats = (
        catalog.groupingSets(
            [[], ["source_name"], ["data_type"]], "source_name", "data_type"
        )
        .agg(
            F.grouping_id().alias("_level"),
            F.count("*").alias("files"),
            F.count_if(F.col("is_metadata")).alias("metadata_files"),
            F.sum("size_bytes").alias("size_bytes"),
            F.count_distinct("partition_date").alias("n_partitions"),
        )
        .withColumn("size_human", human_size(F.col("size_bytes")))
        .withColumn(
            "scope", F.when(F.col("_level") == 3, "total").when(F.col("_level") == 1, "source").otherwise("type")
        )
        .withColumn("name", F.coalesce("source_name", "data_type", F.lit("all")))
        .drop("_level", "source_name", "data_type")
    )
    if audit is None:
        return stats
    rows = audit.groupBy(F.col("source_name").alias("name")).agg(F.max("row_count").alias("max_rows"))
    rows = rows.withColumn("scope", F.lit("source"))
    return stats.join(rows, ["scope", "name"], "left")
