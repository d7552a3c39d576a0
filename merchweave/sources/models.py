"""Published models: tables and metrics under a version, found by model name."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSIONS = "model string, version string, published_at timestamp, tables array<string>, metrics map<string, double>"


def _path(root: str, model: str, version: str) -> str:
    for part in (model, version):
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", part):
            raise ValueError(f"{part!r} names no model or version: letters, digits, dot, dash and underscore only")
    return f"{root.rstrip('/')}/{model}/version={version}"


def publish(
    spark: SparkSession,
    root: str,
    model: str,
    version: str,
    tables: Mapping[str, DataFrame],
    metrics: Mapping[str, float] | None = None,
    at: datetime | None = None,
) -> None:
    """Write a version's tables, then the one row that makes it visible.

    A run that fails before the last write leaves no version, and may be repeated: tables and row replace those
    of an earlier try.
    """
    path = _path(root, model, version)
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    row = (model, version, at or datetime.now(UTC), sorted(tables), {k: float(v) for k, v in (metrics or {}).items()})
    published = spark.createDataFrame([row], VERSIONS).coalesce(1)
    published.write.mode("overwrite").json(f"{root.rstrip('/')}/_versions/{model}/{version}")


def versions(spark: SparkSession, root: str) -> DataFrame:
    """One row per published version."""
    return spark.read.schema(VERSIONS).option("recursiveFileLookup", True).json(f"{root.rstrip('/')}/_versions")


def latest(spark: SparkSession, root: str) -> DataFrame:
    """The version of each model published last; of equal times the larger name."""
    rows = versions(spark, root)
    newest = F.max_by(F.struct("version", "published_at", "tables", "metrics"), F.struct("published_at", "version"))
    return rows.groupBy("model").agg(newest.alias("_v")).select("model", "_v.*")


def load(spark: SparkSession, root: str, model: str, table: str, version: str | None = None) -> DataFrame:
    """A published table, of the latest version unless one is named, with the version as ``model_version``."""
    found = latest(spark, root) if version is None else versions(spark, root).filter(F.col("version") == version)
    row = found.filter(F.col("model") == model).first()
    if row is None:
        raise ValueError(f"no published version of model {model!r}" + (f" called {version!r}" if version else ""))
    if table not in row.tables:
        raise ValueError(f"version {row.version} of model {model!r} has no table {table!r}")
    return spark.read.parquet(f"{_path(root, model, row.version)}/{table}").withColumn("model_version", F.lit(row.version))
