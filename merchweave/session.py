"""Session settings and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every operator relies on. All are runtime SQL settings, so they can
# be applied to a session somebody else built.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # One order, product or user may hold a large share of the rows. Split its
    # partition even where that costs one more shuffle after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "merchweave", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's checkpoint folder.

    A machine-local folder is used only for a local master with no folder set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="merchweave-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder, with the writer's options, and read it back.

    Used where a result is read several times, or where rows carry a partition
    number that must not change if an executor is lost and a stage is rerun.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/merchweave/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, name: str, placed: bool = False) -> DataFrame:
    """As ``staged``, in as many buckets of ``key`` as a shuffle has partitions: joins on ``key`` need no shuffle.

    With ``placed`` the rows are written where they stand, for tasks that hold one bucket each.
    """
    spark, n = df.sparkSession, partitions(df.sparkSession)
    table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    rows = df if placed else df.repartition(n, key)
    path = f"{shared_dir(spark)}/merchweave/{table}"
    rows.write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)


def discard(df: DataFrame) -> None:
    """Delete a table that ``staged`` or ``bucketed`` wrote, once nothing will read it any more."""
    spark = df.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if "/merchweave/" not in folder:
            raise ValueError(f"{folder} is no staged table")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        spark.sql(f"DROP TABLE IF EXISTS `{folder.rsplit('/', 1)[1]}`")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """For what runs inside the block at most ``rows`` rows travel to a Python worker at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
