"""Scans, payload shaping, partition choice, sampling and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchweave.functions.selection import first_by_hash

# How files are opened when their own schema is asked for.
READ_OPTIONS = {"csv": {"header": "true", "inferSchema": "true"}}


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """Typed CSV scan. ``multi_line`` is for tables with line breaks inside quoted text;
    such files cannot be split, so leave it off for the others."""
    return spark.read.schema(schema).csv(
        path, header=True, multiLine=multi_line, quote='"', escape='"', mode="PERMISSIVE"
    )


def flattened(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested objects as top-level columns named by their path."""

    def leaves(schema: T.StructType, column: Column | None, path: str) -> list[Column]:
        out = []
        for f in schema:
            child = F.col(f"`{f.name}`") if column is None else column.getField(f.name)
            name = f"{path}{separator}{f.name}" if path else f.name
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, child, name)
            else:
                out.append(child.alias(name))
        return out

    return df.select(*leaves(df.schema, None, ""))


def read_payload(spark: SparkSession, path: str, endpoint: str) -> DataFrame:
    """One JSON response as a table: objects flattened, a plain list as one column
    named after the endpoint, anything else as ``value``."""
    whole = spark.read.text(path, wholetext=True)
    head = whole.select(F.regexp_extract("value", r"^\s*(\[?)\s*(.?)", 1), F.regexp_extract("value", r"^\s*(\[?)\s*(.?)", 2)).first()
    is_list, start = (head[0] == "[", head[1]) if head else (False, "")
    if start == "{":
        return flattened(spark.read.json(path, multiLine=True))
    if is_list:
        return whole.select(F.explode(F.from_json("value", "array<string>")).alias(endpoint))
    return whole.select(F.trim(F.regexp_replace("value", r'^\s*"|"\s*$', "")).alias("value"))


def payload_rows(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """(source_file, shape, position, value) of JSON responses, the shape decided for each by itself.

    ``shape`` is ``objects`` (a list that begins with an object), ``list``, ``object``, ``scalar`` or ``text`` (not
    JSON, kept as a string; NULL counts as such). A list gives a row per element, an empty one none; ``value`` is a
    VARIANT. Responses are whole files, or lines with ``whole_files`` off.
    """
    raw = spark.read.text(path, wholetext=whole_files).withColumn("source_file", F.col("_metadata.file_path"))
    parsed = raw.withColumn("_v", F.try_parse_json("value"))
    kind = F.schema_of_variant("_v")
    first = F.schema_of_variant(F.try_variant_get("_v", "$[0]", "variant"))
    shape = (
        F.when(F.col("_v").isNull(), "text")
        .when(kind.startswith("ARRAY") & F.coalesce(first.startswith("OBJECT"), F.lit(False)), "objects")
        .when(kind.startswith("ARRAY"), "list")
        .when(kind.startswith("OBJECT"), "object")
        .otherwise("scalar")
    )
    single = F.coalesce("_v", F.col("value").cast("variant"))
    values = F.when(F.col("_shape").isin("objects", "list"), F.try_variant_get("_v", "$", "array<variant>")).otherwise(
        F.array(single)
    )
    return parsed.withColumn("_shape", shape).select(
        "source_file", F.col("_shape").alias("shape"), F.posexplode(values).alias("position", "value")
    )


def payload_table(rows: DataFrame, endpoint: str) -> DataFrame:
    """Payload rows as one table: objects flattened over all their fields, other elements of lists in a column
    named after the endpoint, single values in ``value``.

    The fields are those of all objects; the driver gets their schema as one text. A field with types that have
    none in common stays a VARIANT. A column for a kind of payload that does not occur is left out.
    """
    kinds = rows.withColumn(
        "_kind",
        F.when(F.schema_of_variant("value").startswith("OBJECT"), "object")
        .when(F.col("shape").isin("objects", "list"), "element")
        .otherwise("single"),
    )
    objects, element, single = (F.col("_kind") == k for k in ("object", "element", "single"))
    found = kinds.agg(
        F.schema_of_variant_agg(F.when(objects, F.col("value"))).alias("fields"),
        F.max(element).alias("elements"),
        F.max(single).alias("singles"),
    ).first()
    out = kinds.withColumnRenamed("value", "_v")
    for name, wanted, there in ((endpoint, element, found.elements), ("value", single, found.singles)):
        if there:
            out = out.withColumn(name, F.when(wanted, F.try_variant_get("_v", "$", "string")))
    if not (found.fields or "").startswith("OBJECT<"):
        return out.drop("_v", "_kind")
    fields = found.fields.replace("OBJECT<", "STRUCT<")
    wide = flattened(out.withColumn("_v", F.when(objects, F.try_variant_get("_v", "$", fields))).drop("_kind"))
    return wide.withColumnsRenamed({c: c.removeprefix("_v.") for c in wide.columns})


def parse_json_column(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A JSON text column parsed and flattened in place."""
    return flattened(df.withColumn(column, F.from_json(column, schema)))


def latest_partition(df: DataFrame, column: str = "ingest_date") -> DataFrame:
    """Rows of the newest partition. The scalar subquery prunes the scan to one folder."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def latest_or_source(landed: DataFrame | None, source: DataFrame, column: str = "ingest_date") -> DataFrame:
    """The newest landed rows, or the source if nothing has been landed."""
    if landed is None or landed.limit(1).isEmpty():
        return source
    return latest_partition(landed, column).drop(column)


def hash_order(key: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows in a seeded random order, for samples of any size; all rows if there are fewer."""
    return first_by_hash(df.withColumn("_hash", hash_order(key, seed)), "_hash", key, n).drop("_hash")


def sample_percent(df: DataFrame, percent: float, key: Sequence[str], seed: int = 42) -> DataFrame:
    """max(1, round(rows * percent / 100)) rows."""
    rows = df.agg(F.greatest(F.lit(1), F.rint(F.count("*") * F.lit(percent) / 100).cast("long"))).first()[0]
    return sample_rows(df, rows, key, seed)


def first_ids(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    return df.select(column).distinct().orderBy(column).limit(n)


def rows_for_ids(df: DataFrame, column: str, ids: Sequence | DataFrame) -> DataFrame:
    """Rows whose id is in a short list or in a table of ids."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(column).distinct(), column, "left_semi")
    return df.filter(F.col(column).isin(list(ids)))


def resolve_category_column(columns: Sequence[str]) -> str:
    """The category column to use, translated names first."""
    for name in ("category_english", "product_category_name_english", "product_category_name"):
        if name in columns:
            return name
    raise ValueError("no category column")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path``; with partitions, only those present in ``df``."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)


def register_tables(tables: dict[str, DataFrame]) -> None:
    """Offer frames to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def save_tables(tables: dict[str, DataFrame]) -> None:
    """Replace catalogue tables."""
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(name)


def file_schemas(spark: SparkSession, path: str, fmt: str = "parquet", threads: int = 16) -> dict[str, T.StructType]:
    """The schema each file of a table has by itself, read from its own footer or header before any is declared.

    Only names and types come to the driver, one small read per file, several at a time.
    """
    files = sorted(spark.read.format(fmt).options(**READ_OPTIONS.get(fmt, {})).load(path).inputFiles())

    def schema(file: str) -> T.StructType:
        return spark.read.format(fmt).options(**READ_OPTIONS.get(fmt, {})).load(file).schema

    with ThreadPoolExecutor(threads) as pool:
        return dict(zip(files, pool.map(schema, files), strict=True))


def file_sizes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """(file_path, n_rows) of every file of a table that has rows."""
    rows = spark.read.format(fmt).options(**READ_OPTIONS.get(fmt, {})).load(path)
    return rows.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("n_rows"))
