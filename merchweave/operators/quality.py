"""Validation checks and column profiles.

Every check returns rows (table_name, check_name, severity, violations, detail),
so the checks of all tables are one union that Spark runs side by side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchweave.functions.ordering import exact_medians
from merchweave.functions.scalars import round_half_even
from merchweave.sources import files

PASS, WARNING, ERROR = "PASS", "WARNING", "ERROR"


@dataclass(frozen=True)
class Expectation:
    """What a source table should look like."""

    columns: Sequence[str]
    unique: Sequence[str] = ()
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    allowed: Mapping[str, Sequence[str]] = field(default_factory=dict)


# Expectations for the shop's nine source tables.
EXPECTATIONS = {
    "customers": Expectation(
        ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
        unique=["customer_id"],
    ),
    "products": Expectation(
        [
            "product_id",
            "product_category_name",
            "product_name_lenght",
            "product_description_lenght",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ],
        unique=["product_id"],
        ranges={
            "product_photos_qty": (0, 50),
            "product_weight_g": (0, 200000),
            "product_length_cm": (0, 200),
            "product_height_cm": (0, 200),
            "product_width_cm": (0, 200),
        },
    ),
    "orders": Expectation(
        [
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ],
        unique=["order_id"],
        allowed={
            "order_status": [
                "delivered",
                "shipped",
                "canceled",
                "unavailable",
                "invoiced",
                "processing",
                "created",
                "approved",
            ]
        },
    ),
    "order_items": Expectation(
        ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
        ranges={"price": (0, 100000), "freight_value": (0, 10000), "order_item_id": (1, 50)},
    ),
    "reviews": Expectation(
        [
            "review_id",
            "order_id",
            "review_score",
            "review_comment_title",
            "review_comment_message",
            "review_creation_date",
            "review_answer_timestamp",
        ],
        ranges={"review_score": (1, 5)},
    ),
    "payments": Expectation(
        ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
        ranges={"payment_value": (0, 100000), "payment_installments": (0, 30)},
        allowed={"payment_type": ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]},
    ),
    "sellers": Expectation(
        ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"], unique=["seller_id"]
    ),
    "geolocation": Expectation(
        [
            "geolocation_zip_code_prefix",
            "geolocation_lat",
            "geolocation_lng",
            "geolocation_city",
            "geolocation_state",
        ],
        ranges={"geolocation_lat": (-90, 90), "geolocation_lng": (-180, 180)},
    ),
    "categories": Expectation(
        ["product_category_name", "product_category_name_english"], unique=["product_category_name"]
    ),
}


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _schema_issues(df: DataFrame, expected: Sequence[str]) -> list[tuple[str, str, int, str]]:
    missing = sorted(set(expected) - set(df.columns))
    extra = sorted(set(df.columns) - set(expected))
    issues = []
    if missing:
        issues.append(("schema_missing_columns", ERROR, len(missing), ", ".join(missing)))
    if extra:
        issues.append(("schema_extra_columns", WARNING, len(extra), ", ".join(extra)))
    return issues or [("schema_match", PASS, 0, "")]


def check_schema(df: DataFrame, table: str, expected: Sequence[str]) -> DataFrame:
    """Missing columns are an ERROR, extra ones a WARNING; one PASS row if there are neither."""
    entries = [_entry(name, level, F.lit(n), F.lit(detail)) for name, level, n, detail in _schema_issues(df, expected)]
    return df.sparkSession.range(1).select(F.lit(table).alias("table_name"), F.inline(F.array(*entries)))


def schema_differences(actual: T.StructType, expected: T.StructType) -> list[tuple[str, str, int, str]]:
    """(check, severity, violations, detail): columns that are missing, extra or of another type; one PASS if none.

    A renamed column is one missing and one extra. Nullability does not count.
    """
    have = {f.name: f.dataType.simpleString() for f in actual}
    want = {f.name: f.dataType.simpleString() for f in expected}
    missing, extra = sorted(set(want) - set(have)), sorted(set(have) - set(want))
    retyped = [f"{c}: {have[c]} instead of {want[c]}" for c in sorted(set(have) & set(want)) if have[c] != want[c]]
    found = [
        ("schema_missing_columns", ERROR, len(missing), ", ".join(missing)),
        ("schema_extra_columns", WARNING, len(extra), ", ".join(extra)),
        ("schema_types", ERROR, len(retyped), ", ".join(retyped)),
    ]
    return [x for x in found if x[2]] or [("schema_match", PASS, 0, "")]


def check_files(spark: SparkSession, tables: Mapping[str, str], expected: Mapping[str, T.StructType], fmt: str = "parquet") -> DataFrame:
    """Every file of every table against the expected schema, with the rows it holds.

    ``tables`` gives each table's path. (table_name, file_name, check_name, severity, violations, detail, n_rows): one
    row per difference and file, or one PASS row per file. A table that cannot be opened is an ERROR without a file.
    """
    # Spark writes one path with one slash behind the scheme here and with three there.
    same_path = F.regexp_replace("file_path", r"^(\w+):/+", "$1:/")
    parts = []
    for table, path in tables.items():
        try:
            schemas = files.file_schemas(spark, path, fmt)
        except AnalysisException as broken:
            rows = [(None, "schema_unreadable", ERROR, 1, str(broken.getCondition()))]
            sizes = None
        else:
            rows = [(f, *d) for f, schema in schemas.items() for d in schema_differences(schema, expected[table])]
            sizes = files.file_sizes(spark, path, fmt).withColumn("file_path", same_path)
        found = spark.createDataFrame(
            rows, "file_path string, check_name string, severity string, violations long, detail string"
        ).withColumns({"table_name": F.lit(table), "file_path": same_path})
        counted = found.withColumn("n_rows", F.lit(0).cast("long")) if sizes is None else found.join(sizes, "file_path", "left")
        parts.append(counted)
    name = F.element_at(F.split("file_path", "/"), -1)
    return union_all(parts).select(
        "table_name",
        name.alias("file_name"),
        "check_name",
        "severity",
        "violations",
        "detail",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )


def _entry(check: str, severity: str, violations: Column, detail: Column | None = None) -> Column:
    """One check as a struct; it passes if there are no violations."""
    n = violations.cast("long")
    return F.struct(
        F.lit(check).alias("check_name"),
        F.when(n > 0, F.lit(severity)).otherwise(F.lit(PASS)).alias("severity"),
        n.alias("violations"),
        (F.lit("") if detail is None else detail).alias("detail"),
    )


def _range_detail(below: Column, above: Column) -> Column:
    return F.concat(below.cast("string"), F.lit(" below, "), above.cast("string"), F.lit(" above"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage; 0 for an empty whole."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double")) * 100
    return F.coalesce(round_half_even(ratio, digits), F.lit(0.0))


def missing_values(df: DataFrame, table: str) -> DataFrame:
    """Missing and present share of every column, from one pass over the table."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    long = counts.unpivot(["_rows"], df.columns, "column_name", "_present")
    gone = F.col("_rows") - F.col("_present")
    return long.select(
        F.lit(table).alias("table_name"),
        "column_name",
        gone.alias("missing_count"),
        percent(gone, F.col("_rows")).alias("missing_pct"),
        percent(F.col("_present"), F.col("_rows")).alias("completeness_pct"),
    )


def completeness(df: DataFrame, table: str) -> DataFrame:
    """Share of filled cells of the whole table."""
    counts = df.agg(F.count("*").alias("n_rows"), *[F.count(c).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    present = reduce(Column.__add__, [F.col(f"_c{i}") for i in range(len(df.columns))])
    cells = F.col("n_rows") * len(df.columns)
    return counts.select(
        F.lit(table).alias("table_name"),
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        (cells - present).alias("missing_cells"),
        percent(present, cells).alias("completeness_pct"),
    )


def _check(df: DataFrame, table: str, check: str, severity: str, violations: Column) -> DataFrame:
    return df.select(F.lit(table).alias("table_name"), F.inline(F.array(_entry(check, severity, violations))))


def check_full_duplicates(df: DataFrame, table: str) -> DataFrame:
    """Rows beyond the first of each set of equal rows; NULLs count as equal."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    total = copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_dupes"))
    return _check(total, table, "full_row_duplicates", WARNING, F.col("_dupes"))


def check_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values beyond the first of each key; NULL is one value."""
    copies = df.groupBy(column).agg(F.count("*").alias("_n"))
    total = copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_dupes"))
    return _check(total, table, f"duplicate_key_{column}", ERROR, F.col("_dupes"))


def check_ranges(df: DataFrame, table: str, ranges: Mapping[str, tuple[float, float]]) -> DataFrame | None:
    """Values outside inclusive bounds; text that is no number and NULL are ignored."""
    ranges = {c: r for c, r in ranges.items() if c in df.columns}
    if not ranges:
        return None
    counts = []
    for c, (low, high) in ranges.items():
        value = F.col(c).try_cast("double")
        counts += [F.count_if(value < low).alias(f"{c}_below"), F.count_if(value > high).alias(f"{c}_above")]
    checks = []
    for c in ranges:
        below, above = F.col(f"{c}_below"), F.col(f"{c}_above")
        checks.append(_entry(f"range_{c}", ERROR, below + above, _range_detail(below, above)))
    return df.agg(*counts).select(F.lit(table).alias("table_name"), F.inline(F.array(*checks)))


def unexpected_values(df: DataFrame, table: str, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Each value outside the allowed set, with its rows. One row per value, however many there are."""
    parts = [
        df.filter(F.col(c).isNotNull() & ~F.col(c).isin(list(values)))
        .groupBy(F.col(c).cast("string").alias("unexpected_value"))
        .agg(F.count("*").alias("n_rows"))
        .select(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), "unexpected_value", "n_rows")
        for c, values in allowed.items()
        if c in df.columns
    ]
    if not parts:
        return df.sparkSession.createDataFrame(
            [], "table_name string, column_name string, unexpected_value string, n_rows bigint"
        )
    return union_all(parts)


def check_allowed(df: DataFrame, table: str, allowed: Mapping[str, Sequence[str]]) -> DataFrame | None:
    """Number of distinct values outside the allowed set."""
    parts = []
    for c, values in allowed.items():
        if c in df.columns:
            extra = unexpected_values(df, table, {c: values}).agg(F.count("*").alias("_n"))
            parts.append(_check(extra, table, f"allowed_values_{c}", WARNING, F.col("_n")))
    return union_all(parts) if parts else None


def profile_columns(df: DataFrame, table: str) -> DataFrame:
    """(table_name, column_name, dtype, non_null, null_count) of every column, of any type, in one pass."""
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.count(F.col(f"`{f.name}`")).alias("non_null"),
            F.count_if(F.col(f"`{f.name}`").isNull()).alias("null_count"),
        )
        for f in df.schema
    ]
    return df.agg(F.array(*rows).alias("_rows")).select(F.lit(table).alias("table_name"), F.inline("_rows"))


def profile_numeric(df: DataFrame, table: str) -> DataFrame:
    """Range, mean, sample deviation and exact median of every numeric column."""
    columns = numeric_columns(df)
    stats = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.count(c).alias("non_null"),
                    (F.count("*") - F.count(c)).alias("null_count"),
                    F.min(F.col(c).cast("double")).alias("min"),
                    F.max(F.col(c).cast("double")).alias("max"),
                    round_half_even(F.avg(F.col(c).cast("double")), 2).alias("mean"),
                    round_half_even(F.stddev_samp(F.col(c).cast("double")), 2).alias("std"),
                )
                for c in columns
            ]
        ).alias("_columns")
    ).select(F.inline("_columns"))
    medians = exact_medians(df, columns).select("column_name", round_half_even(F.col("median"), 2).alias("median"))
    return stats.join(medians, "column_name", "left").withColumn("table_name", F.lit(table))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def profile_categorical(df: DataFrame, table: str, top: int = 5) -> DataFrame:
    """Distinct values and the most frequent ones of every text column; ties by value."""
    columns = text_columns(df)
    long = df.select(*columns).unpivot([], columns, "column_name", "value").filter(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    unique = counts.groupBy("column_name").agg(F.count("*").alias("unique_count"))
    order = W.partitionBy("column_name").orderBy(F.desc("n"), "value")
    best = counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)
    return best.join(unique, "column_name").withColumn("table_name", F.lit(table))


def table_facts(df: DataFrame | None, table: str, expected: Expectation, spark: SparkSession) -> DataFrame:
    """One row per table: size, missing cells and all checks as an array.

    The table is read once. Equal rows are counted first, which the duplicate
    check needs anyway; every other fact is a sum or a distinct count over the
    distinct rows. A missing table is one ERROR.
    """
    if df is None:
        checks = F.array(_entry("table_missing", ERROR, F.lit(1)))
        return spark.range(1).select(
            F.lit(table).alias("table_name"),
            F.lit(0).cast("long").alias("n_rows"),
            F.lit(0).alias("n_columns"),
            F.lit(0).cast("long").alias("missing_cells"),
            checks.alias("checks"),
        )
    names = [f"_c{i}" for i in range(len(df.columns))]
    at = dict(zip(df.columns, names, strict=True))
    copies = df.toDF(*names).groupBy(*names).agg(F.count("*").alias("_n"))
    n = F.col("_n")

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    unique = [c for c in expected.unique if c in at]
    ranges = {c: r for c, r in expected.ranges.items() if c in at}
    allowed = {c: v for c, v in expected.allowed.items() if c in at}
    facts = [F.coalesce(F.sum(n), F.lit(0)).alias("_rows"), F.count("*").alias("_distinct")]
    missing = reduce(Column.__add__, [F.col(c).isNull().cast("long") for c in names])
    facts.append(F.coalesce(F.sum(missing * n), F.lit(0)).alias("_missing"))
    for c in unique:
        key = F.col(at[c])
        values = F.count_distinct(key) + F.coalesce(F.max(key.isNull().cast("long")), F.lit(0))
        facts.append(values.alias(f"_keys{at[c]}"))
    for c, (low, high) in ranges.items():
        value = F.col(at[c]).try_cast("double")
        facts += [rows_where(value < low).alias(f"_below{at[c]}"), rows_where(value > high).alias(f"_above{at[c]}")]
    for c, values in allowed.items():
        value = F.col(at[c])
        facts.append(F.count_distinct(F.when(~value.isin(list(values)), value)).alias(f"_extra{at[c]}"))
    row = copies.agg(*facts)
    checks = [_entry(name, severity, F.lit(count), F.lit(detail)) for name, severity, count, detail in _schema_issues(df, expected.columns)]
    checks.append(_entry("full_row_duplicates", WARNING, F.col("_rows") - F.col("_distinct")))
    checks += [_entry(f"duplicate_key_{c}", ERROR, F.col("_rows") - F.col(f"_keys{at[c]}")) for c in unique]
    for c in ranges:
        below, above = F.col(f"_below{at[c]}"), F.col(f"_above{at[c]}")
        checks.append(_entry(f"range_{c}", ERROR, below + above, _range_detail(below, above)))
    checks += [_entry(f"allowed_values_{c}", WARNING, F.col(f"_extra{at[c]}")) for c in allowed]
    return row.select(
        F.lit(table).alias("table_name"),
        F.col("_rows").cast("long").alias("n_rows"),
        F.lit(len(names)).alias("n_columns"),
        F.col("_missing").cast("long").alias("missing_cells"),
        F.array(*checks).alias("checks"),
    )


def facts_of(
    tables: Mapping[str, DataFrame | None], expectations: Mapping[str, Expectation], spark: SparkSession
) -> DataFrame:
    return union_all([table_facts(tables.get(name), name, spec, spark) for name, spec in expectations.items()])


def validate(
    tables: Mapping[str, DataFrame | None], expectations: Mapping[str, Expectation], spark: SparkSession
) -> DataFrame:
    """All checks of all tables, one row each."""
    return facts_of(tables, expectations, spark).select("table_name", F.inline("checks"))


def worst_severity(severity: Column) -> Column:
    """Aggregate: the worst of a group of severities."""
    code = F.max(F.when(severity == ERROR, 2).when(severity == WARNING, 1).otherwise(0))
    return F.when(code == 2, F.lit(ERROR)).when(code == 1, F.lit(WARNING)).otherwise(F.lit(PASS))


def table_status(checks: DataFrame) -> DataFrame:
    return checks.groupBy("table_name").agg(worst_severity(F.col("severity")).alias("overall_status"))


def quality_summary(facts: DataFrame) -> DataFrame:
    """One row per table: size, completeness, duplicates, checks by severity and status."""

    def having(severity: str) -> Column:
        return F.size(F.filter("checks", lambda c: c["severity"] == severity)).cast("long")

    dupes = F.filter("checks", lambda c: c["check_name"] == "full_row_duplicates")
    cells = F.col("n_rows") * F.col("n_columns")
    return facts.select(
        "table_name",
        F.get(dupes, F.lit(0))["violations"].alias("full_duplicates"),
        having(PASS).alias("n_pass"),
        having(WARNING).alias("n_warning"),
        having(ERROR).alias("n_error"),
        F.when(having(ERROR) > 0, F.lit(ERROR)).when(having(WARNING) > 0, F.lit(WARNING)).otherwise(F.lit(PASS)).alias("overall_status"),
        "n_rows",
        "n_columns",
        percent(cells - F.col("missing_cells"), cells).alias("completeness_pct"),
    )


def open_issues(checks: DataFrame) -> DataFrame:
    return checks.filter(F.col("severity") != PASS)


class QualityGateError(RuntimeError):
    """``issues`` is the whole table of failing checks."""

    def __init__(self, message: str, issues: DataFrame):
        super().__init__(message)
        self.issues = issues


def quality_gate(checks: DataFrame) -> None:
    """Stop the pipeline if a check ended in ERROR, naming every failing check and their number."""
    errors = checks.filter(F.col("severity") == ERROR)
    # One row per table and check of the expectations, however large the tables.
    found = errors.select("table_name", "check_name").collect()
    if found:
        names = "; ".join(f"{r.table_name}: {r.check_name}" for r in found)
        raise QualityGateError(f"{len(found)} failing: {names}", errors)


def constraint_checks(
    tables: Mapping[str, DataFrame],
    primary_keys: Mapping[str, Sequence[str]],
    foreign_keys: Sequence[tuple[str, str, str, str]],
    not_null: Mapping[str, Sequence[str]],
) -> DataFrame:
    """Declared keys and NOT NULL columns as checks: violations per constraint."""
    parts = []
    for name, key in primary_keys.items():
        repeated = tables[name].groupBy(*key).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
        parts.append(
            _check(repeated.agg(F.count("*").alias("_v")), name, "primary_key_" + "_".join(key), ERROR, F.col("_v"))
        )
    for child, column, parent, parent_column in foreign_keys:
        keys = tables[parent].select(F.col(parent_column).alias("_key"))
        orphans = (
            tables[child]
            .filter(F.col(column).isNotNull())
            .join(keys, F.col(column) == F.col("_key"), "left_anti")
            .agg(F.count("*").alias("_v"))
        )
        parts.append(_check(orphans, child, f"foreign_key_{column}", ERROR, F.col("_v")))
    for name, columns in not_null.items():
        row = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        parts += [_check(row, name, f"not_null_{c}", ERROR, F.col(c)) for c in columns]
    return union_all(parts)
