"""Schemas read from each file before any is declared."""

import pytest
from pyspark.sql import types as T

from merchweave.operators import quality as q


@pytest.fixture
def folder(spark, tmp_path):
    root = tmp_path / "t.parquet"

    def put(query):
        spark.sql(query).coalesce(1).write.mode("append").parquet(str(root))

    put("SELECT 1L AS k, 'a' AS v, 2.5D AS x FROM range(3)")  # as expected
    put("SELECT 1L AS k, 'a' AS w, 2.5D AS x")  # v renamed to w
    put("SELECT 1 AS k, 'a' AS v, '2.5' AS x FROM range(2)")  # two retyped
    put("SELECT 1L AS k, 'a' AS v, 2.5D AS x, true AS more FROM range(4)")  # one more
    put("SELECT 1L AS k, 'a' AS v")  # one less
    return str(root)


EXPECTED = "k bigint, v string, x double"


def test_every_file_is_compared_by_itself(spark, folder):
    expected = {"t": T.StructType.fromDDL(EXPECTED)}
    got = q.check_files(spark, {"t": folder}, expected).collect()
    assert len({r.file_name for r in got}) == 5 and all(r.file_name.endswith(".parquet") for r in got)
    assert sorted((r.check_name, r.severity, r.violations, r.detail, r.n_rows) for r in got) == [
        ("schema_extra_columns", "WARNING", 1, "more", 4),
        ("schema_extra_columns", "WARNING", 1, "w", 1),
        ("schema_match", "PASS", 0, "", 3),
        ("schema_missing_columns", "ERROR", 1, "v", 1),
        ("schema_missing_columns", "ERROR", 1, "x", 1),
        ("schema_types", "ERROR", 2, "k: int instead of bigint, x: string instead of double", 2),
    ]


def test_a_table_that_is_not_there(spark, tmp_path):
    got = q.check_files(spark, {"gone": str(tmp_path / "gone")}, {"gone": T.StructType.fromDDL(EXPECTED)}).collect()
    assert [(r.table_name, r.file_name, r.check_name, r.severity, r.n_rows) for r in got] == [
        ("gone", None, "schema_unreadable", "ERROR", 0)
    ]


def test_csv_headers(spark, tmp_path):
    spark.sql("SELECT 1 AS k, 'a' AS v, 2.5D AS x").coalesce(1).write.option("header", True).csv(str(tmp_path / "c"))
    expected = {"c": T.StructType.fromDDL("k int, v string, x double")}
    got = q.check_files(spark, {"c": str(tmp_path / "c")}, expected, "csv").collect()
    assert [(r.check_name, r.n_rows) for r in got] == [("schema_match", 1)]
