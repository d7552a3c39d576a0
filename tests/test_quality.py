import pytest

from merchweave.operators import quality as q


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", "1", "x"), ("a", "1", "x"), ("b", None, "y"), (None, "7", "x"), (None, "abc", None), ("c", "9", "z")],
        "k string, n string, v string",
    )


def test_schema_check(table):
    got = {(r.check_name, r.severity, r.detail) for r in q.check_schema(table, "t", ["k", "n", "w"]).collect()}
    assert got == {("schema_missing_columns", "ERROR", "w"), ("schema_extra_columns", "WARNING", "v")}
    assert q.check_schema(table, "t", ["v", "n", "k"]).first().severity == "PASS"


def test_missing_and_completeness(table):
    got = {r.column_name: (r.missing_count, r.missing_pct, r.completeness_pct) for r in q.missing_values(table, "t").collect()}
    assert got == {"k": (2, 33.33, 66.67), "n": (1, 16.67, 83.33), "v": (1, 16.67, 83.33)}
    assert q.completeness(table, "t").first().completeness_pct == 77.78


def test_duplicates_count_null_as_a_value(table):
    assert q.check_full_duplicates(table, "t").first().violations == 1
    assert q.check_unique(table, "t", "k").first().violations == 2


def test_ranges_ignore_text_and_null_and_include_bounds(table):
    row = q.check_ranges(table, "t", {"n": (1, 8), "absent": (0, 1)}).collect()
    assert [(r.violations, r.detail) for r in row] == [(1, "0 below, 1 above")]


def test_allowed_values(table, rows):
    assert q.check_allowed(table, "t", {"v": ["x"]}).first().violations == 2
    assert rows(q.unexpected_values(table, "t", {"v": ["x"]}), "unexpected_value", "n_rows") == [("y", 1), ("z", 1)]


def test_profiles(spark, table):
    got = {r.value: (r.n, r.place, r.unique_count) for r in q.profile_categorical(table, "t", 2).filter("column_name = 'v'").collect()}
    assert got == {"x": (3, 1, 3), "y": (1, 2, 3)}
    nums = spark.createDataFrame([(1, 2.0), (2, None), (4, 5.0)], "i int, d double")
    prof = {r.column_name: r for r in q.profile_numeric(nums, "t").collect()}
    assert (prof["i"].median, prof["i"].mean, prof["i"].std) == (2.0, 2.33, 1.53)
    assert (prof["d"].null_count, prof["d"].median) == (1, 3.5)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "k string, n int")
    assert {r.missing_pct for r in q.missing_values(empty, "t").collect()} == {0.0}
    assert q.completeness(empty, "t").first().completeness_pct == 0.0
    assert q.check_full_duplicates(empty, "t").first().violations == 0
    assert q.check_unique(empty, "t", "k").first().severity == "PASS"
    assert q.check_ranges(empty, "t", {"n": (0, 1)}).first().violations == 0
    spec = q.Expectation(["k", "n"], unique=["k"], ranges={"n": (0, 1)}, allowed={"k": ["x"]})
    facts = q.table_facts(empty, "t", spec, spark)
    assert {r.severity for r in facts.selectExpr("inline(checks)").collect()} == {"PASS"}
    assert q.quality_summary(facts).first().completeness_pct == 0.0
    assert q.check_allowed(empty, "t", {"k": ["x"]}).first().severity == "PASS"
    assert q.profile_numeric(empty, "t").first().median is None
    assert q.profile_categorical(empty, "t").count() == 0


def test_status_summary_and_gate(spark, table):
    spec = {"t": q.Expectation(["k", "n", "v"], unique=["k"]), "gone": q.Expectation(["a"])}
    checks = q.validate({"t": table, "gone": None}, spec, spark)
    status = {r.table_name: r.overall_status for r in q.table_status(checks).collect()}
    assert status == {"t": "ERROR", "gone": "ERROR"}
    summary = {r.table_name: r for r in q.quality_summary(q.facts_of({"t": table}, spec, spark)).collect()}
    assert (summary["t"].n_pass, summary["t"].n_warning, summary["t"].n_error, summary["t"].full_duplicates) == (1, 1, 1, 1)
    assert (summary["t"].n_rows, summary["t"].completeness_pct, summary["gone"].n_error) == (6, 77.78, 1)
    assert q.open_issues(checks).count() == 3
    with pytest.raises(q.QualityGateError, match="gone: table_missing"):
        q.quality_gate(checks)
    q.quality_gate(q.validate({"t": table}, {"t": q.Expectation(["k", "n", "v"])}, spark))


def test_one_pass_equals_single_checks(spark, table, rows):
    spec = q.Expectation(["k", "n", "w"], unique=["k", "v"], ranges={"n": (1, 8)}, allowed={"v": ["x"]})
    single = q.union_all(
        [
            q.check_schema(table, "t", spec.columns),
            q.check_full_duplicates(table, "t"),
            q.check_unique(table, "t", "k"),
            q.check_unique(table, "t", "v"),
            q.check_ranges(table, "t", spec.ranges),
            q.check_allowed(table, "t", spec.allowed),
        ]
    )
    assert rows(q.validate({"t": table}, {"t": spec}, spark)) == rows(single)


def test_constraints(spark):
    users = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "u int, x string")
    pairs = spark.createDataFrame([(1,), (3,), (None,)], "u int")
    got = q.constraint_checks({"users": users, "pairs": pairs}, {"users": ["u"]}, [("pairs", "u", "users", "u")], {"users": ["x"]})
    assert {r.check_name: r.violations for r in got.collect()} == {"primary_key_u": 1, "foreign_key_u": 1, "not_null_x": 1}
