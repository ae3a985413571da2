"""Checks, metrics, KPI, keys, statistics and reconciliation."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from test_records import EMPLOYEE_DDL, EMPLOYEES, SAMPLE, SAMPLE_DDL
from tablewarden.operators import quality as q


def test_kpi_of_employees(spark):
    df = spark.createDataFrame(EMPLOYEES, EMPLOYEE_DDL)
    rows = q.evaluate_kpi(df, "k", "department", "avg(salary)", 80000).collect()
    got = {r.key: (round(r.value, 2), round(r.gap, 2), r.target) for r in rows}
    assert got == {
        "Finance": (102500.0, 22500.0, 80000.0),
        "HR": (84000.0, 4000.0, 80000.0),
        "IT": (75333.33, -4666.67, 80000.0),
        "Marketing": (82333.33, 2333.33, 80000.0),
    }


def test_kpi_of_sample(spark):
    df = spark.createDataFrame(SAMPLE, SAMPLE_DDL)
    rows = q.evaluate_kpi(df, "k", "department", "avg(salary)", 80000).collect()
    assert {r.key: round(r.value, 2) for r in rows} == {
        "Engineering": 80000.0,
        "Executive": 120000.0,
        "Finance": 92000.0,
        "Human Resources": 68000.0,
        "Intern": 25333.33,
        "Marketing": 62000.0,
        "Sales": 71000.0,
    }


def test_checks_of_sample(spark):
    df = spark.createDataFrame(SAMPLE, SAMPLE_DDL)
    checks = [
        q.Check("range", "Range Validation", "salary >= 0 AND salary <= 500000", 0.99),
        q.Check(
            "rule",
            "Rule Validation",
            "salary > 0 AND department IN ('Engineering', 'Marketing', 'Finance')",
            0.95,
            "Medium",
        ),
    ]
    results = q.run_checks(df, checks, "sample", "2025-05-20")
    got = {r.check_id: (r.n_rows, r.n_pass, r.pass_rate, r.passed) for r in results.collect()}
    assert got == {"range": (10, 10, 1.0, True), "rule": (10, 4, 0.4, False)}
    issue = q.quality_issues(results).collect()
    assert [(i.check_id, i.severity, i.affected_records) for i in issue] == [("rule", "Medium", 6)]


def test_null_fails_a_check(spark):
    df = spark.createDataFrame([(1,), (None,)], "salary INT")
    row = q.run_checks(df, [q.Check("c", "t", "salary > 0", 0.5)], "d", "2025-05-20").first()
    assert (row.n_pass, row.pass_rate, row.passed) == (1, 0.5, True)


def test_empty_table_passes_no_check(spark):
    df = spark.createDataFrame([], "salary INT")
    row = q.run_checks(df, [q.Check("c", "t", "salary > 0", 0.0)], "d", "2025-05-20").first()
    assert (row.n_rows, row.pass_rate, row.passed) == (0, None, False)


def test_all_checks_share_one_aggregate(spark):
    df = spark.createDataFrame(SAMPLE, SAMPLE_DDL)
    checks = [q.Check(str(i), "t", f"salary > {i}", 0.5) for i in range(5)]
    plan = q.run_checks(df, checks, "d", "2025-05-20")._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Aggregate") == 1


def test_metrics(spark):
    df = spark.createDataFrame(
        [("1", 5), ("x", None), (None, 7), ("3", 1)], "code STRING, amount INT"
    )
    rules = q.MetricRules(["code", "amount"], "amount > 4", {"code": "int"})
    row = q.quality_metrics(df, rules, "2025-05-20").first()
    assert (row.n_rows, row.completeness, row.accuracy, row.validity) == (4, 0.75, 0.5, 0.5)
    assert row.overall_score == pytest.approx((0.75 + 0.5 + 0.5) / 3)


def test_pk_violations(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id INT")
    got = {(r.id, r.n_rows, r.violation) for r in q.pk_violations(df, ["id"]).collect()}
    assert got == {(2, 2, "duplicate"), (None, 1, "null_key")}
    with pytest.raises(q.DataQualityError):
        q.require_primary_key(df, ["id"])
    q.require_primary_key(df.filter("id = 1"), ["id"])


def test_hot_key_is_counted_before_the_shuffle(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    top = q.pk_violations(df, ["k"]).collect()
    assert [(r.k, r.n_rows) for r in top] == [(0, 10_000)]
    plan = q.pk_violations(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_column_stats(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.5, [1]), (2, None, -2.0, [2]), (2, "c", None, None)],
        "i INT, s STRING, d DOUBLE, l ARRAY<INT>",
    )
    got = {r.column_name: r for r in q.column_stats(df).collect()}
    assert (got["i"].min_value, got["i"].max_value, got["i"].n_distinct) == ("1", "2", 2)
    assert (got["s"].n_nulls, got["s"].min_value, got["s"].max_value) == (1, "a", "c")
    assert (got["d"].min_number, got["d"].max_number, got["d"].min_value) == (-2.0, 1.5, None)
    assert (got["l"].n_nulls, got["l"].min_value, got["l"].n_distinct) == (1, None, None)
    assert {r.n_rows for r in got.values()} == {3}


def test_bounds_are_exact(spark):
    df = spark.sql(
        "SELECT 0.00001D AS d, TIMESTAMP_NTZ '2024-01-02 03:04:05.000007' AS t, "
        "TIMESTAMP '2024-01-02 03:04:05.000007+02:00' AS z"
    )
    kept = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    got = {r.column_name: r for r in q.column_stats(df).collect()}
    spark.conf.set("spark.sql.session.timeZone", kept)
    assert got["d"].min_number == 0.00001
    assert got["t"].max_value == "2024-01-02 03:04:05.000007"
    assert got["z"].max_value == "2024-01-02 01:04:05.000007"


def test_no_checks_and_no_required_columns(spark):
    df = spark.range(3)
    assert q.run_checks(df, [], "d", "2024-01-01").count() == 0
    with pytest.raises(ValueError):
        q.quality_metrics(df, q.MetricRules([], "true"), "2024-01-01")


def test_approximate_distinct_is_near(spark):
    df = spark.range(20_000).select((F.col("id") % 5000).alias("k"))
    n = q.column_stats(df).first().n_distinct
    assert abs(n - 5000) < 5000 * 0.15


def test_exact_distinct(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "i INT, s STRING")
    assert {(r.column_name, r.n_distinct) for r in q.column_distinct(df, ["i", "s"]).collect()} == {
        ("i", 2),
        ("s", 1),
    }


def test_structure(spark):
    df = spark.createDataFrame([(1, None)], "id INT, name STRING")
    wanted = T.StructType.fromDDL("id BIGINT, name STRING, age INT")
    got = {r.column_name: (r.status, r.n_filled) for r in q.structure_report(df, wanted).collect()}
    assert got == {"id": ("retyped", 1), "name": ("ok", 0), "age": ("missing", 0)}
    with pytest.raises(q.DataQualityError, match="age"):
        q.validate_structure(df, wanted)
    with pytest.raises(q.DataQualityError, match="no rows"):
        q.validate_structure(df.filter("id > 5"), T.StructType.fromDDL("id INT"))
    assert q.validate_structure(df, T.StructType.fromDDL("id INT")) is df


def test_reconcile(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id INT")
    right = spark.createDataFrame([(2,), (3,), (4,)], "id INT")
    row = q.reconcile(left, right, ["id"]).first()
    assert tuple(row) == (4, 3, 1, 1, 1, False)
    assert q.reconcile(left, left, ["id"]).first().reconciled
    with pytest.raises(q.DataQualityError):
        q.require_reconciled(left, right, ["id"])


def test_reconcile_of_empty_tables(spark):
    none = spark.createDataFrame([], "id INT")
    assert tuple(q.reconcile(none, none, ["id"]).first()) == (0, 0, 0, 0, 0, True)


def test_results_become_metadata(spark):
    df = spark.createDataFrame([(1,), (None,)], "amount INT")
    metrics = q.quality_metrics(df, q.MetricRules(["amount"], "amount > 0"), "2025-05-20")
    row = q.metrics_metadata(metrics, F.lit("g")).first()
    assert (row.guid, row.bm_name) == ("g", "DataQualityMetrics")
    assert row.attributes["completeness"] == "0.5" and row.attributes["lastChecked"] == "2025-05-20"
    results = q.run_checks(df, [q.Check("c", "Range", "amount > 0", 0.9)], "d", "2025-05-20")
    tag = q.issue_tags(q.quality_issues(results), F.lit("g")).first()
    assert tag.classification == "DataQualityIssue"
    assert tag.attributes == {"issueType": "Range", "severity": "High", "affectedRecords": "1"}


def test_files_with_columns_dropped_renamed_and_retyped(spark, tmp_path):
    wanted = T.StructType.fromDDL("a BIGINT, b STRING, c DOUBLE")
    spark.sql("SELECT 1L AS a, 'x' AS b2, 'y' AS c").write.parquet(str(tmp_path / "t"))
    got = {r.column_name: r.status for r in q.structure_report(spark.read.parquet(str(tmp_path / "t")), wanted).collect()}
    assert got == {"a": "ok", "b": "missing", "c": "retyped"}


def test_text_that_is_not_of_its_type(spark):
    schema = T.StructType.fromDDL("id INT, pay DOUBLE")
    good = spark.createDataFrame([("1", "2.5"), (None, None)], "id STRING, pay STRING")
    q.require_castable(good, schema)
    with pytest.raises(q.DataQualityError, match="pay: 1 values"):
        q.require_castable(good.unionAll(spark.createDataFrame([("2", "much")], good.schema)), schema)
    with pytest.raises(q.DataQualityError, match="missing columns: pay"):
        q.require_castable(good.drop("pay"), schema)
