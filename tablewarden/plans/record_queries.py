"""Queries over the employee records, with the SQL that gives the same result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions import times
from tablewarden.materialize import scratch_path
from tablewarden.operators import quality, transforms
from tablewarden.operators.quality import Check, MetricRules
from tablewarden.plans.views import EMP_SQL, RUN_DATE, employees, table
from tablewarden.sources import tables
from tablewarden.sources.files import preview, read_csv, read_parquet, write_csv, write_parquet
from tablewarden.streaming.ingest import ingest_new_files

# Database of the tables that queries make and drop again.
QUERY_DB = "tablewarden_queries"

EMPLOYEE_MAPPING = [
    ("id", "employee_id", "int"),
    ("line", "line_no", "int"),
    ("age", "age", "int"),
    ("salary", "salary", "double"),
    ("department", "department", None),
    (
        "CASE WHEN age < 30 THEN 'Junior' WHEN age < 40 THEN 'Mid-Level' ELSE 'Senior' END",
        "employee_category",
        None,
    ),
    (
        "CASE WHEN salary < 75000 THEN 'Band 1' WHEN salary < 90000 THEN 'Band 2' "
        "ELSE 'Band 3' END",
        "salary_band",
        None,
    ),
    (f"DATE '{RUN_DATE}'", "processed_date", None),
]

EMPLOYEE_CHECKS = [
    Check("salary_range", "Range Validation", "salary >= 0 AND salary <= 500000", 0.99),
    Check(
        "salary_department",
        "Rule Validation",
        "salary > 0 AND department IN ('A', 'N')",
        0.99,
        "Medium",
    ),
    Check("adult", "Range Validation", "age > 18", 0.99, "Low"),
]

LABEL_RULES = MetricRules(
    required=["lang", "source", "quality", "toxic"],
    accuracy="quality = 1 AND toxic = 0",
    types={"n_chars": "int", "quality": "int", "source": "int"},
)

ORDER_STRUCTURE = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.IntegerType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_clerk", T.StringType()),
    ]
)

TRANSFORM_SQL = f"""SELECT id, line, TRY_CAST(age AS INTEGER) AS age,
  TRY_CAST(salary AS DOUBLE) AS salary, department,
  CASE WHEN age < 30 THEN 'Junior' WHEN age < 40 THEN 'Mid-Level' ELSE 'Senior' END
    AS employee_category,
  CASE WHEN salary < 75000 THEN 'Band 1' WHEN salary < 90000 THEN 'Band 2' ELSE 'Band 3' END
    AS salary_band,
  DATE '{RUN_DATE}' AS processed_date
FROM emp"""


def adult_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.filter_adults(employees(spark, sf_dir))


def filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.filter_counts(employees(spark, sf_dir), F.col("age") > 18)


def employee_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.transform_employees(employees(spark, sf_dir), RUN_DATE)


def mapping_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.apply_mapping(employees(spark, sf_dir), EMPLOYEE_MAPPING)


def cast_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    number = F.get_json_object("props", "$.k")
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(number)
    return transforms.cast_employee(
        events.select("event_id", text.alias("age"), text.alias("salary"))
    )


def records_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(
        employees(spark, sf_dir), ["salary", "id", "line", "age", "department"]
    )


def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.pk_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels; a document without labels has NULLs."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")


def pk_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.pk_violations(_labelled(spark, sf_dir), ["source", "quality"])


def kpi_avg_by_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpi = quality.evaluate_kpi(
        employees(spark, sf_dir), "avg_salary", "department", "avg(salary)", 53000.0
    )
    return kpi.withColumns({"value": F.round("value", 4), "gap": F.round("gap", 4)})


def _check_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_checks(employees(spark, sf_dir), EMPLOYEE_CHECKS, "employees", RUN_DATE)


def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _check_results(spark, sf_dir)
    return results.withColumn("pass_rate", F.round("pass_rate", 6))


def quality_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_issues(_check_results(spark, sf_dir))


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = quality.quality_metrics(_labelled(spark, sf_dir), LABEL_RULES, RUN_DATE)
    shares = ["completeness", "accuracy", "validity", "overall_score"]
    return metrics.withColumns({name: F.round(name, 6) for name in shares})


def metrics_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = quality.quality_metrics(_labelled(spark, sf_dir), LABEL_RULES, RUN_DATE)
    rows = quality.metrics_metadata(metrics, F.lit("documents"))
    return rows.select(
        "guid",
        "bm_name",
        F.explode("attributes").alias("attribute", "text"),
        "written_at",
    ).select(
        "guid",
        "bm_name",
        "attribute",
        F.round(F.col("text").try_cast("double"), 6).alias("value"),
        F.col("text").try_cast("date").alias("day"),
        "written_at",
    )


def issue_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.issue_tags(quality_issues(spark, sf_dir), F.lit("employees"))
    names = ["issueType", "severity", "affectedRecords"]
    return rows.select(
        "guid",
        "classification",
        *[F.col("attributes")[name].alias(name) for name in names],
        "propagated",
    )


def column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.column_stats(table(spark, sf_dir, "orders"), distinct=False)


def column_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.column_distinct(
        table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority"]
    )


def structure_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema that the files have, against the one that is wanted."""
    return quality.structure_report(read_parquet(spark, f"{sf_dir}/orders.parquet"), ORDER_STRUCTURE)


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return quality.reconcile(orders, lines.distinct(), ["o_orderkey"])


def epoch_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        times.to_epoch_millis("ts").alias("millis"),
        times.to_epoch_seconds("ts").alias("seconds"),
    )
    return events.withColumns(
        {
            "ts_millis": times.from_epoch_millis("millis"),
            "ts_seconds": times.from_epoch_seconds("seconds"),
            "stamp": times.run_stamp(times.from_epoch_seconds("seconds")),
        }
    )


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as CSV and read back by header name in another column order."""
    path = scratch_path(spark, "csv")
    write_csv(employees(spark, sf_dir), path)
    schema = T.StructType(
        [
            T.StructField("department", T.StringType()),
            T.StructField("id", T.LongType()),
            T.StructField("line", T.IntegerType()),
            T.StructField("salary", T.DoubleType()),
            T.StructField("age", T.DoubleType()),
        ]
    )
    return read_csv(spark, path, schema)


def load_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered records to Parquet, then to a table, then read from the table."""
    files = scratch_path(spark, "adults")
    write_parquet(transforms.filter_adults(employees(spark, sf_dir)), files)
    name, path = f"{QUERY_DB}.adults_{uuid.uuid4().hex}", scratch_path(spark, "table")
    loaded = tables.load_table(read_parquet(spark, files), name, path)
    # The rows lie at a path of their own and stay when the name goes.
    schema = loaded.schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(path)


def text_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in a comma-delimited text table."""
    name, path = f"{QUERY_DB}.text_{uuid.uuid4().hex}", scratch_path(spark, "text")
    ddl = "id BIGINT, line INT, department STRING, salary DOUBLE"
    tables.ensure_database(spark, QUERY_DB)
    tables.create_text_table(spark, name, ddl, location=path)
    rows = employees(spark, sf_dir).select("id", "line", "department", "salary")
    rows.write.insertInto(name)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(ddl).csv(path)


def daily_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transform as an incremental file stream over the line items."""
    schema = read_parquet(spark, f"{sf_dir}/lineitem.parquet").schema

    def transform(rows: DataFrame) -> DataFrame:
        return transforms.transform_employees(
            rows.select(
                F.col("l_orderkey").alias("id"),
                F.col("l_linenumber").alias("line"),
                F.col("l_quantity").alias("age"),
                F.col("l_extendedprice").alias("salary"),
                F.col("l_returnflag").alias("department"),
            ),
            RUN_DATE,
        )

    # A pattern with one match: it takes a single file as well as a folder of files.
    return ingest_new_files(
        spark,
        f"{sf_dir}/lineitem.parque[t]",
        schema,
        scratch_path(spark, "ingested"),
        scratch_path(spark, "ingest-progress"),
        transform,
    )


QUERIES = {
    "adult_filter": adult_filter,
    "filter_counts": filter_counts,
    "employee_transform": employee_transform,
    "mapping_project": mapping_project,
    "cast_lenient": cast_lenient,
    "records_preview": records_preview,
    "pk_violations": pk_violations,
    "pk_null_keys": pk_null_keys,
    "kpi_avg_by_department": kpi_avg_by_department,
    "quality_checks": quality_checks,
    "quality_issues": quality_issues,
    "quality_metrics": quality_metrics,
    "metrics_metadata": metrics_metadata,
    "issue_tags": issue_tags,
    "column_stats": column_stats,
    "column_distinct": column_distinct,
    "structure_report": structure_report,
    "reconcile": reconcile,
    "epoch_times": epoch_times,
    "csv_round_trip": csv_round_trip,
    "load_table": load_table,
    "text_table": text_table,
    "daily_ingest": daily_ingest,
}


def _check_sql(check: Check) -> str:
    return f"""SELECT '{check.check_id}' AS check_id, 'employees' AS dataset,
  '{check.check_type}' AS check_type, '{check.severity}' AS severity,
  DATE '{RUN_DATE}' AS run_date, COUNT(*) AS n_rows,
  COUNT(*) FILTER (WHERE {check.expression}) AS n_pass,
  ROUND(COUNT(*) FILTER (WHERE {check.expression})::DOUBLE / COUNT(*), 6) AS pass_rate,
  {check.threshold}::DOUBLE AS threshold,
  COUNT(*) FILTER (WHERE {check.expression})::DOUBLE / COUNT(*) >= {check.threshold}::DOUBLE
    AS passed
FROM emp"""


_CHECKS_SQL = "\nUNION ALL\n".join(_check_sql(check) for check in EMPLOYEE_CHECKS)

_ORDER_COLUMNS = [
    ("o_orderkey", "bigint", "{}::VARCHAR", "NULL::DOUBLE"),
    ("o_custkey", "bigint", "{}::VARCHAR", "NULL::DOUBLE"),
    ("o_orderstatus", "string", "{}", "NULL::DOUBLE"),
    ("o_totalprice", "double", "NULL", "{}"),
    ("o_orderdate", "timestamp_ntz", "strftime({}, '%Y-%m-%d %H:%M:%S.%f')", "NULL::DOUBLE"),
    ("o_orderpriority", "string", "{}", "NULL::DOUBLE"),
]


def _stats_sql(name: str, kind: str, text: str, number: str) -> str:
    low, high = f"MIN({name})", f"MAX({name})"
    return f"""SELECT COUNT(*) AS n_rows, '{name}' AS column_name, '{kind}' AS data_type,
  COUNT(*) - COUNT({name}) AS n_nulls, {text.format(low)} AS min_value,
  {text.format(high)} AS max_value, {number.format(low)} AS min_number,
  {number.format(high)} AS max_number FROM orders"""


_METRICS_SQL = f"""WITH d AS (
  SELECT doc_id, lang, source, n_chars, quality, toxic
  FROM documents LEFT JOIN labels USING (doc_id)),
m AS (
  SELECT COUNT(*) AS n_rows,
    (COUNT(lang) + COUNT(source) + COUNT(quality) + COUNT(toxic))::DOUBLE / (COUNT(*) * 4)
      AS completeness,
    COUNT(*) FILTER (WHERE quality = 1 AND toxic = 0)::DOUBLE / COUNT(*) AS accuracy,
    (COUNT(TRY_CAST(n_chars AS INTEGER)) + COUNT(TRY_CAST(quality AS INTEGER))
      + COUNT(TRY_CAST(source AS INTEGER)))::DOUBLE / (COUNT(*) * 3) AS validity
  FROM d)
SELECT n_rows, ROUND(completeness, 6) AS completeness, ROUND(accuracy, 6) AS accuracy,
  ROUND(validity, 6) AS validity,
  ROUND((completeness + accuracy + validity) / 3::DOUBLE, 6) AS overall_score,
  DATE '{RUN_DATE}' AS last_checked
FROM m"""

ORACLES = {
    "adult_filter": f"WITH {EMP_SQL} SELECT * FROM emp WHERE age > 18",
    "filter_counts": f"""WITH {EMP_SQL} SELECT COUNT(*) AS rows_before,
  COUNT(*) FILTER (WHERE age > 18) AS rows_after,
  COUNT(*) - COUNT(*) FILTER (WHERE age > 18) AS rows_dropped FROM emp""",
    "employee_transform": f"WITH {EMP_SQL} {TRANSFORM_SQL}",
    "mapping_project": f"""WITH {EMP_SQL}, t AS ({TRANSFORM_SQL})
SELECT id::INTEGER AS employee_id, line AS line_no, age, salary, department,
  employee_category, salary_band, processed_date FROM t""",
    "cast_lenient": """WITH t AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN event_type
    ELSE json_extract_string(props, '$.k') END AS x FROM events)
SELECT event_id, TRY_CAST(x AS INTEGER) AS age, TRY_CAST(x AS DOUBLE) AS salary FROM t""",
    "records_preview": f"""WITH {EMP_SQL}
SELECT * FROM emp ORDER BY salary, id, line, age, department LIMIT 5""",
    "pk_violations": """SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows,
  'duplicate' AS violation FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "pk_null_keys": """SELECT source, quality, COUNT(*) AS n_rows,
  CASE WHEN quality IS NULL THEN 'null_key' ELSE 'duplicate' END AS violation
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2
HAVING quality IS NULL OR COUNT(*) > 1""",
    "kpi_avg_by_department": f"""WITH {EMP_SQL} SELECT 'avg_salary' AS kpi_id,
  department AS key, ROUND(AVG(salary), 4) AS value, 53000::DOUBLE AS target,
  ROUND(AVG(salary) - 53000, 4) AS gap FROM emp GROUP BY department""",
    "quality_checks": f"WITH {EMP_SQL} {_CHECKS_SQL}",
    "quality_issues": f"""WITH {EMP_SQL}, r AS ({_CHECKS_SQL})
SELECT check_id, dataset, check_type AS issue_type, severity,
  n_rows - n_pass AS affected_records FROM r WHERE NOT passed""",
    "quality_metrics": _METRICS_SQL,
    "metrics_metadata": f"""WITH q AS ({_METRICS_SQL}),
u AS (
  SELECT 'completeness' AS attribute, completeness AS value, NULL::DATE AS day FROM q
  UNION ALL SELECT 'accuracy', accuracy, NULL FROM q
  UNION ALL SELECT 'validity', validity, NULL FROM q
  UNION ALL SELECT 'overallScore', overall_score, NULL FROM q
  UNION ALL SELECT 'lastChecked', NULL, last_checked FROM q)
SELECT 'documents' AS guid, 'DataQualityMetrics' AS bm_name, attribute, value, day,
  TIMESTAMP '{RUN_DATE} 00:00:00' AS written_at FROM u""",
    "issue_tags": f"""WITH {EMP_SQL}, r AS ({_CHECKS_SQL})
SELECT 'employees' AS guid, 'DataQualityIssue' AS classification, check_type AS "issueType",
  severity, (n_rows - n_pass)::VARCHAR AS "affectedRecords", FALSE AS propagated
FROM r WHERE NOT passed""",
    "column_stats": "\nUNION ALL\n".join(_stats_sql(*column) for column in _ORDER_COLUMNS),
    "column_distinct": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS n_distinct FROM orders"
        for c in ("o_custkey", "o_orderstatus", "o_orderpriority")
    ),
    "structure_report": """SELECT COUNT(*) AS n_rows, 'o_orderkey' AS column_name,
  'bigint' AS expected_type, 'bigint' AS actual_type, 'ok' AS status,
  COUNT(o_orderkey) AS n_filled FROM orders
UNION ALL SELECT COUNT(*), 'o_custkey', 'int', 'bigint', 'retyped', COUNT(o_custkey) FROM orders
UNION ALL SELECT COUNT(*), 'o_orderstatus', 'string', 'string', 'ok', COUNT(o_orderstatus)
FROM orders
UNION ALL SELECT COUNT(*), 'o_clerk', 'string', NULL, 'missing', 0 FROM orders""",
    "reconcile": """WITH s AS (SELECT o_orderkey AS k FROM orders),
t AS (SELECT DISTINCT l_orderkey AS k FROM lineitem),
m AS (SELECT (SELECT COUNT(*) FROM s) AS source_rows, (SELECT COUNT(*) FROM t) AS target_rows,
  (SELECT COUNT(*) FROM s WHERE k NOT IN (SELECT k FROM t)) AS missing_keys,
  (SELECT COUNT(*) FROM t WHERE k NOT IN (SELECT k FROM s)) AS unexpected_keys,
  (SELECT COUNT(*) FROM (SELECT k, COUNT(*) AS n FROM s GROUP BY k)
     WHERE n > 1 AND k IN (SELECT k FROM t)) AS uneven_keys)
SELECT *, missing_keys = 0 AND unexpected_keys = 0 AND uneven_keys = 0 AS reconciled FROM m""",
    "epoch_times": """SELECT event_id, epoch_us(ts) // 1000 AS millis,
  epoch_us(ts) // 1000000 AS seconds,
  date_trunc('millisecond', ts) AS ts_millis, date_trunc('second', ts) AS ts_seconds,
  strftime(ts, '%Y%m%d%H%M%S') AS stamp FROM events""",
    "csv_round_trip": f"WITH {EMP_SQL} SELECT * FROM emp",
    "load_table": f"WITH {EMP_SQL} SELECT * FROM emp WHERE age > 18",
    "text_table": f"WITH {EMP_SQL} SELECT id, line, department, salary FROM emp",
    "daily_ingest": f"WITH {EMP_SQL} {TRANSFORM_SQL}",
}
