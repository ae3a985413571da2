"""Quality checks, KPI values, key checks, table statistics and load checks."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.casts import lenient_cast
from tablewarden.functions.naming import as_column

# The attribute group of metrics and the tag of an issue.
METRICS_GROUP = "DataQualityMetrics"
ISSUE_TAG = "DataQualityIssue"


class DataQualityError(ValueError):
    """A table does not have the shape or the keys a job needs."""


@dataclass(frozen=True)
class Check:
    """A row predicate and the share of rows that must pass it."""

    check_id: str
    check_type: str
    expression: str
    threshold: float
    severity: str = "High"


@dataclass(frozen=True)
class MetricRules:
    """What completeness, accuracy and validity of a table are measured on."""

    required: list[str]
    accuracy: str
    types: dict[str, str] = field(default_factory=dict)


def _unpivot(df: DataFrame, rows: list[Column], keep: list[str]) -> DataFrame:
    """One output row per struct in ``rows``, beside the ``keep`` columns."""
    return df.select(*keep, F.inline(F.array(*rows)))


def run_checks(
    df: DataFrame, checks: list[Check], dataset: str, run_date: date | str
) -> DataFrame:
    """One row per check: rows, rows that pass, pass rate, passed or not.

    All checks share one scan and one aggregate. A predicate that is NULL fails. An
    empty table has no pass rate and passes no check. Without checks there are no rows.
    """
    if not checks:
        # One check of any kind gives the columns.
        return run_checks(df, [Check("", "", "true", 0.0)], dataset, run_date).filter("false")
    passes = [F.count_if(F.expr(c.expression)).alias(f"pass_{i}") for i, c in enumerate(checks)]
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), *passes)
    rows = [
        F.struct(
            F.lit(c.check_id).alias("check_id"),
            F.lit(c.check_type).alias("check_type"),
            F.lit(c.severity).alias("severity"),
            F.lit(float(c.threshold)).alias("threshold"),
            F.col(f"pass_{i}").alias("n_pass"),
        )
        for i, c in enumerate(checks)
    ]
    rate = F.try_divide(F.col("n_pass").cast("double"), F.col("n_rows").cast("double"))
    return _unpivot(totals, rows, ["n_rows"]).select(
        "check_id",
        F.lit(dataset).alias("dataset"),
        "check_type",
        "severity",
        F.lit(str(run_date)).cast("date").alias("run_date"),
        "n_rows",
        "n_pass",
        rate.alias("pass_rate"),
        "threshold",
        F.coalesce(rate >= F.col("threshold"), F.lit(False)).alias("passed"),
    )


def quality_issues(results: DataFrame) -> DataFrame:
    """Issue record of each failed check, with the number of failing records."""
    return results.filter(~F.col("passed")).select(
        "check_id",
        "dataset",
        F.col("check_type").alias("issue_type"),
        "severity",
        (F.col("n_rows") - F.col("n_pass")).alias("affected_records"),
    )


def quality_metrics(df: DataFrame, rules: MetricRules, run_date: date | str) -> DataFrame:
    """One row: completeness, accuracy, validity, their mean and the check date.

    Completeness is the share of required values that are not NULL, accuracy the share
    of rows that satisfy the rule, validity the share of typed values that can be cast
    to their type (a missing value cannot). One scan, one aggregate.
    """

    def share(flags: list[Column]) -> Column:
        hits = reduce(lambda a, b: a + b, [F.count_if(flag) for flag in flags])
        return F.try_divide(
            hits.cast("double"), (F.count(F.lit(1)) * F.lit(len(flags))).cast("double")
        )

    if not rules.required:
        raise ValueError("completeness needs at least one required column")
    present = [F.col(name).isNotNull() for name in rules.required]
    typed = [
        lenient_cast(F.col(name), df.schema[name].dataType, kind).isNotNull()
        for name, kind in rules.types.items()
    ]
    metrics = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        share(present).alias("completeness"),
        share([F.expr(rules.accuracy)]).alias("accuracy"),
        (share(typed) if typed else F.lit(1.0)).alias("validity"),
    )
    mean = (F.col("completeness") + F.col("accuracy") + F.col("validity")) / F.lit(3.0)
    return metrics.withColumns(
        {"overall_score": mean, "last_checked": F.lit(str(run_date)).cast("date")}
    )


def metrics_metadata(metrics: DataFrame, guid: Column | str) -> DataFrame:
    """Metrics as a business metadata row of the measured entity."""
    shares = {
        "completeness": "completeness",
        "accuracy": "accuracy",
        "validity": "validity",
        "lastChecked": "last_checked",
        "overallScore": "overall_score",
    }
    pairs = [p for key, c in shares.items() for p in (F.lit(key), F.col(c).cast("string"))]
    return metrics.select(
        as_column(guid).alias("guid"),
        F.lit(METRICS_GROUP).alias("bm_name"),
        F.create_map(*pairs).alias("attributes"),
        F.col("last_checked").cast("timestamp_ntz").alias("written_at"),
        F.lit(0).cast("long").alias("seq"),
    )


def issue_tags(issues: DataFrame, guid: Column | str) -> DataFrame:
    """Issue records as tag rows of the checked entity, one per failed check."""
    return issues.select(
        as_column(guid).alias("guid"),
        F.lit(ISSUE_TAG).alias("classification"),
        F.create_map(
            F.lit("issueType"),
            F.col("issue_type"),
            F.lit("severity"),
            F.col("severity"),
            F.lit("affectedRecords"),
            F.col("affected_records").cast("string"),
        ).alias("attributes"),
        F.lit(False).alias("propagated"),
    )


def evaluate_kpi(
    df: DataFrame, kpi_id: str, key: str, formula: str, target: float
) -> DataFrame:
    """Current value of a KPI per key, its target and the gap between them.

    ``formula`` is an aggregate expression such as ``avg(salary)``.
    """
    return (
        df.groupBy(F.col(key).alias("key"))
        .agg(F.expr(formula).cast("double").alias("value"))
        .select(
            F.lit(kpi_id).alias("kpi_id"),
            "key",
            "value",
            F.lit(float(target)).alias("target"),
            (F.col("value") - F.lit(float(target))).alias("gap"),
        )
    )


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once and keys with a NULL part.

    Rows are counted per key before they are shuffled, so a hot key moves as one row per
    task.
    """
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    kind = F.when(has_null, "null_key").when(F.col("n_rows") > 1, "duplicate")
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("violation", kind)
        .filter(F.col("violation").isNotNull())
    )


def require_primary_key(df: DataFrame, keys: list[str]) -> None:
    """Raise unless ``keys`` identify every row."""
    first = pk_violations(df, keys).first()
    if first is not None:
        raise DataQualityError(f"key ({', '.join(keys)}) is violated, for example {first}")


def _as_text(name: str, data_type: T.DataType) -> Column:
    """Exact text of a minimum or maximum, the same whatever the session time zone."""
    if isinstance(data_type, T.TimestampNTZType):
        return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(data_type, T.TimestampType):
        utc = F.expr(f"convert_timezone(current_timezone(), 'UTC', CAST(`{name}` AS TIMESTAMP_NTZ))")
        return F.date_format(utc, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.col(name).cast("string")


def column_stats(df: DataFrame, bounds: bool = True, distinct: bool = True) -> DataFrame:
    """One row per column: rows, NULLs, minimum, maximum, approximate distinct values.

    One scan and one aggregate whose state has a fixed size. Bounds of floating point
    columns are given as numbers, ``min_number`` and ``max_number``, all others as text,
    times in UTC to the microsecond. Columns that have no order get NULL bounds. Without
    ``bounds`` and ``distinct`` only rows and NULLs are counted.
    """
    measures, rows = [F.count(F.lit(1)).alias("n_rows")], []
    for i, column in enumerate(df.schema):
        ordered = not isinstance(column.dataType, (T.ArrayType, T.MapType, T.StructType))
        floating = isinstance(column.dataType, (T.DoubleType, T.FloatType))
        value = F.col(f"`{column.name}`")
        measures.append(F.count_if(value.isNull()).alias(f"nulls_{i}"))
        if ordered and bounds:
            measures += [F.min(value).alias(f"min_{i}"), F.max(value).alias(f"max_{i}")]
        if ordered and distinct:
            measures.append(F.approx_count_distinct(value).alias(f"distinct_{i}"))
        fields = [
            F.lit(column.name).alias("column_name"),
            F.lit(column.dataType.simpleString()).alias("data_type"),
            F.col(f"nulls_{i}").alias("n_nulls"),
        ]
        if bounds:
            text = ordered and not floating
            for end in ("min", "max"):
                words = _as_text(f"{end}_{i}", column.dataType) if text else F.lit(None).cast("string")
                number = F.col(f"{end}_{i}").cast("double") if floating else F.lit(None).cast("double")
                fields += [words.alias(f"{end}_value"), number.alias(f"{end}_number")]
        if distinct:
            count = F.col(f"distinct_{i}") if ordered else F.lit(None).cast("long")
            fields.append(count.alias("n_distinct"))
        rows.append(F.struct(*fields))
    return _unpivot(df.agg(*measures), rows, ["n_rows"])


def column_distinct(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact number of distinct values of each column, NULL not counted.

    Each column is made distinct on its own with a map-side pass, which avoids expanding
    every row once per column.
    """
    parts = []
    for name in columns:
        values = df.select(F.col(name).alias("value")).filter("value IS NOT NULL").distinct()
        parts.append(
            values.agg(F.count(F.lit(1)).alias("n_distinct")).select(
                F.lit(name).alias("column_name"), "n_distinct"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def structure_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per required column: present or not, type, rows and filled rows."""
    found = {column.name: column.dataType for column in df.schema}
    measures = [F.count(F.lit(1)).alias("n_rows")]
    rows = []
    for i, wanted in enumerate(schema):
        actual = found.get(wanted.name)
        filled = F.col(f"`{wanted.name}`").isNotNull() if actual else F.lit(False)
        measures.append(F.count_if(filled).alias(f"filled_{i}"))
        if actual is None:
            status = "missing"
        else:
            status = "ok" if actual == wanted.dataType else "retyped"
        rows.append(
            F.struct(
                F.lit(wanted.name).alias("column_name"),
                F.lit(wanted.dataType.simpleString()).alias("expected_type"),
                F.lit(actual.simpleString() if actual else None)
                .cast("string")
                .alias("actual_type"),
                F.lit(status).alias("status"),
                F.col(f"filled_{i}").alias("n_filled"),
            )
        )
    return _unpivot(df.agg(*measures), rows, ["n_rows"])


def validate_structure(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Return ``df`` when it has rows and all required columns, else raise."""
    found = {column.name: column.dataType for column in df.schema}
    problems = [
        f"{wanted.name}: expected {wanted.dataType.simpleString()}, found "
        f"{found[wanted.name].simpleString() if wanted.name in found else 'nothing'}"
        for wanted in schema
        if found.get(wanted.name) != wanted.dataType
    ]
    if problems:
        raise DataQualityError("; ".join(problems))
    if df.isEmpty():
        raise DataQualityError("no rows")
    return df


def require_castable(text: DataFrame, schema: T.StructType) -> None:
    """Raise unless a table of text has all columns and every value can be read as its type.

    All columns share one scan and one aggregate.
    """
    absent = [c.name for c in schema if c.name not in text.columns]
    if absent:
        raise DataQualityError(f"missing columns: {', '.join(absent)}")

    def bad(column: T.StructField) -> Column:
        value = F.col(f"`{column.name}`")
        read = lenient_cast(value, T.StringType(), column.dataType.simpleString())
        return F.count_if(value.isNotNull() & read.isNull()).alias(column.name)

    counts = text.agg(*[bad(c) for c in schema]).first().asDict()
    problems = [f"{name}: {n} values" for name, n in counts.items() if n]
    if problems:
        raise DataQualityError(f"text that is not of its type: {'; '.join(problems)}")


def reconcile(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows on each side, keys found on one side only, and the verdict.

    Both sides go through one aggregate on the keys. Rows are counted per key and side
    before the shuffle, so repeated keys cost nothing there.
    """
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    sides = source.select(*keys, one.alias("s"), zero.alias("t")).unionByName(
        target.select(*keys, zero.alias("s"), one.alias("t"))
    )
    per_key = sides.groupBy(*keys).agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    missing = F.count_if((F.col("s") > 0) & (F.col("t") == 0))
    unexpected = F.count_if((F.col("s") == 0) & (F.col("t") > 0))
    repeated = F.count_if((F.col("s") > 0) & (F.col("t") > 0) & (F.col("s") != F.col("t")))
    return per_key.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("target_rows"),
        missing.alias("missing_keys"),
        unexpected.alias("unexpected_keys"),
        repeated.alias("uneven_keys"),
    ).withColumn(
        "reconciled",
        (F.col("missing_keys") == 0)
        & (F.col("unexpected_keys") == 0)
        & (F.col("uneven_keys") == 0),
    )


def require_reconciled(source: DataFrame, target: DataFrame, keys: list[str]) -> None:
    """Raise unless both tables hold the same keys the same number of times."""
    verdict = reconcile(source, target, keys).first()
    if not verdict["reconciled"]:
        raise DataQualityError(f"load differs from its source: {verdict.asDict()}")
