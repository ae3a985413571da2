"""Row filters, casts, bands and mappings of record tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablewarden.functions.bands import employee_category, salary_band
from tablewarden.functions.casts import lenient_cast
from tablewarden.functions.times import processing_date

# Fixed value: records of this age and below are dropped.
ADULT_AGE = 18


def filter_adults(df: DataFrame, min_age: int = ADULT_AGE) -> DataFrame:
    """Rows strictly above the age; rows of unknown age are dropped."""
    return df.filter(F.col("age") > min_age)


def filter_with_counts(
    df: DataFrame, condition: Column
) -> tuple[DataFrame, Observation, Observation]:
    """Filtered rows and two observations, ``before`` and ``after``.

    The counts are collected while the filtered rows are written, so the source is read
    once. Read them with ``.get["rows"]`` after the first action.
    """
    before, after = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    kept = df.observe(before, rows).filter(condition).observe(after, rows)
    return kept, before, after


def filter_counts(df: DataFrame, condition: Column) -> DataFrame:
    """One row: rows before and after the filter, and rows it drops."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(condition).alias("rows_after"),
    ).withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))


def cast_employee(df: DataFrame) -> DataFrame:
    """Salary as double and age as int; text that is no number becomes NULL."""
    types = {"salary": "double", "age": "int"}
    schema = df.schema
    return df.withColumns(
        {name: lenient_cast(F.col(name), schema[name].dataType, t) for name, t in types.items()}
    )


def transform_employees(df: DataFrame, run_date: date | str) -> DataFrame:
    """Casts, age category, salary band and processing date in one projection."""
    return cast_employee(df).withColumns(
        {
            "employee_category": employee_category(),
            "salary_band": salary_band(),
            "processed_date": processing_date(run_date),
        }
    )


def apply_mapping(df: DataFrame, mapping: list[tuple[str, str, str | None]]) -> DataFrame:
    """Project by mapping rows (source expression, target column, target type or None)."""
    mapped = df.select(*[F.expr(expression).alias(target) for expression, target, _ in mapping])
    schema = mapped.schema
    typed = []
    for _, target, target_type in mapping:
        column = F.col(target)
        if target_type:
            column = lenient_cast(column, schema[target].dataType, target_type).alias(target)
        typed.append(column)
    return mapped.select(*typed)
