"""Banding of ages and salaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewarden.functions.naming import as_column

# Upper bounds (exclusive) and names of the bands; the last name takes the
# rest, NULL included.
AGE_BANDS = [(30, "Junior"), (40, "Mid-Level")]
AGE_REST = "Senior"
SALARY_BANDS = [(75000, "Band 1"), (90000, "Band 2")]
SALARY_REST = "Band 3"


def band(value: Column | str, bounds: list[tuple[float, str]], rest: str) -> Column:
    """Name of the first band whose upper bound lies above the value."""
    value = as_column(value)
    (first_upper, first_name), *others = bounds
    result = F.when(value < first_upper, first_name)
    for upper, name in others:
        result = result.when(value < upper, name)
    return result.otherwise(rest)


def employee_category(age: Column | str = "age") -> Column:
    return band(age, AGE_BANDS, AGE_REST)


def salary_band(salary: Column | str = "salary") -> Column:
    return band(salary, SALARY_BANDS, SALARY_REST)
