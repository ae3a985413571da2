"""Fixed record schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, order and types of the record files and their target table.
SAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("department", T.StringType()),
        T.StructField("salary", T.IntegerType()),
    ]
)

EMPLOYEE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("salary", T.IntegerType()),
        T.StructField("department", T.StringType()),
    ]
)

EMPLOYEE_TARGET_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("salary", T.DoubleType()),
        T.StructField("department", T.StringType()),
        T.StructField("employee_category", T.StringType()),
        T.StructField("salary_band", T.StringType()),
        T.StructField("processed_date", T.DateType()),
    ]
)

# Relational column types of the target table.
EMPLOYEE_TARGET_DDL = (
    "id INTEGER, name VARCHAR(255), age INTEGER, salary DOUBLE PRECISION, "
    "department VARCHAR(100), employee_category VARCHAR(50), salary_band VARCHAR(50), "
    "processed_date DATE"
)

# Name, type, description and PII flag of the target columns.
EMPLOYEE_COLUMNS = [
    ("id", "INTEGER", "Employee ID", False),
    ("name", "VARCHAR", "Employee name", True),
    ("age", "INTEGER", "Employee age", True),
    ("salary", "DOUBLE", "Employee base salary", True),
    ("department", "VARCHAR", "Employee department", False),
    ("employee_category", "VARCHAR", "Employee seniority category", False),
    ("salary_band", "VARCHAR", "Salary band classification", False),
    ("processed_date", "DATE", "Date when record was processed", False),
]
