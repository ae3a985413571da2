"""Transforms, banding, casts and counts on small records with known results."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tablewarden.functions.casts import lenient_cast
from tablewarden.operators import transforms as tr
from tablewarden.plans.record_queries import EMPLOYEE_MAPPING

# The ten rows of each record file.
SAMPLE = [
    (1, "John Doe", 45, "Engineering", 85000),
    (2, "Jane Smith", 22, "Marketing", 62000),
    (3, "Robert Johnson", 17, "Intern", 25000),
    (4, "Lisa Williams", 29, "Sales", 71000),
    (5, "Michael Brown", 19, "Intern", 27000),
    (6, "Sarah Miller", 38, "Finance", 92000),
    (7, "David Wilson", 16, "Intern", 24000),
    (8, "Jennifer Taylor", 31, "Human Resources", 68000),
    (9, "William Davis", 55, "Executive", 120000),
    (10, "Emily Anderson", 27, "Engineering", 75000),
]
SAMPLE_DDL = "id INT, name STRING, age INT, department STRING, salary INT"
EMPLOYEES = [
    (1, "John Doe", 32, 75000, "IT"),
    (2, "Jane Smith", 28, 82000, "HR"),
    (3, "Bob Johnson", 45, 95000, "Finance"),
    (4, "Alice Brown", 36, 88000, "Marketing"),
    (5, "Charlie Davis", 29, 72000, "IT"),
    (6, "Eva Wilson", 52, 110000, "Finance"),
    (7, "Frank Miller", 38, 91000, "Marketing"),
    (8, "Grace Lee", 41, 86000, "HR"),
    (9, "Henry Garcia", 33, 79000, "IT"),
    (10, "Ivy Martinez", 27, 68000, "Marketing"),
]
EMPLOYEE_DDL = "id INT, name STRING, age INT, salary INT, department STRING"


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(SAMPLE, SAMPLE_DDL)


@pytest.fixture(scope="module")
def employees(spark):
    return spark.createDataFrame(EMPLOYEES, EMPLOYEE_DDL)


def test_adults_of_sample(sample):
    ids = sorted(r.id for r in tr.filter_adults(sample).collect())
    assert ids == [1, 2, 4, 5, 6, 8, 9, 10]


def test_adult_filter_drops_boundary_and_null(spark):
    df = spark.createDataFrame([(1, 18), (2, 19), (3, None)], "id INT, age INT")
    assert [r.id for r in tr.filter_adults(df).collect()] == [2]


def test_counts_ride_on_one_write(sample, tmp_path):
    kept, before, after = tr.filter_with_counts(sample, F.col("age") > 18)
    kept.write.parquet(str(tmp_path / "kept"))
    assert (before.get["rows"], after.get["rows"]) == (10, 8)


def test_filter_counts(sample):
    row = tr.filter_counts(sample, F.col("age") > 18).first()
    assert tuple(row) == (10, 8, 2)


def test_bands_of_employees(employees):
    got = {
        r.id: (r.employee_category, r.salary_band)
        for r in tr.transform_employees(employees, "2025-05-20").collect()
    }
    assert got == {
        1: ("Mid-Level", "Band 2"),
        2: ("Junior", "Band 2"),
        3: ("Senior", "Band 3"),
        4: ("Mid-Level", "Band 2"),
        5: ("Junior", "Band 1"),
        6: ("Senior", "Band 3"),
        7: ("Mid-Level", "Band 3"),
        8: ("Senior", "Band 2"),
        9: ("Mid-Level", "Band 2"),
        10: ("Junior", "Band 1"),
    }


def test_transform_schema(employees):
    out = tr.transform_employees(employees, date(2025, 5, 20))
    types = dict(out.dtypes)
    assert types["salary"] == "double" and types["age"] == "int"
    assert types["processed_date"] == "date"
    assert out.first().processed_date == date(2025, 5, 20)


@pytest.mark.parametrize(
    "age, salary, category, band",
    [
        (29, 74999.99, "Junior", "Band 1"),
        (30, 75000.0, "Mid-Level", "Band 2"),
        (39, 89999.99, "Mid-Level", "Band 2"),
        (40, 90000.0, "Senior", "Band 3"),
        (None, None, "Senior", "Band 3"),
    ],
)
def test_band_boundaries(spark, age, salary, category, band):
    df = spark.createDataFrame([(age, salary)], "age INT, salary DOUBLE")
    row = tr.transform_employees(df, "2025-05-20").first()
    assert (row.employee_category, row.salary_band) == (category, band)


def test_cast_of_text_is_lenient(spark):
    df = spark.createDataFrame([("x", "1e3"), ("41", "y")], "age STRING, salary STRING")
    assert [tuple(r) for r in tr.cast_employee(df).collect()] == [(None, 1000.0), (41, None)]


ODD_TEXT = [
    "1", "-7", "+3", " 12 ", "\t5\n", "\x7f8", "1.5", ".5", "5.", ".", "", " ", "+", "1e3", "0x1", "x",
    "2147483647", "2147483648", "9223372036854775807", "9223372036854775808", "5-LOW", "1 2",
    "true", "T", " Yes ", "n", "0", "on", "tru", "\u0661", "\u20035", "--1", "1.x", None,
]


@pytest.mark.parametrize("target", ["int", "bigint", "smallint", "boolean", "double", "date"])
def test_lenient_cast_is_try_cast(spark, target):
    df = spark.createDataFrame([(t,) for t in ODD_TEXT], "t STRING")
    source = df.schema["t"].dataType
    both = df.select(
        "t",
        lenient_cast(F.col("t"), source, target).alias("a"),
        F.col("t").try_cast(target).alias("b"),
    )
    assert both.filter("NOT (a <=> b)").collect() == []


def test_transform_needs_no_shuffle(employees):
    plan = tr.transform_employees(employees, "2025-05-20")._jdf.queryExecution()
    assert "Exchange" not in plan.executedPlan().toString()


def test_mapping_matches_transform(employees):
    df = employees.withColumn("line", F.lit(1))
    mapped = tr.apply_mapping(df, EMPLOYEE_MAPPING)
    plain = tr.transform_employees(df, "2024-01-31")
    pick = ["employee_category", "salary_band", "processed_date"]
    assert mapped.select("employee_id", *pick).collect() == plain.select("id", *pick).collect()
