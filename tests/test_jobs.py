"""Whole jobs on the ten-row files, and the incremental run."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from test_records import EMPLOYEES, SAMPLE
from tablewarden.operators import lineage as lin
from tablewarden.operators.entities import harvest_database
from tablewarden.operators.quality import DataQualityError
from tablewarden.operators.search import search
from tablewarden.operators.transforms import filter_adults
from tablewarden.plans import jobs
from tablewarden.sources.schemas import SAMPLE_SCHEMA
from tablewarden.streaming.ingest import ingest_new_files, register_new_files

NOW = datetime(2025, 5, 20, 12, 0, 0)


def csv(path, header, rows):
    lines = [header, *(",".join(map(str, row)) for row in rows)]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


SAMPLE_HEADER = "id,name,age,department,salary"
EMPLOYEE_HEADER = "id,name,age,salary,department"


def test_load_adults(spark, tmp_path):
    source = csv(tmp_path / "data.csv", SAMPLE_HEADER, SAMPLE)
    done = jobs.load_adults(spark, source, str(tmp_path / "out"), "job.transformed_data")
    assert (done.rows_before, done.rows_after) == (10, 8)
    assert sorted(r.id for r in done.table.collect()) == [1, 2, 4, 5, 6, 8, 9, 10]
    harvested = harvest_database(spark, "job")
    names = {r.qualified_name for r in harvested.collect()}
    assert {"job@primary", "job.transformed_data@primary", "job.transformed_data.age@primary"} <= names


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("employees")
    source = csv(folder / "employees.csv", EMPLOYEE_HEADER, EMPLOYEES)
    return jobs.load_employees(
        spark, source, str(folder / "employees_transformed"), "emp_db.employees", date(2025, 5, 20), NOW
    )


def test_employees_are_loaded(loaded):
    table, _ = loaded
    row = table.filter("id = 1").first()
    assert (row.employee_category, row.salary_band, row.processed_date) == (
        "Mid-Level",
        "Band 2",
        date(2025, 5, 20),
    )
    assert table.count() == 10


def test_employee_metadata(loaded):
    _, catalog = loaded
    count = {r.type_name: r["count"] for r in catalog.entities.groupBy("type_name").count().collect()}
    assert count == {
        "fs_path": 2,
        "rdbms_db": 1,
        "rdbms_table": 1,
        "rdbms_column": 8,
        "etl_process": 2,
    }
    pii = catalog.classifications.filter("classification = 'PII'").join(catalog.entities, "guid")
    assert sorted(r.name for r in pii.collect()) == ["age", "name", "salary"]
    tagged = search(catalog.entities, catalog.classifications, tag="employee_data")
    assert sorted(r.type_name for r in tagged.collect()) == ["fs_path", "fs_path", "rdbms_table"]


def test_employee_lineage_runs_from_file_to_table(spark, loaded):
    _, catalog = loaded
    root = catalog.entities.filter("name = 'employees.csv'").select("guid")
    reached = lin.lineage(catalog.edges, root, direction="OUTPUT").join(catalog.entities, "guid")
    assert [r.name for r in reached.orderBy("hop").collect()] == [
        "employees.csv",
        "employee_data_transformation",
        "employees_transformed",
        "employee_data_loading",
        "employees",
    ]


def test_repeated_key_stops_the_load(spark, tmp_path):
    source = csv(tmp_path / "e.csv", EMPLOYEE_HEADER, EMPLOYEES + EMPLOYEES[:1])
    with pytest.raises(DataQualityError, match="id"):
        jobs.load_employees(spark, source, str(tmp_path / "o"), "bad.employees", date(2025, 5, 20), NOW)


def test_sample_graph(spark):
    catalog = jobs.sample_graph(spark, "demo", "sample_etl", NOW)
    count = {r.type_name: r["count"] for r in catalog.entities.groupBy("type_name").count().collect()}
    assert count == {"hive_db": 1, "hive_table": 3, "hive_column": 14, "etl_process": 2}
    assert catalog.edges.count() == 4
    tags = catalog.classifications.join(catalog.entities, "guid").collect()
    assert {(r.name, r.classification) for r in tags} == {
        ("source_data", "ETL_Source"),
        ("transformed_data", "ETL_Intermediate"),
        ("analytics_data", "ETL_Target"),
    }


def test_sample_graph_twice_adds_only_processes(spark):
    first = jobs.sample_graph(spark, "demo", "sample_etl", NOW)
    later = jobs.sample_graph(spark, "demo", "sample_etl", datetime(2025, 5, 21), first.entities)
    assert later.entities.count() == first.entities.count() + 2


def test_incremental_run_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def run():
        return ingest_new_files(
            spark,
            str(landing),
            SAMPLE_SCHEMA,
            str(tmp_path / "target"),
            str(tmp_path / "progress"),
            filter_adults,
            "csv",
        )

    csv(landing / "day1.csv", SAMPLE_HEADER, SAMPLE[:5])
    assert sorted(r.id for r in run().collect()) == [1, 2, 4, 5]
    assert run().count() == 4
    csv(landing / "day2.csv", SAMPLE_HEADER, SAMPLE[5:])
    assert sorted(r.id for r in run().collect()) == [1, 2, 4, 5, 6, 8, 9, 10]


def test_new_files_are_registered_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def run():
        return register_new_files(
            spark, str(landing), str(tmp_path / "t"), str(tmp_path / "p"), "CSV", "*.csv"
        )

    csv(landing / "a.csv", SAMPLE_HEADER, SAMPLE)
    (landing / "a.txt").write_text("no")
    assert [r.name for r in run().collect()] == ["a.csv"]
    csv(landing / "b.csv", SAMPLE_HEADER, SAMPLE)
    found = run()
    assert sorted(r.name for r in found.collect()) == ["a.csv", "b.csv"]
    assert found.filter(F.col("create_time").isNull()).count() == 0
