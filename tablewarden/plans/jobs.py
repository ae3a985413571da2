"""Whole jobs: load of filtered records, employee load with its metadata, sample graph."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.times import time_literal
from tablewarden.operators import entities as ent
from tablewarden.operators.audit import verify_catalog
from tablewarden.operators.lineage import build_edges
from tablewarden.operators.model import ENTITIES
from tablewarden.operators.quality import (
    require_castable,
    require_primary_key,
    require_reconciled,
    validate_structure,
)
from tablewarden.operators.search import search
from tablewarden.operators.tagging import apply_classification, tag_pii
from tablewarden.operators.transforms import ADULT_AGE, filter_with_counts, transform_employees
from tablewarden.sources.files import read_csv, read_csv_text, read_parquet, write_csv
from tablewarden.sources.schemas import EMPLOYEE_COLUMNS, EMPLOYEE_SCHEMA, SAMPLE_SCHEMA
from tablewarden.sources.tables import load_table

# Names and descriptions of the registered processes and of the target
# table, and the tag of employee data.
TRANSFORM_PROCESS = "employee_data_transformation"
TRANSFORM_TEXT = "Spark transformation to categorize employees and add derived columns"
LOAD_PROCESS = "employee_data_loading"
LOAD_TEXT = "Loading transformed employee data into the target table"
TARGET_TEXT = "Employee master data with classifications"
EMPLOYEE_TAG = "employee_data"

# Tables of the sample graph with their columns, comments and tags, and its processes.
_SAMPLE_KEYS = (
    "id INT COMMENT 'Primary identifier', name STRING COMMENT 'Person name', "
    "department STRING COMMENT 'Department name'"
)
SAMPLE_TABLES = {
    "source_data": (
        "Raw source data for ETL processing",
        f"{_SAMPLE_KEYS}, salary DOUBLE COMMENT 'Raw salary amount'",
        "ETL_Source",
    ),
    "transformed_data": (
        "Transformed data with adjustments",
        f"{_SAMPLE_KEYS}, adjusted_salary DOUBLE COMMENT 'Adjusted salary after calculations'",
        "ETL_Intermediate",
    ),
    "analytics_data": (
        "Final analytics data for reporting",
        f"{_SAMPLE_KEYS}, department_category STRING COMMENT 'Department category grouping', "
        "adjusted_salary DOUBLE COMMENT 'Adjusted salary', estimated_tax DOUBLE COMMENT 'Estimated tax amount'",
        "ETL_Target",
    ),
}
SAMPLE_PROCESSES = [
    ("extract_transform", "Extract and transform process", "source_data", "transformed_data"),
    ("load_enrich", "Load and enrich process", "transformed_data", "analytics_data"),
]


@dataclass(frozen=True)
class LoadResult:
    """Loaded table and the row counts taken while it was written."""

    table: DataFrame
    rows_before: int
    rows_after: int


@dataclass(frozen=True)
class Catalog:
    """Governance tables that a job has produced."""

    entities: DataFrame
    classifications: DataFrame
    process_io: DataFrame

    @property
    def edges(self) -> DataFrame:
        return build_edges(self.process_io)


def load_adults(
    spark: SparkSession, csv_path: str, parquet_path: str, table: str
) -> LoadResult:
    """CSV to filtered Parquet to managed table; the CSV rows are read once."""
    records = read_csv(spark, csv_path, SAMPLE_SCHEMA)
    kept, before, after = filter_with_counts(records, F.col("age") > ADULT_AGE)
    kept.write.mode("overwrite").parquet(parquet_path)
    loaded = load_table(read_parquet(spark, parquet_path), table)
    return LoadResult(loaded, before.get["rows"], after.get["rows"])


def register_runs(
    spark: SparkSession,
    runs: list[tuple[str, str, list[str], list[str]]],
    run_ts: datetime,
    epoch_mark: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Process entities and their inputs and outputs, for runs listed by hand."""
    rows = [(*run, run_ts) for run in runs]
    listed = spark.createDataFrame(
        rows,
        "name STRING, description STRING, inputs ARRAY<STRING>, outputs ARRAY<STRING>, "
        "run_ts TIMESTAMP_NTZ",
    )
    processes = ent.process_entities(listed, epoch_mark)
    io = ent.process_io(listed.join(processes.select("name", "guid"), "name"))
    return processes, io


def _guids(entities: DataFrame, type_name: str) -> dict[str, str]:
    """Guid by name for the few entities of one type that a job registers itself."""
    found = entities.filter(F.col("type_name") == type_name).select("name", "guid")
    return {row["name"]: row["guid"] for row in found.collect()}


def load_employees(
    spark: SparkSession,
    csv_path: str,
    out_csv_path: str,
    table: str,
    run_date: date,
    run_ts: datetime,
    existing: DataFrame | None = None,
) -> tuple[DataFrame, Catalog]:
    """Read, check, transform, write and load employees, then register all metadata.

    Metadata is registered only after the load is known to be whole.
    """
    require_castable(read_csv_text(spark, csv_path), EMPLOYEE_SCHEMA)
    source = validate_structure(read_csv(spark, csv_path, EMPLOYEE_SCHEMA), EMPLOYEE_SCHEMA)
    transformed = transform_employees(source, run_date)
    write_csv(transformed, out_csv_path)
    require_primary_key(transformed, ["id"])
    loaded = load_table(read_csv(spark, out_csv_path, transformed.schema), table)
    require_reconciled(source, loaded, ["id"])

    files = spark.createDataFrame([(csv_path,), (out_csv_path,)], "path STRING")
    datasets = ent.dataset_entities(files, "path", "CSV", create_time=time_literal(run_ts))
    db, _, name = table.rpartition(".")
    harvested = ent.harvest_schema(
        loaded,
        db,
        name,
        store="rdbms",
        description=TARGET_TEXT,
        create_time=run_ts,
    )
    by_path = {
        row["path"]: row["guid"]
        for row in datasets.select(F.col("attributes")["path"].alias("path"), "guid").collect()
    }
    table_guid = _guids(harvested, "rdbms_table")[name]
    processes, io = register_runs(
        spark,
        [
            (TRANSFORM_PROCESS, TRANSFORM_TEXT, [by_path[csv_path]], [by_path[out_csv_path]]),
            (LOAD_PROCESS, LOAD_TEXT, [by_path[out_csv_path]], [table_guid]),
        ],
        run_ts,
    )
    incoming = ent.bulk_batch(datasets, harvested, processes)
    known = spark.createDataFrame([], ENTITIES) if existing is None else existing
    catalog = ent.upsert_entities(known, incoming)
    is_data = F.col("type_name").isin(ent.FILE_TYPE, "rdbms_table")
    columns = harvested.filter("type_name = 'rdbms_column'").withColumn(
        "data_type", F.col("attributes")["type"]
    )
    pii = [(column, None) for column, _, _, is_pii in EMPLOYEE_COLUMNS if is_pii]
    tags = apply_classification(incoming, is_data, EMPLOYEE_TAG).unionByName(tag_pii(columns, pii))
    result = Catalog(catalog, tags, io)
    found = search(catalog, tags, type_name="rdbms_table", tag=EMPLOYEE_TAG, limit=10)
    verify_catalog(catalog, result.edges, found.select("type_name", "qualified_name"), [name])
    return loaded, result


def sample_graph(
    spark: SparkSession,
    db: str,
    pipeline: str,
    run_ts: datetime,
    existing: DataFrame | None = None,
) -> Catalog:
    """Database with three tables, two processes between them and a tag per table."""
    tables = [
        (name, T.StructType.fromDDL(ddl), description)
        for name, (description, ddl, _) in SAMPLE_TABLES.items()
    ]
    harvested = ent.harvest_tables(spark, db, tables, owner="admin", create_time=run_ts)
    guid = _guids(harvested, "hive_table")
    runs = [
        (f"{pipeline}_{step}", text, [guid[source]], [guid[target]])
        for step, text, source, target in SAMPLE_PROCESSES
    ]
    processes, io = register_runs(spark, runs, run_ts, epoch_mark=True)
    known = spark.createDataFrame([], ENTITIES) if existing is None else existing
    catalog = ent.upsert_entities(known, ent.bulk_batch(harvested, processes))
    is_table = F.col("type_name") == "hive_table"
    tagged = [
        apply_classification(catalog, is_table & (F.col("name") == name), tag)
        for name, (_, _, tag) in SAMPLE_TABLES.items()
    ]
    result = Catalog(catalog, ent.bulk_batch(*tagged), io)
    expected = spark.createDataFrame(
        [("hive_db", db)] + [("hive_table", name) for name in SAMPLE_TABLES],
        "type_name STRING, name STRING",
    )
    verify_catalog(catalog, result.edges, expected, ["transformed_data"])
    return result
