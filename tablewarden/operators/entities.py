"""Building, merging and resolving entity rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions import naming, times
from tablewarden.functions.documents import default_description
from tablewarden.operators.model import ACTIVE, DELETED, ENTITIES, ENTITY_COLUMNS

# Fixed value: owner of entities that a job registers.
SERVICE_OWNER = "ETL_SERVICE"

# Type names of the registered objects, by kind of store.
FILE_TYPE = "fs_path"
PROCESS_TYPE = "etl_process"
PROCESS_KIND = "SPARK_TRANSFORMATION"
STORE_TYPES = {
    "hive": ("hive_db", "hive_table", "hive_column"),
    "rdbms": ("rdbms_db", "rdbms_table", "rdbms_column"),
}

NO_ATTRIBUTES = "CAST(map() AS MAP<STRING,STRING>)"


def entity_rows(
    df: DataFrame,
    type_name: Column | str,
    qualified_name: Column | str,
    name: Column | str,
    owner: Column | str | None = None,
    description: Column | str | None = None,
    create_time: Column | str | None = None,
    attributes: Column | None = None,
) -> DataFrame:
    """Entity rows from any table; each argument is a column of it or NULL."""

    def text(value: Column | str | None) -> Column:
        return (F.lit(None) if value is None else naming.as_column(value)).cast("string")

    created = F.lit(None) if create_time is None else naming.as_column(create_time)
    return df.select(
        text(type_name).alias("type_name"),
        text(qualified_name).alias("qualified_name"),
        text(name).alias("name"),
        text(owner).alias("owner"),
        text(description).alias("description"),
        F.lit(ACTIVE).alias("status"),
        created.cast("timestamp_ntz").alias("create_time"),
        (F.expr(NO_ATTRIBUTES) if attributes is None else attributes).alias("attributes"),
    ).select(
        naming.entity_guid("type_name", "qualified_name").alias("guid"), *ENTITY_COLUMNS[1:]
    )


def bulk_batch(*batches: DataFrame) -> DataFrame:
    """One batch of entities of several types; columns a part lacks become NULL."""
    merged, *others = batches
    for batch in others:
        merged = merged.unionByName(batch, allowMissingColumns=True)
    return merged


def first_by_key(entities: DataFrame) -> DataFrame:
    """The earliest entity per (type_name, qualified_name).

    Rank 1 of a window is kept per task before the shuffle (a window group limit), so a
    key that is repeated in a large share of the rows stays cheap. Rows without a time come
    last, and ties are broken by all other columns.
    """
    first = Window.partitionBy("type_name", "qualified_name").orderBy(
        F.asc_nulls_last("create_time"),
        "name",
        "owner",
        "description",
        "status",
        F.to_json(F.array_sort(F.map_entries("attributes"))),
    )
    return entities.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def new_entities(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming entities whose key is not known yet, one row per key."""
    return first_by_key(incoming).join(
        existing.select("type_name", "qualified_name"),
        ["type_name", "qualified_name"],
        "left_anti",
    ).select(*incoming.columns)


def upsert_entities(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Get-or-create in bulk: known entities stay as they are, unknown ones are added."""
    return existing.unionByName(new_entities(existing, incoming), allowMissingColumns=True)


def expected_key(expected: DataFrame) -> str:
    """What names an expected entity within its type: its qualified name where it is given."""
    return "qualified_name" if "qualified_name" in expected.columns else "name"


def missing_entities(entities: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected entities without a live one, each once. One without a status is live.

    ``expected`` has (type_name, qualified_name), or (type_name, name) where any database
    will do. Both sides are made distinct first: names repeat, and a repeated name would put
    all its rows into one join partition.
    """
    key = ["type_name", expected_key(expected)]
    live = entities.filter(~F.col("status").eqNullSafe(DELETED)).select(*key).distinct()
    wanted = expected.select(*key).distinct()
    return wanted.join(live, key, "left_anti")


def resolve_refs(
    child: DataFrame, parent: DataFrame, parent_type: str, prefix: str = "parent"
) -> DataFrame:
    """Follow references to a parent entity, given by guid or by qualified name.

    ``child`` has ``ref_guid`` and/or ``ref_qualified_name``. A qualified name gives the
    guid by the naming rule, so one equi join serves both forms. References without a
    parent give NULL. A parent that many children name is a hot join key: adaptive
    execution splits its partition on the child side.
    """
    named = naming.entity_guid(F.lit(parent_type), "ref_qualified_name")
    named = F.when(F.col("ref_qualified_name").isNotNull(), named)
    if "ref_guid" not in child.columns:
        key = named
    elif "ref_qualified_name" not in child.columns:
        key = F.col("ref_guid")
    else:
        key = F.coalesce(F.col("ref_guid"), named)
    keyed = child.withColumn("_ref", key)
    known = parent.filter(F.col("type_name") == parent_type).select(
        F.col("guid").alias(f"{prefix}_guid"), F.col("name").alias(f"{prefix}_name")
    )
    joined = keyed.join(known, keyed["_ref"] == known[f"{prefix}_guid"], "left")
    return joined.drop("_ref", "ref_guid", "ref_qualified_name")


def harvest_tables(
    spark: SparkSession,
    db: str,
    tables: list[tuple[str, T.StructType, str | None]],
    cluster: str = naming.DEFAULT_CLUSTER,
    store: str = "hive",
    owner: str = SERVICE_OWNER,
    create_time: datetime | None = None,
) -> DataFrame:
    """Entities of a database, its tables (name, schema, description) and their columns.

    Only schemas are read. All tables go into one plan, however many there are.
    """
    db_type, table_type, column_type = STORE_TYPES[store]
    created = times.time_literal(create_time)
    listed = spark.createDataFrame(
        [(db, name, description) for name, _, description in tables],
        "db STRING, tab STRING, description STRING",
    )
    columns = spark.createDataFrame(
        [
            (db, name, c.name, c.dataType.simpleString(), c.metadata.get("comment", ""), str(i))
            for name, schema, _ in tables
            for i, c in enumerate(schema)
        ],
        "db STRING, tab STRING, col STRING, data_type STRING, comment STRING, position STRING",
    )
    database = entity_rows(
        listed.select("db").distinct(),
        F.lit(db_type),
        naming.database_name("db", cluster),
        "db",
        F.lit(owner),
        default_description(F.lit(None).cast("string"), "db", "database"),
        created,
    )
    table_entities = entity_rows(
        listed,
        F.lit(table_type),
        naming.table_name("db", "tab", cluster),
        "tab",
        F.lit(owner),
        default_description("description", "tab", "table"),
        created,
        F.create_map(F.lit("db"), naming.database_name("db", cluster)),
    )
    column_entities = entity_rows(
        columns,
        F.lit(column_type),
        naming.column_name("db", "tab", "col", cluster),
        "col",
        F.lit(owner),
        "comment",
        created,
        F.create_map(
            F.lit("type"),
            F.col("data_type"),
            F.lit("position"),
            F.col("position"),
            F.lit("table"),
            naming.table_name("db", "tab", cluster),
        ),
    )
    return bulk_batch(database, table_entities, column_entities)


def harvest_schema(
    df: DataFrame,
    db: str,
    table: str,
    cluster: str = naming.DEFAULT_CLUSTER,
    store: str = "hive",
    owner: str = SERVICE_OWNER,
    description: str | None = None,
    create_time: datetime | None = None,
) -> DataFrame:
    """Entities of one table, its database and its columns."""
    tables = [(table, df.schema, description)]
    return harvest_tables(df.sparkSession, db, tables, cluster, store, owner, create_time)


def harvest_database(
    spark: SparkSession, db: str, cluster: str = naming.DEFAULT_CLUSTER
) -> DataFrame:
    """Entities of every table of a database, read from the session catalog."""
    tables = [
        (t.name, spark.table(f"{db}.{t.name}").schema, t.description)
        for t in spark.catalog.listTables(db)
        if not t.isTemporary
    ]
    if not tables:
        return spark.createDataFrame([], ENTITIES)
    return harvest_tables(spark, db, tables, cluster)


def dataset_entities(
    files: DataFrame,
    path: str,
    file_format: str,
    subject: str = "Employee data",
    create_time: Column | str | None = None,
) -> DataFrame:
    """File entities, named by base name and keyed by full path."""
    return entity_rows(
        files,
        F.lit(FILE_TYPE),
        naming.dataset_name(path),
        naming.base_name(path),
        F.lit(SERVICE_OWNER),
        F.lit(f"{subject} file in {file_format} format"),
        create_time,
        F.create_map(F.lit("path"), F.col(path), F.lit("format"), F.lit(file_format)),
    )


def process_entities(
    runs: DataFrame,
    epoch_mark: bool = False,
    cluster: str = naming.DEFAULT_CLUSTER,
    process_type: str = PROCESS_KIND,
) -> DataFrame:
    """Process entities of runs (name, description, run_ts).

    The run time is part of the qualified name, so a process is a new entity each run.
    """
    mark = times.to_epoch_seconds("run_ts") if epoch_mark else times.run_stamp("run_ts")
    return entity_rows(
        runs,
        F.lit(PROCESS_TYPE),
        naming.process_name("name", mark, cluster),
        "name",
        F.lit(SERVICE_OWNER),
        default_description("description", "name", "process"),
        "run_ts",
        F.create_map(F.lit("process_type"), F.lit(process_type)),
    )


def process_io(runs: DataFrame) -> DataFrame:
    """Inputs and outputs of processes (guid, inputs ARRAY, outputs ARRAY) as rows."""
    sides = F.array(
        F.struct(F.lit("input").alias("direction"), F.col("inputs").alias("guids")),
        F.struct(F.lit("output").alias("direction"), F.col("outputs").alias("guids")),
    )
    return runs.select(F.col("guid").alias("process_guid"), F.inline(sides)).select(
        "process_guid", "direction", F.explode("guids").alias("dataset_guid")
    )
