"""Managed tables, delimited text tables and versioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.operators.model import ENTITIES, ENTITY_COLUMNS


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_database(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(db)}")


def load_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as the table ``db.table``, replacing it, and return the table.

    The table is managed unless a path for its files is given.
    """
    spark = df.sparkSession
    db, _, _ = name.rpartition(".")
    ensure_database(spark, db or "default")
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def create_text_table(
    spark: SparkSession, name: str, ddl: str, sep: str = ",", location: str | None = None
) -> DataFrame:
    """Delimited text table, created when absent."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({ddl}) "
        f"USING csv OPTIONS (sep '{sep}'){place}"
    )
    return spark.table(name)


def seed_table(
    spark: SparkSession, name: str, ddl: str, rows: list[tuple], comment: str = ""
) -> DataFrame:
    """Table with exactly the given rows: dropped, created with a comment and refilled."""
    note = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    spark.sql(f"CREATE TABLE {_quoted(name)} ({ddl}) USING parquet COMMENT '{note}'")
    if rows:
        spark.createDataFrame(rows, ddl).write.insertInto(name)
    return spark.table(name)


def publish_version(df: DataFrame, name: str, version: str) -> DataFrame:
    """Write a new version of a table, then point the view ``name`` at it.

    Readers see the old version until the new one is whole, and the new version may be
    computed from the old one because no file being read is overwritten.
    """
    spark = df.sparkSession
    versioned = f"{name}__{version}"
    df.write.mode("errorifexists").saveAsTable(versioned)
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT * FROM {_quoted(versioned)}")
    return spark.table(name)


def write_catalog(entities: DataFrame, path: str) -> None:
    """Entity table with one folder per type, so that a search by type skips the others.

    Rows are rebalanced by type: a small type becomes one file, and adaptive execution
    splits a type that holds most of the rows over many tasks.
    """
    spread = entities.hint("rebalance", F.col("type_name"))
    spread.write.mode("overwrite").partitionBy("type_name").parquet(path)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENTITIES).parquet(path).select(*ENTITY_COLUMNS)
