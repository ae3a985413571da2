"""CSV, Parquet and JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablewarden.functions.casts import lenient_cast


# Header line, quotes doubled inside quoted fields, and an error instead of a silent shift
# of columns when the files of one folder have their columns in different orders.
CSV_OPTIONS = {"header": "true", "escape": '"', "enforceSchema": "false"}


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every field as text."""
    return spark.read.options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; columns are bound by header name, whatever their order.

    With a schema the file is read in one pass: each field is read as text under its
    header name and a cast that cannot succeed gives NULL. Without one Spark infers the
    types, which reads the file twice.
    """
    reader = spark.read.options(**CSV_OPTIONS)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    text = reader.csv(path)
    return text.select(
        *[
            lenient_cast(text[f.name], T.StringType(), f.dataType.simpleString()).alias(f.name)
            for f in schema
        ]
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Folder of CSV part files with headers, written by the executors."""
    df.write.mode("overwrite").options(header="true", escape='"').csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """Folder of JSON lines."""
    df.write.mode("overwrite").json(path)


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in the given order; a top-n per partition, not a full sort."""
    return df.orderBy(*order_by).limit(n)
