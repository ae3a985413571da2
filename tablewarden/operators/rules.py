"""Small rule tables that callers pass as Python rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewarden.materialize import materialize


def rules_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Rows as a written table: its size on disk decides whether a join broadcasts it."""
    return materialize(spark.createDataFrame(rows, ddl), "rules").frame
