"""Typed links between entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.naming import as_column


def link(df: DataFrame, rel_type: str, end1: Column | str, end2: Column | str) -> DataFrame:
    """Relationship rows from a table that holds both ends."""
    return df.select(
        F.lit(rel_type).alias("rel_type"),
        as_column(end1).alias("end1_guid"),
        as_column(end2).alias("end2_guid"),
    )
