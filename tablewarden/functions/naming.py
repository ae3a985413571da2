"""Qualified names, guids and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the cluster part of a qualified name when none is given.
DEFAULT_CLUSTER = "primary"


def as_column(value: Column | str) -> Column:
    """A column as it is, a string as a column name."""
    return F.col(value) if isinstance(value, str) else value


def database_name(db: Column | str, cluster: str = DEFAULT_CLUSTER) -> Column:
    """``db@cluster``"""
    return F.concat(as_column(db), F.lit(f"@{cluster}"))


def table_name(db: Column | str, table: Column | str, cluster: str = DEFAULT_CLUSTER) -> Column:
    """``db.table@cluster``"""
    return F.concat(as_column(db), F.lit("."), as_column(table), F.lit(f"@{cluster}"))


def column_name(
    db: Column | str, table: Column | str, column: Column | str, cluster: str = DEFAULT_CLUSTER
) -> Column:
    """``db.table.column@cluster``"""
    parts = [as_column(db), F.lit("."), as_column(table), F.lit("."), as_column(column)]
    return F.concat(*parts, F.lit(f"@{cluster}"))


def process_name(name: Column | str, run_mark: Column, cluster: str = DEFAULT_CLUSTER) -> Column:
    """``name_<run mark>@cluster``; the mark is a run stamp or epoch seconds."""
    return F.concat(
        as_column(name), F.lit("_"), run_mark.cast("string"), F.lit(f"@{cluster}")
    )


def dataset_name(path: Column | str, cluster: str = DEFAULT_CLUSTER) -> Column:
    """``path@cluster``: the full path, because base names collide across folders."""
    return F.concat(as_column(path), F.lit(f"@{cluster}"))


def base_name(path: Column | str) -> Column:
    """Text after the last slash of a path."""
    return F.element_at(F.split(as_column(path), "/"), -1)


def entity_guid(type_name: Column | str, qualified_name: Column | str) -> Column:
    """Deterministic id, so that a rerun of a job names the same entity the same way."""
    key = F.concat_ws("|", as_column(type_name), as_column(qualified_name))
    return F.sha2(key, 256)
