"""Column-level lineage and schema changes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.functions import naming, times
from tablewarden.operators.entities import SERVICE_OWNER, entity_rows

# Fixed value: type of the process between the columns of two tables.
COLUMN_PROCESS_TYPE = "ColumnLineageProcess"


def column_lineage(columns: DataFrame, mapping: DataFrame) -> DataFrame:
    """Edges from source to target columns.

    ``columns`` has guid, table_name and name; ``mapping`` has src_table, src_column,
    dst_table and dst_column. A mapping row that names an unknown column is skipped.
    """
    source = columns.select(
        F.col("table_name").alias("src_table"),
        F.col("name").alias("src_column"),
        F.col("guid").alias("src_guid"),
    )
    target = columns.select(
        F.col("table_name").alias("dst_table"),
        F.col("name").alias("dst_column"),
        F.col("guid").alias("dst_guid"),
    )
    return (
        mapping.join(source, ["src_table", "src_column"])
        .join(target, ["dst_table", "dst_column"])
        .select("src_table", "dst_table", "src_guid", "dst_guid")
    )


def _process_key(run_ts: datetime) -> Column:
    """Qualified name of the process that maps one table to another in one run."""
    seconds = times.to_epoch_seconds(times.time_literal(run_ts)).cast("string")
    tables = [F.col("src_table"), F.lit("_to_"), F.col("dst_table"), F.lit("_")]
    return F.concat(F.lit("column_lineage_"), *tables, seconds)


def column_processes(mapping: DataFrame, run_ts: datetime) -> DataFrame:
    """Process entities, one per pair of mapped tables."""
    pairs = mapping.select("src_table", "dst_table").distinct()
    name = F.concat(
        F.lit("column_mapping_"), F.col("src_table"), F.lit("_to_"), F.col("dst_table")
    )
    return entity_rows(
        pairs,
        F.lit(COLUMN_PROCESS_TYPE),
        _process_key(run_ts),
        name,
        F.lit(SERVICE_OWNER),
        None,
        times.time_literal(run_ts),
        F.create_map(F.lit("dependencyType"), F.lit("EXPRESSION")),
    )


def column_process_io(columns: DataFrame, mapping: DataFrame, run_ts: datetime) -> DataFrame:
    """Inputs and outputs of the column processes.

    Source and target names are looked up independently: a known source stays an input
    even when its target is unknown, and the other way round.
    """
    guid = naming.entity_guid(F.lit(COLUMN_PROCESS_TYPE), _process_key(run_ts))
    sides = F.array(
        F.struct(
            F.lit("input").alias("direction"),
            F.col("src_table").alias("table_name"),
            F.col("src_column").alias("name"),
        ),
        F.struct(
            F.lit("output").alias("direction"),
            F.col("dst_table").alias("table_name"),
            F.col("dst_column").alias("name"),
        ),
    )
    named = mapping.select("src_table", "dst_table", F.inline(sides)).distinct()
    known = columns.select("table_name", "name", "guid")
    return named.join(known, ["table_name", "name"]).select(
        guid.alias("process_guid"), "direction", F.col("guid").alias("dataset_guid")
    )


def schema_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Columns added, removed or retyped between two runs.

    Both tables hold one row per column: the key columns (table and column name) and
    ``data_type``. Unchanged columns give no row.
    """
    before = old.select(*keys, F.col("data_type").alias("old_type"))
    after = new.select(*keys, F.col("data_type").alias("new_type"))
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
    )
    return (
        before.join(after, keys, "full_outer")
        .withColumn("change", change)
        .filter("change IS NOT NULL")
    )


def schema_intervals(
    snapshots: DataFrame, runs: DataFrame, keys: list[str], tasks: int | None = None
) -> DataFrame:
    """Validity intervals of columns over many runs: keys, data_type, from_run, to_run.

    ``snapshots`` has a row per run, key and ``data_type``; ``runs`` the numbers of all runs in
    ``run``, also of those that found no column at all. An interval holds from ``from_run`` up
    to but without ``to_run``, which is NULL while it lasts. A column that is gone for some
    runs, or changes its type, begins a new interval. Runs are numbered one after the other
    (a row per run, however many columns there are), then one window per column finds where
    a stretch of runs with the same type begins. Of a column that a run has twice, the
    type that sorts first counts; a NULL type is a type. ``tasks`` is the number of tasks that
    share the columns, each of which sorts its own; without it the session's settings decide.
    """
    order = Window.orderBy("run")
    numbered = runs.select("run").distinct().select(
        "run", F.row_number().over(order).alias("_n"), F.lead("run").over(order).alias("_next")
    )
    dealt = snapshots.repartition(tasks, *keys) if tasks else snapshots
    once = dealt.groupBy(*keys, "run").agg(F.min("data_type").alias("data_type"))
    own = Window.partitionBy(*keys).orderBy("_n")
    before = F.lag(F.struct("_n", "data_type")).over(own)
    same = (before["_n"] == F.col("_n") - 1) & before["data_type"].eqNullSafe(F.col("data_type"))
    stretch = F.sum((~F.coalesce(same, F.lit(False))).cast("int")).over(own)
    marked = once.join(numbered, "run").withColumn("_stretch", stretch)
    ends = marked.groupBy(*keys, "_stretch").agg(
        F.first("data_type").alias("data_type"),
        F.min("run").alias("from_run"),
        F.max_by("_next", "_n").alias("to_run"),
    )
    return ends.drop("_stretch")


def schema_as_of(intervals: DataFrame, run: Column) -> DataFrame:
    """The columns that a run had: the keys and ``data_type`` of the intervals around it."""
    held = (F.col("from_run") <= run) & (F.col("to_run").isNull() | (run < F.col("to_run")))
    return intervals.filter(held).drop("from_run", "to_run")


def schema_changes(intervals: DataFrame, keys: list[str], first_run: Column) -> DataFrame:
    """All changes over all runs in one pass: keys, run, old_type, new_type, change.

    The columns of ``first_run`` are what the others are compared with and are no change. A
    column that comes back after a break is added again.
    """
    own = Window.partitionBy(*keys).orderBy("from_run")
    rows = intervals.withColumns(
        {
            "_old": F.lag(F.struct("to_run", "data_type")).over(own),
            "_back": F.lead("from_run").over(own),
        }
    )
    goes_on = F.coalesce(F.col("_old.to_run") == F.col("from_run"), F.lit(False))
    begun = F.struct(
        F.col("from_run").alias("run"),
        F.when(goes_on, F.col("_old.data_type")).alias("old_type"),
        F.col("data_type").alias("new_type"),
        F.when(goes_on, "retyped").when(F.col("from_run") != first_run, "added").alias("change"),
    )
    gone = F.col("to_run").isNotNull() & ~F.col("to_run").eqNullSafe(F.col("_back"))
    ended = F.struct(
        F.col("to_run").alias("run"),
        F.col("data_type").alias("old_type"),
        F.lit(None).cast("string").alias("new_type"),
        F.when(gone, "removed").alias("change"),
    )
    return rows.select(*keys, F.inline(F.array(begun, ended))).filter("change IS NOT NULL")
