"""Deep pages of an ordered table.

The table is copied once in the order of its pages. Each range of the order is a folder, and
each row knows its place in its range. The numbers of rows per range, one short row each, are
summed to find the ranges that a page lies in; only these are read, and nothing is sorted.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a range, about.
RANGE_ROWS = 1_000_000
PLACE_BITS = 33


@dataclass(frozen=True)
class OrderedTable:
    """``starts[k]`` is the number of rows before range k; ``firsts`` the least key of each."""

    frame: DataFrame
    keys: tuple[str, ...]
    ranges: tuple[int, ...]
    starts: tuple[int, ...]
    firsts: tuple[tuple, ...]
    rows: int


def write_ordered(
    df: DataFrame, path: str, keys: tuple[str, ...] = ("qualified_name", "guid"), range_rows: int = RANGE_ROWS
) -> OrderedTable:
    """Copy ``df`` to ``path`` in the order of ``keys``, NULLs first.

    Rows of equal keys are ordered by all their columns, so that pages are the same whenever
    the copy is made from the same rows. They fall into one range: keys should be nearly
    unique. The rows are counted first, to choose the number of ranges.
    """
    spark = df.sparkSession
    ties = F.to_json(F.struct(*[c for c in df.columns if c not in keys]), {"ignoreNullFields": "false"})
    count = max(1, -(-df.count() // range_rows))
    # The number in the partition follows the sort: partition in the upper bits, row in the lower.
    place = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(count, *keys)
        .withColumn("_ties", ties)
        .sortWithinPartitions(*keys, "_ties")
        .drop("_ties")
        .withColumn("_at", place)
        .withColumn("_range", F.shiftright("_at", PLACE_BITS).cast("int"))
        .withColumn("_place", F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
        .drop("_at")
    )
    placed.write.partitionBy("_range").parquet(f"{path}/rows")
    written = read_rows(spark, path, df.schema)
    least = F.min(F.struct(*keys)).alias("least")
    sizes = written.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), least)
    sizes.coalesce(1).write.parquet(f"{path}/ranges")
    return read_ordered(spark, path, df.schema, keys)


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    fields = [*schema.fields, T.StructField("_place", T.LongType()), T.StructField("_range", T.IntegerType())]
    return spark.read.schema(T.StructType(fields)).parquet(f"{path}/rows")


def read_ordered(
    spark: SparkSession, path: str, schema: T.StructType, keys: tuple[str, ...] = ("qualified_name", "guid")
) -> OrderedTable:
    """The copy at ``path`` of a table of ``schema``; one short row per range comes to the driver."""
    sizes = spark.read.parquet(f"{path}/ranges").orderBy("_range").collect()
    sums = list(accumulate((r["n"] for r in sizes), initial=0))
    return OrderedTable(
        read_rows(spark, path, schema),
        tuple(keys),
        tuple(r["_range"] for r in sizes),
        tuple(sums[:-1]),
        tuple(tuple(r["least"]) for r in sizes),
        sums[-1],
    )


def page(table: OrderedTable, offset: int, limit: int) -> DataFrame:
    """The rows ``offset`` to ``offset + limit`` of the order, sorted; reads their ranges only."""
    end = min(offset + limit, table.rows)
    first = max(0, bisect.bisect_right(table.starts, offset) - 1)
    wanted = F.lit(False)
    touched = []
    for k in range(first, len(table.ranges)):
        begin = table.starts[k]
        if begin >= end:
            break
        touched.append(table.ranges[k])
        inside = F.col("_place").between(max(0, offset - begin), end - begin - 1)
        wanted = wanted | ((F.col("_range") == table.ranges[k]) & inside)
    found = table.frame.filter(F.col("_range").isin(touched)).filter(wanted)
    return found.orderBy("_range", "_place").drop("_range", "_place")


def _after(keys: tuple[str, ...], values: tuple) -> Column:
    """Whether a row's keys come after ``values``, NULLs first."""
    later, equal = F.lit(False), F.lit(True)
    for key, value in zip(keys, values):
        column = F.col(key)
        above = column.isNotNull() if value is None else column > F.lit(value)
        later = later | (equal & F.coalesce(above, F.lit(False)))
        equal = equal & column.eqNullSafe(F.lit(value))
    return later


def page_after(table: OrderedTable, last: tuple, limit: int) -> DataFrame:
    """The first ``limit`` rows whose keys come after ``last``, the keys of the last row seen.

    Reads the range of ``last`` and as many behind it as are sure to hold the page. Rows that
    share their keys with ``last`` count as seen: use offsets where keys repeat.
    """
    ordered = [tuple((v is not None, v) for v in first) for first in table.firsts]
    at = max(0, bisect.bisect_right(ordered, tuple((v is not None, v) for v in last)) - 1)
    # All rows of the ranges behind the first one come after ``last``.
    end = at + 1
    while end < len(table.ranges) and table.starts[end] - table.starts[min(at + 1, end)] < limit:
        end += 1
    found = table.frame.filter(F.col("_range").isin(list(table.ranges[at:end])))
    return found.filter(_after(table.keys, last)).orderBy("_range", "_place").limit(limit).drop("_range", "_place")
