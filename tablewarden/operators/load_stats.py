"""Column statistics of each load as sketches, and of all loads without reading them again.

A load leaves one short row per column: exact counts and bounds, a sketch of its distinct
values and, for numbers, one of its quantiles. Sketches of several loads are merged into the
sketch that all their rows together would have given, up to its error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Size of the sketch of distinct values (2 ** LOG_SIZE registers: a standard error of 1.6 %) and
# of quantiles (a rank error of 1.4 % with 99 % confidence).
LOG_SIZE = 12
QUANTILE_SIZE = 200
# Greatest relative error of distinct counts, and of the rank of a quantile, that tests allow.
DISTINCT_ERROR = 0.05
RANK_ERROR = 0.03

LOAD_STATS = (
    "column_name STRING, data_type STRING, n_rows BIGINT, n_nulls BIGINT, least DOUBLE, greatest DOUBLE, "
    "distinct_sketch BINARY, quantile_sketch BINARY"
)


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _is_plain(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def sketch_load(df: DataFrame) -> DataFrame:
    """One row of statistics per plain column of a load, in one pass over its rows.

    Values are told apart as text, numbers after adding zero, so that -0.0 is 0.0. Columns of
    nested types are left out. An empty load gives rows with counts of zero.
    """
    fields = [f for f in df.schema.fields if _is_plain(f.dataType)]
    sums: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    rows = []
    for at, field in enumerate(fields):
        column = F.col(f"`{field.name}`")
        number = _is_number(field.dataType)
        real = column.cast("double") + F.lit(0.0)
        text = (column + F.lit(0).cast(field.dataType) if number else column).cast("string")
        sums.append(F.count_if(column.isNull()).alias(f"nulls{at}"))
        sums.append(F.hll_sketch_agg(text, F.lit(LOG_SIZE)).alias(f"distinct{at}"))
        none = F.lit(None)
        if number:
            sums += [F.min(real).alias(f"least{at}"), F.max(real).alias(f"greatest{at}")]
            sums.append(F.kll_sketch_agg_double(real, QUANTILE_SIZE).alias(f"quantiles{at}"))
        rows.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col("n_rows"),
                F.col(f"nulls{at}").alias("n_nulls"),
                (F.col(f"least{at}") if number else none.cast("double")).alias("least"),
                (F.col(f"greatest{at}") if number else none.cast("double")).alias("greatest"),
                F.col(f"distinct{at}").alias("distinct_sketch"),
                (F.col(f"quantiles{at}") if number else none.cast("binary")).alias("quantile_sketch"),
            )
        )
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def store_load(df: DataFrame, path: str, load: str) -> None:
    """Store the statistics of a load; a load that is run again replaces its own."""
    if not load or set(load) & set("/=\\"):
        raise ValueError(f"not a name of a load: {load!r}")
    sketch_load(df).coalesce(1).write.mode("overwrite").parquet(f"{path}/load={load}")


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows of all loads, with the name of their load."""
    return spark.read.schema(f"{LOAD_STATS}, load STRING").parquet(path)


def merged_stats(loads: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Statistics over all given loads: counts and bounds exact, distinct values and quantiles
    estimated; quantiles are NULL for what is no number."""
    merged = loads.groupBy("column_name").agg(
        F.count_distinct("load").alias("n_loads"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch", QUANTILE_SIZE).alias("quantile_sketch"),
    )
    # A sketch without values has no quantile.
    filled = F.col("least").isNotNull()
    values = F.array(
        *[F.kll_sketch_get_quantile_double(F.when(filled, F.col("quantile_sketch")), F.lit(q)) for q in quantiles]
    )
    return merged.select(
        "column_name", "n_loads", "n_rows", "n_nulls", "least", "greatest",
        F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"),
        F.when(filled, values).alias("quantiles"),
    )


def measured_errors(df: DataFrame, stats: DataFrame, at: int = 1, quantile: float = 0.5) -> DataFrame:
    """(column_name, distinct_error, rank_error): how far the estimates are from ``df``.

    Reads the rows again, for a check. ``at`` is the place of ``quantile`` in the estimates.
    """
    names = [r["column_name"] for r in stats.select("column_name").collect()]
    estimates = {r["column_name"]: r for r in stats.collect()}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for name in names:
        column, row = F.col(f"`{name}`"), estimates[name]
        rank = F.lit(None).cast("double")
        if row["quantiles"] is not None and _is_number(kinds[name]):
            value = F.lit(row["quantiles"][at])
            below, upto = F.count_if(column < value), F.count_if(column <= value)
            # A value that repeats has all ranks from the first to the last of its copies.
            rank = F.greatest(
                below / F.count(column) - F.lit(quantile), F.lit(quantile) - upto / F.count(column), F.lit(0.0)
            )
        exact = F.count_distinct(column + F.lit(0).cast(kinds[name]) if _is_number(kinds[name]) else column)
        error = F.abs(exact - F.lit(row["n_distinct"])) / F.greatest(exact, F.lit(1))
        parts.append(df.agg(F.lit(name).alias("column_name"), error.alias("distinct_error"), rank.alias("rank_error")))
    return reduce(DataFrame.unionByName, parts)
