"""Search for parts of texts with an inverted table of character 3-grams.

The indexed rows are numbered in blocks. A row of the inverted table holds the numbers, within
one block, of the rows whose column has a gram: in runs that begin with a number and go on with
the distance of each from the one before. So no list is longer than a block, however common
its gram, and a run is read without the ones before it. A search reads the lists of the grams of
the wanted text, keeps the numbers that all of them share, reads the blocks that hold any, and
compares the text itself. A text of fewer than three characters has no gram: all rows are read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.materialize import materialize

GRAM = 3
BLOCK_BITS = 16
# Blocks whose rows are in one folder, as a power of two, and numbers of a run.
PART_BITS = 4
RUN = 64
# Folders that the inverted table is split into by hash of the gram.
FOLDERS = 64
FIELDS = ("name", "qualified_name", "description")


@dataclass(frozen=True)
class GramIndex:
    """``rows`` has the indexed rows with their numbers, ``lists`` the inverted table."""

    rows: DataFrame
    lists: DataFrame
    fields: tuple[str, ...]


def _grams(text: Column) -> Column:
    starts = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    every = F.transform(starts, lambda at: F.substring(text, at, F.lit(GRAM)))
    return F.when(F.length(text) >= GRAM, F.array_distinct(every))


def _folder(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(FOLDERS)).cast("int")


def gap_coded(numbers: Column) -> Column:
    """Sorted numbers as runs of distances; the first of a run is the number itself."""

    def run(k: Column) -> Column:
        part = F.slice(numbers, k * RUN + 1, F.lit(RUN))
        # The number before is looked up in the whole list: a slice would be cut again for each.
        before = lambda at: F.when(at > 0, F.get(numbers, k * RUN + at - 1)).otherwise(0)
        return F.transform(part, lambda x, at: x - before(at))

    last = F.floor((F.size(numbers) - 1) / RUN).cast("int")
    return F.transform(F.sequence(F.lit(0), last), run)


def numbers_of(runs: Column) -> Column:
    """The numbers back from their runs."""
    empty = F.array().cast("array<int>")

    def summed(run: Column) -> Column:
        def step(out: Column, gap: Column) -> Column:
            return F.concat(out, F.array(gap + F.coalesce(F.get(out, F.size(out) - 1), F.lit(0))))

        return F.aggregate(run, empty, step)

    return F.flatten(F.transform(runs, summed))


def write_index(
    df: DataFrame, path: str, fields: tuple[str, ...] = FIELDS
) -> GramIndex:
    """Copy the rows of ``df`` in numbered blocks and build the inverted table of ``fields``."""
    spark = df.sparkSession
    numbered = df.withColumn("_at", F.monotonically_increasing_id()).select(
        *df.columns,
        F.shiftright("_at", BLOCK_BITS + PART_BITS).alias("_part"),
        F.shiftright("_at", BLOCK_BITS).alias("_block"),
        F.col("_at").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int").alias("_number"),
    )
    version = f"{path}/{uuid.uuid4().hex}"
    numbered.write.partitionBy("_part").parquet(f"{version}/rows")
    rows = _rows(spark, version, df.schema)
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), _grams(F.col(f)).alias("grams")) for f in fields])
    found = rows.select("_block", "_number", F.inline(pairs)).select(
        "field", "_block", "_number", F.explode("grams").alias("gram")
    )
    # The gram comes first: rows are sorted by it, and few have the same.
    lists = found.groupBy("gram", "field", "_block").agg(
        F.sort_array(F.collect_list("_number")).alias("numbers")
    )
    lists = lists.select("field", "gram", "_block", gap_coded(F.col("numbers")).alias("gaps"))
    keyed = lists.withColumn("folder", _folder(F.col("gram")))
    keyed.hint("rebalance", F.col("folder")).sortWithinPartitions("folder", "gram").write.partitionBy(
        "folder"
    ).parquet(f"{version}/lists")
    return open_index(spark, version, df.schema, fields)


def _rows(spark: SparkSession, version: str, schema: T.StructType) -> DataFrame:
    own = [("_block", T.LongType()), ("_number", T.IntegerType()), ("_part", T.LongType())]
    fields = [*schema.fields, *[T.StructField(name, kind) for name, kind in own]]
    return spark.read.schema(T.StructType(fields)).parquet(f"{version}/rows")


def open_index(
    spark: SparkSession, version: str, schema: T.StructType, fields: tuple[str, ...] = FIELDS
) -> GramIndex:
    """The index that was written as ``version`` for a table of ``schema``."""
    lists = "field STRING, gram STRING, _block BIGINT, gaps ARRAY<ARRAY<INT>>, folder INT"
    return GramIndex(
        _rows(spark, version, schema), spark.read.schema(lists).parquet(f"{version}/lists"), fields
    )


def _grams_of(text: str) -> list[str]:
    return sorted({text[at : at + GRAM] for at in range(len(text) - GRAM + 1)})


def candidates(index: GramIndex, text: str, fields: tuple[str, ...]) -> DataFrame:
    """(_block, _number) of the rows that have all grams of ``text`` in one of the fields."""
    spark = index.lists.sparkSession
    grams = _grams_of(text)
    # The folders of a few grams, worked out where the grams were hashed.
    named = spark.createDataFrame([(g,) for g in grams], "gram STRING").select(_folder(F.col("gram")).alias("f"))
    folders = sorted({r["f"] for r in named.collect()})
    wanted = F.col("folder").isin(folders) & F.col("gram").isin(grams) & F.col("field").isin(list(fields))
    held = index.lists.filter(wanted).select("field", "_block", "gaps")
    one = held.groupBy("field", "_block").agg(F.collect_list("gaps").alias("every"))
    shared = F.aggregate(
        F.slice("every", 2, len(grams)),
        numbers_of(F.get("every", F.lit(0))),
        lambda left, more: F.array_intersect(left, numbers_of(more)),
    )
    # A block that lacks one of the grams has no row with the text.
    full = one.filter(F.size("every") == len(grams))
    return full.select("_block", F.explode(shared).alias("_number")).distinct()


def contains(index: GramIndex, text: str, fields: tuple[str, ...]) -> DataFrame:
    """The rows that hold ``text`` in one of the fields, as a scan would find them."""
    unknown = set(fields) - set(index.fields)
    if unknown:
        raise ValueError(f"not indexed: {', '.join(sorted(unknown))}")
    holds = reduce(Column.__or__, [F.coalesce(F.col(f).contains(text), F.lit(False)) for f in fields])
    rows = index.rows
    if len(text) >= GRAM:
        found = materialize(
            candidates(index, text, fields),
            "candidates",
            parts=F.collect_set(F.shiftright("_block", PART_BITS)),
        )
        rows = rows.filter(F.col("_part").isin(sorted(found.metrics["parts"]))).join(
            found.frame, ["_block", "_number"], "left_semi"
        )
    return rows.filter(holds).drop("_part", "_block", "_number")
