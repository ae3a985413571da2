"""What the text operators share: table access, row identity, component labels.

A document is identified by its id and a 64-bit hash of its text, so rows that repeat both
count as one document and get the same result. Ids that are NULL rank behind all others.
Columns the operators make for themselves start with ``__``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.materialize import materialize

# Rank of a NULL id: behind every other id.
LAST_ID = 2**63 - 1


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_rank(id_col: str = "doc_id") -> Column:
    """The id as a number that sorts NULL last."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))


def text_hash(text_col: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row identity ``__id``, ``__hash``, and all columns of ``docs`` in the struct ``__row``.

    In the struct they cannot clash with columns that an operator makes, whatever they are
    called; ``unkeyed`` gives them back.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("__row"), id_rank(id_col).alias("__id"), text_hash(text_col).alias("__hash"))


def unkeyed(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from their struct."""
    return rows.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row identity and text only, NULL texts as empty ones."""
    return docs.select(
        id_rank(id_col).alias("__id"),
        text_hash(text_col).alias("__hash"),
        F.coalesce(F.col(text_col), F.lit("")).alias("__text"),
    )


def true_id(column: str = "__id") -> Column:
    """The id back from its rank."""
    return F.when(F.col(column) != LAST_ID, F.col(column))


def bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def column_lists(batch: pa.RecordBatch) -> list[list]:
    return [column.to_pylist() for column in batch.columns]


def to_batch(schema: pa.Schema, columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, schema)], schema=schema
    )


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of each node in ``edges`` (a, b), as (node, root).

    Alternates two steps until nothing changes: each node hands the smallest of its
    neighbours to the larger ones, then to the smaller ones. Every step is an aggregate
    and a plain join of written tables, so that a node with very many links is split.
    """
    links = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a != b")
        .distinct(),
        "links",
    ).frame
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = _to_smallest(links, both, F.col("b") > F.col("a"))
        links = _to_smallest(links, links, F.lit(True))
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())


def _to_smallest(links: DataFrame, seen: DataFrame, moved: Column) -> DataFrame:
    """Links of the neighbours in ``seen`` that ``moved`` holds for to the smallest one."""
    smallest = materialize(
        seen.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m")), "smallest"
    ).frame
    joined = seen.join(smallest, F.col("a") == F.col("n"))
    handed = joined.where(moved).select(F.col("b").alias("a"), F.col("m").alias("b"))
    kept = smallest.select(F.col("n").alias("a"), F.col("m").alias("b"))
    return materialize(
        handed.unionByName(kept).where("a != b").distinct(), "links"
    ).frame


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action go when it ends, and not at some later collection of garbage.

    For an action whose result is written: until it ends, lost files can be made again.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


PARTS = pa.schema([("chunk", pa.int32()), ("sums", pa.list_(pa.int64()))])
PART_TYPES = "chunk int, sums array<bigint>"


def table_parts(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of a task's table of counts, as ``PART_TYPES``; rows of zeros are left out."""
    for at in np.flatnonzero(table.any(axis=1)).tolist():
        yield to_batch(PARTS, [[at], [table[at].astype(np.int64)]])


def sum_tables(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sum of the tables that tasks sent in parts. The shape is fixed, so it may reach the driver."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape[1], np.int64)
        for batch in batches:
            for sums in batch.column("sums"):
                total += sums.values.to_numpy()
        yield to_batch(PARTS, [[key[0].as_py()], [total]])

    table = np.zeros(shape, np.int64)
    for row in parts.groupBy("chunk").applyInArrow(add, PART_TYPES).toLocalIterator():
        table[row["chunk"]] = row["sums"]
    return table


def training_rows(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(id, __label) of the labels that may be learned from: ids outside the held-out fifth.

    An id with several labels has the greatest of them.
    """
    known = F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & ~held_out(id_col)
    rows = labels.where(known).select(id_col, F.col(label).cast("int").alias("__label"))
    return rows.groupBy(id_col).agg(F.max("__label").alias("__label"))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is held out; one without an id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def bounded_sample(rows: DataFrame, size: int, id_col: str = "doc_id") -> DataFrame:
    """``size`` rows at most, the same ones each time."""
    return rows.orderBy(F.xxhash64(id_col), id_col).limit(size)
