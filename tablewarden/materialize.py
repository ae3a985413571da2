"""Cut a plan by writing it out once as a Parquet table in the shared folder."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablewarden.session import scratch_root


@dataclass(frozen=True)
class WrittenTable:
    """A written intermediate table: where it lies, what it holds, how many rows."""

    paths: tuple[str, ...]
    frame: DataFrame
    rows: int
    metrics: dict


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of its own for each call, so that no table being read is overwritten."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/{app}/{label}-{uuid.uuid4().hex}"


def read_written(spark: SparkSession, paths: tuple[str, ...], like: DataFrame) -> DataFrame:
    """One scan over several written tables; the known schema saves the footer pass."""
    reader = spark.read.schema(like.schema)
    base, _, step = paths[0].rpartition("/")
    if step.startswith("step="):
        # Tables in folders are parts of one table by step; its own column is left out.
        return reader.option("basePath", base).parquet(*paths).select(*like.columns)
    return reader.parquet(*paths)


def materialize(
    df: DataFrame, label: str, folders: str | None = None, codec: str | None = None, **metrics: Column
) -> WrittenTable:
    """Write ``df`` and read it back; the row count and other aggregates ride on the write.

    ``folders`` names a column whose values become folders; ``codec`` compresses the files, the
    session's codec if it is not given.

    Unlike cached or locally checkpointed data the files outlive any executor, and their
    size on disk tells the optimizer whether a later join may broadcast them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if folders:
        path = f"{scratch_path(spark, '').rpartition('/')[0]}/{label}/step={uuid.uuid4().hex}"
    observed = Observation()
    counted = [F.count(F.lit(1)).alias("rows"), *(m.alias(name) for name, m in metrics.items())]
    if folders:
        # Files by folder, not one in each folder for each task.
        writer = df.hint("rebalance", F.col(folders)).observe(observed, *counted).write.partitionBy(folders)
    else:
        writer = df.observe(observed, *counted).write
    writer.parquet(path, compression=codec)
    found = dict(observed.get)
    return WrittenTable((path,), read_written(spark, (path,), df), found.pop("rows"), found)


def release(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; nothing that reads them may follow."""
    folder = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
