"""A catalog that grows by batches, each of which may be run again.

Every batch has a folder of its own, named by its stream and number, and is part of the
catalog once it is recorded as committed. A batch that failed before that is not seen by
readers or by other batches; run again, it overwrites its folder. A batch that failed after
it is left alone. One stream at a time may write to a catalog.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablewarden.materialize import materialize
from tablewarden.operators.entities import first_by_key
from tablewarden.operators.model import ENTITIES, ENTITY_COLUMNS

# What is recorded of each batch, and the stream that the first rows come from.
COMMITS = "stream STRING, batch BIGINT, n_rows BIGINT, committed_at BIGINT"
BASE = "base"

KEY = ["type_name", "qualified_name"]

# Guids are hexadecimal hashes, which only a codec that codes by frequency makes smaller.
CODEC = "zstd"


def _rows_below(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table in a folder, empty if there is none yet."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def stream_mark(spark: SparkSession, checkpoint: str) -> str:
    """The mark of the stream that owns a checkpoint, made when it is first asked for.

    Batch numbers start again when a checkpoint is given up. The mark is given up with it,
    so that the new batches do not overwrite the old ones.
    """
    place = f"{checkpoint.rstrip('/')}/mark"
    found = _rows_below(spark, place, "mark STRING").first()
    if found is None:
        made = uuid.uuid4().hex
        spark.createDataFrame([(made,)], "mark STRING").coalesce(1).write.parquet(place)
        return made
    return found["mark"]


def _part(catalog: str, stream: str, batch: int) -> str:
    return f"{catalog.rstrip('/')}/parts/{stream}-{batch}"


def commits(spark: SparkSession, catalog: str) -> DataFrame:
    return _rows_below(spark, f"{catalog.rstrip('/')}/commits", COMMITS)


def read_merged(spark: SparkSession, catalog: str) -> DataFrame:
    """The entities of all committed batches."""
    rows = commits(spark, catalog).select("stream", "batch").distinct().collect()
    if not rows:
        return spark.createDataFrame([], ENTITIES)
    paths = [_part(catalog, r["stream"], r["batch"]) for r in rows]
    return spark.read.schema(ENTITIES).parquet(*paths).select(*ENTITY_COLUMNS)


def write_part(entities: DataFrame, catalog: str, stream: str, batch: int) -> int:
    """Write the entities of a batch that the catalog does not know; returns their number.

    Only the keys of the catalog are read. The batch is written first: its size decides
    whether it is broadcast to the known keys, so that few of these move however many
    there are.
    """
    spark = entities.sparkSession
    known = read_merged(spark, catalog).select(*KEY)
    first = first_by_key(entities).select(*ENTITY_COLUMNS)
    batch_rows = materialize(first, "batch", codec=CODEC).frame
    repeated = known.join(batch_rows.select(*KEY), KEY, "left_semi").distinct()
    fresh = batch_rows.join(repeated, KEY, "left_anti").select(*ENTITY_COLUMNS)
    counted = Observation()
    rows = fresh.observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").option("compression", CODEC).parquet(_part(catalog, stream, batch))
    return counted.get["rows"]


def commit(spark: SparkSession, catalog: str, stream: str, batch: int, rows: int) -> None:
    record = spark.createDataFrame([(stream, batch, rows, time.time_ns())], COMMITS)
    record.coalesce(1).write.mode("append").parquet(f"{catalog.rstrip('/')}/commits")


def merge_batch(entities: DataFrame, catalog: str, stream: str, batch: int) -> None:
    """Add the entities of a batch that are not known yet, first writer first.

    Done at most once for a batch: nothing happens if it is committed already.
    """
    spark = entities.sparkSession
    done = (F.col("stream") == stream) & (F.col("batch") == batch)
    if commits(spark, catalog).filter(done).first() is None:
        commit(spark, catalog, stream, batch, write_part(entities, catalog, stream, batch))


def start_catalog(entities: DataFrame, catalog: str) -> None:
    """The entities that a catalog begins with, as its first batch."""
    merge_batch(entities, catalog, BASE, 0)
