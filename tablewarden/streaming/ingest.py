"""Daily run as an incremental file stream: each run takes only files not seen before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablewarden.operators.entities import dataset_entities
from tablewarden.sources.files import CSV_OPTIONS
from tablewarden.streaming import merged

# Fixed value: columns of a listing of files.
FILE_LISTING = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    source_format: str = "parquet",
    source_options: dict[str, str] | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """Append the transformed rows of all new files to ``target`` and return the target.

    The file sink commits each batch once, so a rerun after a failure neither loses nor
    repeats rows. The transform is row-wise and needs no state or watermark.
    """
    rows = (
        spark.readStream.format(source_format)
        .schema(schema)
        .options(**(CSV_OPTIONS if source_format == "csv" else {}))
        .options(**(source_options or {}))
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
    )
    out = transform(rows)
    query = (
        out.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(target)


def register_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    file_format: str,
    name_pattern: str = "*",
) -> DataFrame:
    """Append one file entity per new file to ``target`` and return the target.

    Only paths and times are read, never the contents. A file gives one row, so nothing
    has to be made distinct and no state is kept.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_LISTING)
        .option("pathGlobFilter", name_pattern)
        .load(source)
    )
    out = dataset_entities(files, "path", file_format, create_time="modificationTime")
    query = (
        out.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(target)


def merge_stream(
    entities: DataFrame, catalog: str, checkpoint: str
) -> DataFrame:
    """Get-or-create the entities of a stream in the catalog below ``catalog``, batch by batch.

    Each batch is merged under the stream's own mark and its batch number, see
    ``merged.merge_batch``: a batch that is run again after a failure, at whatever step,
    replaces what it wrote before, so no entity is added twice and none is lost. Returns the
    merged catalog.
    """
    spark = entities.sparkSession
    mark = merged.stream_mark(spark, checkpoint)
    query = (
        entities.writeStream.foreachBatch(
            lambda batch, number: merged.merge_batch(batch, catalog, mark, number)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return merged.read_merged(spark, catalog)


def merge_new_files(
    spark: SparkSession,
    source: str,
    catalog: str,
    checkpoint: str,
    file_format: str,
    name_pattern: str = "*",
    files_per_batch: int = 10_000,
) -> DataFrame:
    """One file entity in the catalog per file that it does not know; known ones stay as they are."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_LISTING)
        .option("pathGlobFilter", name_pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
    )
    listed = dataset_entities(files, "path", file_format, create_time="modificationTime")
    return merge_stream(listed, catalog, checkpoint)
