"""Spark session and the shared folder that intermediate tables are written to."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on. Broadcasts are left to the optimizer: it only picks one
# when the measured size is under spark.sql.autoBroadcastJoinThreshold, and adaptive
# execution splits the partitions of hot join keys.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Shuffle partitions start at about this size; adaptive execution merges smaller ones.
PARTITION_BYTES = 128 * 1024 * 1024


def build_session(
    app_name: str = "tablewarden",
    master: str | None = None,
    shuffle_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """Session with adaptive execution on; extra settings use ``__`` for dots.

    ``shuffle_bytes`` is the size of the largest shuffle to expect. Adaptive execution
    merges partitions but never adds any, so a large job must start with enough of them
    for each to fit in memory.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    if shuffle_bytes:
        count = max(1, -(-shuffle_bytes // PARTITION_BYTES))
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(count)
        )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables, reachable by every executor.

    A cluster names it in ``spark.checkpoint.dir``. A local session without that setting
    uses a folder beside its managed tables; there is no machine-local fallback.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
