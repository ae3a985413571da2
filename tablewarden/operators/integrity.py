"""Whether a load arrived whole: digests per bucket, then the rows of differing buckets only.

Both tables lie in folders by a hash of their keys. The digest of a bucket is the number of its
rows and two sums of row hashes, which do not depend on any order and regard how often a row
occurs. Buckets whose digests agree are not read again; the digests may be stored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.materialize import materialize

SUM = "decimal(38,0)"


@dataclass(frozen=True)
class BucketedTable:
    """Rows in folders ``_bucket`` by hash of their keys, and the digest of each folder."""

    rows: DataFrame
    digests: DataFrame
    keys: tuple[str, ...]
    buckets: int


def _row_hash(columns: list[str], seed: int) -> Column:
    """Hash of a row; a NULL differs from any value, at any place."""
    marked = [x for c in sorted(columns) for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *marked)


def digests(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(_bucket, n, digest): rows of each bucket and their sums; one row per task before the shuffle."""
    first, second = (F.sum(_row_hash(columns, seed).cast(SUM)).cast("string") for seed in (1, 2))
    return rows.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.concat_ws("|", first, second).alias("digest")
    )


def write_bucketed(df: DataFrame, path: str, keys: tuple[str, ...], buckets: int) -> BucketedTable:
    """Write ``df`` below ``path`` in folders by hash of its keys, with the digests of the folders.

    Choose buckets of some hundred megabytes. A bucket with a hot key is split over tasks.
    """
    spark = df.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    version = f"{path}/{uuid.uuid4().hex}"
    df.withColumn("_bucket", bucket).hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(
        f"{version}/rows"
    )
    schema = f"{df.schema.toDDL()}, _bucket INT"
    rows = spark.read.schema(schema).parquet(f"{version}/rows")
    digests(rows, df.columns).coalesce(1).write.parquet(f"{version}/digests")
    return BucketedTable(rows, spark.read.parquet(f"{version}/digests"), tuple(keys), buckets)


def differing_buckets(source: BucketedTable, target: BucketedTable) -> list[int]:
    """The buckets whose digests differ; reads one short row per bucket."""
    if (source.keys, source.buckets) != (target.keys, target.buckets):
        raise ValueError("both tables must be written with the same keys and number of buckets")
    if sorted(source.rows.columns) != sorted(target.rows.columns):
        raise ValueError("both tables must have the same columns")
    one, two = source.digests.alias("s"), target.digests.alias("t")
    both = one.join(two, F.col("s._bucket") == F.col("t._bucket"), "full_outer")
    same = F.col("s.n").eqNullSafe(F.col("t.n")) & F.col("s.digest").eqNullSafe(F.col("t.digest"))
    return sorted(r[0] for r in both.filter(~same).select(F.coalesce("s._bucket", "t._bucket")).collect())


def differences(source: BucketedTable, target: BucketedTable) -> DataFrame:
    """Keys whose rows differ: the keys, ``kind``, ``n_source`` and ``n_target`` rows.

    ``missing`` keys are in the source only, ``added`` ones in the target only. Of keys in both,
    ``repeated`` ones have the same rows in differing numbers, ``changed`` ones other rows.
    NULL is a key like any other. Only differing buckets are read. Equal rows are counted
    before anything is compared, so that a hot key with few different rows stays cheap.
    """
    found = differing_buckets(source, target)
    columns = [c for c in source.rows.columns if c != "_bucket"]

    def counted(table: BucketedTable, side: int) -> DataFrame:
        rows = table.rows.filter(F.col("_bucket").isin(found)).select(*columns)
        hashes = [_row_hash(columns, seed).alias(f"_h{seed}") for seed in (1, 2)]
        n = [F.lit(int(side == 0)).alias("_s"), F.lit(int(side == 1)).alias("_t")]
        return rows.select(*table.keys, *hashes, *n)

    both = counted(source, 0).unionByName(counted(target, 1))
    distinct = both.groupBy(*source.keys, "_h1", "_h2").agg(
        F.sum("_s").alias("_s"), F.sum("_t").alias("_t")
    )
    kinds = distinct.groupBy(*source.keys).agg(
        F.sum("_s").alias("n_source"),
        F.sum("_t").alias("n_target"),
        F.max(F.col("_s") != F.col("_t")).alias("_differs"),
        F.max((F.col("_s") == 0) | (F.col("_t") == 0)).alias("_other"),
    )
    kind = (
        F.when(F.col("n_target") == 0, "missing")
        .when(F.col("n_source") == 0, "added")
        .when(F.col("_other"), "changed")
        .otherwise("repeated")
    )
    return kinds.filter("_differs").select(*source.keys, kind.alias("kind"), "n_source", "n_target")


def reconcile_loads(
    source: DataFrame, target: DataFrame, path: str, keys: tuple[str, ...], buckets: int
) -> DataFrame:
    """Differences between two tables that are not written in buckets yet."""
    written = [write_bucketed(df, f"{path}/{side}", keys, buckets) for df, side in ((source, "s"), (target, "t"))]
    return materialize(differences(*written), "differences").frame
