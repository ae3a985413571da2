"""Relational sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablewarden.materialize import materialize
from tablewarden.operators.quality import require_primary_key


def jdbc_options(
    url: str,
    table: str,
    driver: str,
    column_types: str | None = None,
    connections: int = 8,
    batch_size: int = 10_000,
) -> dict[str, str]:
    """Writer options: keep an existing table and its key, empty it, load it in batches."""
    options = {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "truncate": "true",
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
    }
    if column_types:
        options["createTableColumnTypes"] = column_types
    return options


def load_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    driver: str,
    keys: list[str] | None = None,
    column_types: str | None = None,
    connections: int = 8,
) -> None:
    """Create the table when absent, empty it and load ``df`` over few connections.

    The rows are computed and written once at full width; only reading them again is limited
    to as many tasks as there are connections. With ``keys`` the primary key is checked first, so that a load which the database
    would refuse half way does not start.
    """
    ready = materialize(df, "to-load").frame
    if keys:
        require_primary_key(ready, keys)
    options = jdbc_options(url, table, driver, column_types, connections)
    ready.write.format("jdbc").options(**options).mode("overwrite").save()
