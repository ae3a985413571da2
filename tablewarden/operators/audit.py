"""Counts over the catalog, completeness audit and verification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.entities import expected_key, missing_entities
from tablewarden.operators.lineage import has_lineage, linked_nodes
from tablewarden.operators.model import DELETED


class CatalogVerificationError(AssertionError):
    """Expected entities or lineage are missing."""


def catalog_summary(entities: DataFrame, classifications: DataFrame) -> DataFrame:
    """Number of entities per type, and of entities per tag."""
    by_type = entities.groupBy(F.col("type_name").alias("name")).agg(
        F.count(F.lit(1)).alias("n_entities")
    )
    by_tag = (
        classifications.select("guid", F.col("classification").alias("name"))
        .distinct()
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("n_entities"))
    )
    return by_type.select(F.lit("type").alias("kind"), "name", "n_entities").unionByName(
        by_tag.select(F.lit("classification").alias("kind"), "name", "n_entities")
    )


def metadata_audit(
    entities: DataFrame, classifications: DataFrame, edges: DataFrame
) -> DataFrame:
    """Share of entities per type that are described, owned, tagged and in lineage."""
    # Each node and each tagged entity is one narrow row before it meets the entities.
    none = F.lit(None).cast("string")
    described = entities.select(
        "guid",
        "type_name",
        (F.coalesce("description", F.lit("")) != "").alias("described"),
        (F.coalesce("owner", F.lit("")) != "").alias("owned"),
        F.lit(False).alias("is_tagged"),
        F.lit(False).alias("is_linked"),
    )

    def marks(guids: DataFrame, tagged: bool) -> DataFrame:
        return guids.select(
            "guid",
            none.alias("type_name"),
            F.lit(None).cast("boolean").alias("described"),
            F.lit(None).cast("boolean").alias("owned"),
            F.lit(tagged).alias("is_tagged"),
            F.lit(not tagged).alias("is_linked"),
        )

    flags = (
        described.unionByName(marks(classifications.select("guid").distinct(), True))
        .unionByName(marks(linked_nodes(edges), False))
        .groupBy("guid")
        .agg(
            F.max("type_name").alias("type_name"),
            F.max("described").alias("described"),
            F.max("owned").alias("owned"),
            F.max("is_tagged").alias("tagged"),
            F.max("is_linked").alias("linked"),
        )
        .filter("described IS NOT NULL")
    )

    def share(condition):
        return F.count_if(condition).cast("double") / F.count(F.lit(1)).cast("double")

    return flags.groupBy("type_name").agg(
        F.count(F.lit(1)).alias("n_entities"),
        share(F.col("described")).alias("described"),
        share(F.col("owned")).alias("owned"),
        share(F.col("tagged")).alias("tagged"),
        share(F.col("linked")).alias("with_lineage"),
    )


def catalog_faults(
    entities: DataFrame, edges: DataFrame, expected: DataFrame, type_name: str
) -> DataFrame:
    """What verification finds, as a table of any size: fault, type_name, named.

    ``missing`` is an expected entity without a live one, ``no_lineage`` a live entity of the
    type that has no edge.
    """
    key = expected_key(expected)
    missing = missing_entities(entities, expected).select(
        F.lit("missing").alias("fault"), "type_name", F.col(key).alias("named")
    )
    live = entities.filter((F.col("type_name") == type_name) & ~F.col("status").eqNullSafe(DELETED))
    alone = live.join(linked_nodes(edges), "guid", "left_anti").select(
        F.lit("no_lineage").alias("fault"), "type_name", F.col("qualified_name").alias("named")
    )
    return missing.unionByName(alone)


def verify_catalog(
    entities: DataFrame,
    edges: DataFrame,
    expected: DataFrame,
    lineage_of: list[str | tuple[str, str]],
) -> None:
    """Raise unless all expected entities exist and the listed ones have lineage.

    ``expected`` is keyed as in ``missing_entities``. ``lineage_of`` lists (type name,
    qualified name) pairs; a plain name stands for any entity of that name. All that is
    missing is named: both lists are written by people.
    """
    key = expected_key(expected)
    missing = missing_entities(entities, expected).orderBy("type_name", key).collect()
    if missing:
        names = ", ".join(f"{row['type_name']}:{row[key]}" for row in missing)
        raise CatalogVerificationError(f"missing entities: {names}")
    pairs = [item for item in lineage_of if not isinstance(item, str)]
    names = [item for item in lineage_of if isinstance(item, str)]
    wanted = F.col("name").isin(names)
    for type_name, qualified_name in pairs:
        wanted |= (F.col("type_name") == type_name) & (F.col("qualified_name") == qualified_name)
    found = has_lineage(edges, entities.filter(wanted)).select("type_name", "qualified_name", "name")
    linked = {key for r in found.distinct().collect() for key in (r["name"], (r[0], r[1]))}
    unlinked = [item if isinstance(item, str) else ":".join(item) for item in lineage_of if item not in linked]
    if unlinked:
        raise CatalogVerificationError(f"no lineage for: {', '.join(sorted(unlinked))}")
