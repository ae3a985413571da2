"""Tags that follow a change of the graph or of its tags without a whole walk.

``spread_tags`` keeps for each entity and tag how far the nearest source is and which one it is.
After a change only the entities downstream of it can differ. Their rows are dropped and made
anew from their own tags and from the rows of the entities right before them, which are still
right. Nothing that depended on a removed tag or edge is kept, so a cycle cannot hold up a tag
whose source is gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.materialize import materialize, read_written
from tablewarden.operators.lineage import EdgeTable, _edges_of, _least, _walk, _written

KEYS = ["classification", "guid"]


def spread_tags(edges: DataFrame | EdgeTable, classifications: DataFrame) -> DataFrame:
    """(guid, classification, hop, source) of the whole graph: the nearest entity that carries the
    tag, of several the one with the least guid. An entity is its own source at hop 0."""
    own = classifications.select(*KEYS).distinct()
    # Sources as numbers in the order of their guids: numbers can be compared in a hash table.
    ordered = own.select("guid").distinct().repartitionByRange("guid").sortWithinPartitions("guid")
    numbered = materialize(ordered.withColumn("number", F.monotonically_increasing_id()), "sources").frame
    walked = _walk(edges, own.join(numbered, "guid").select(*KEYS, "number"), None, True, "number")
    names = numbered.withColumnRenamed("guid", "source")
    return walked.join(names, "number").select("guid", "classification", "hop", "source")


def affected_nodes(edges: DataFrame | EdgeTable, retagged: DataFrame, rewired: DataFrame) -> DataFrame:
    """(guid) of the entities whose rows a change can touch: those with other tags (``retagged``
    has their ``guid``), the targets of edges added or removed (``rewired`` has ``src_guid`` and
    ``dst_guid``), and all downstream of them.

    ``edges`` are those after the change. What lies behind a removed edge is found all the same:
    its target is a start, and so is that of every other removed edge on the way.
    """
    starts = retagged.select("guid").unionByName(rewired.select(F.col("dst_guid").alias("guid")))
    return _walk(edges, starts.distinct(), None, True).select("guid")


def retag(
    spread: DataFrame,
    edges: DataFrame | EdgeTable,
    classifications: DataFrame,
    retagged: DataFrame,
    rewired: DataFrame,
) -> DataFrame:
    """The rows of ``spread_tags`` after a change, from those before it.

    ``edges`` and ``classifications`` are those after the change; an edge table needs both
    sides. Entities that are not affected keep their rows as they are. Each round improves the
    rows of the affected ones by those that the round before improved, and writes only these.
    """
    touched = _written(affected_nodes(edges, retagged, rewired), edges, "touched")
    inside = touched.frame.select("guid")
    kept = spread.join(inside, "guid", "left_anti")
    own = classifications.select(*KEYS).distinct().join(inside, "guid", "left_semi")
    # Affected entities pass on nothing yet: their former rows may come from what is gone.
    before = _edges_of(edges, touched, False).select("guid", F.col("next_guid").alias("from"))
    outside = before.join(inside.withColumnRenamed("guid", "from"), "from", "left_anti").distinct()
    passed = outside.join(kept.withColumnRenamed("guid", "from"), "from").select(
        *KEYS, "source", (F.col("hop") + 1).alias("hop")
    )
    rows = own.select(*KEYS, F.col("guid").alias("source"), F.lit(0).alias("hop")).unionByName(passed)
    frontier = _written(_least(rows, KEYS, ["source"]), edges, "retagged")
    paths, known = frontier.paths, frontier.frame
    while frontier.rows:
        reached = _edges_of(edges, frontier, True).selectExpr(
            "classification", "next_guid AS guid", "source", "hop + 1 AS hop"
        )
        fresh = _least(reached, KEYS, ["source"])
        best = _least(known, KEYS, ["source"]).select(*KEYS, F.struct("hop", "source").alias("_best"))
        better = fresh.join(best, KEYS, "left").filter("_best IS NULL OR struct(hop, source) < _best")
        frontier = _written(better.select(*KEYS, "source", "hop"), edges, "retagged")
        if frontier.rows:
            paths += frontier.paths
            known = read_written(spread.sparkSession, paths, known)
    names = ["guid", "classification", "hop", "source"]
    anew = _least(known, KEYS, ["source"]).select(*names)
    return kept.select(*names).unionByName(anew)


def tags_of(spread: DataFrame, classifications: DataFrame) -> DataFrame:
    """The rows of ``spread_tags`` as classifications, with the attributes that the tag has at its
    source; an entity that carries a tag twice gives the values that sort first."""
    values = classifications.groupBy(F.col("guid").alias("source"), "classification").agg(
        F.min_by("attributes", F.to_json(F.array_sort(F.map_entries("attributes")))).alias("attributes")
    )
    return spread.join(values, ["source", "classification"], "left").select(
        "guid", "classification", "attributes", (F.col("hop") > 0).alias("propagated")
    )
