"""Queries over the lineage graph, with the SQL that gives the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.materialize import materialize, scratch_path
from tablewarden.operators import lineage as graph
from tablewarden.operators.retag import retag, spread_tags
from tablewarden.plans.views import (
    CATALOG_SQL,
    EDGES_SQL,
    TAGS_SQL,
    catalog,
    customer_entities,
    graph_edges,
    graph_io,
    placed_edges,
    roots,
    row_tasks,
    tags,
    walk_sql,
)

DOWN_ROOTS = ("customer:1",)
UP_ROOTS = ("nation:7",)
MIXED_ROOTS = ("customer:2", "part:5", "nation:3")
EXPORT_ROOT = "part:5"


def build_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.build_edges(graph_io(spark, sf_dir), tasks=row_tasks(spark, sf_dir))


def lineage_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.lineage(
        graph_edges(spark, sf_dir, graph.OUTPUT), roots(spark, *DOWN_ROOTS), 4, graph.OUTPUT
    )


def lineage_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same walks over an edge table of more buckets than its size asks for, read again."""
    edges = graph.build_edges(graph_io(spark, sf_dir), unique=True)
    path = scratch_path(spark, "edges-by-bucket")
    graph.write_edges(edges, path, 16)
    return graph.lineage(graph.read_edges(spark, path), roots(spark, *MIXED_ROOTS), 2, graph.BOTH)


def lineage_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = graph_edges(spark, sf_dir, graph.INPUT)
    return graph.lineage(edges, roots(spark, *UP_ROOTS), 4, graph.INPUT)


def lineage_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three roots share the walks; two hops each way."""
    return graph.lineage(graph_edges(spark, sf_dir), roots(spark, *MIXED_ROOTS), 2, graph.BOTH)


def lineage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.lineage_counts(graph.build_edges(graph_io(spark, sf_dir), unique=True))


def has_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = graph.build_edges(graph_io(spark, sf_dir), unique=True)
    return graph.has_lineage(edges, customer_entities(spark, sf_dir)).select("guid", "name")


def impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.impact(
        graph_edges(spark, sf_dir, graph.OUTPUT),
        catalog(spark, sf_dir),
        tags(spark, sf_dir),
        roots(spark, *DOWN_ROOTS),
    )


def propagate_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags with a level, the last letter of the guid that carries them; attributes as JSON."""
    level = F.create_map(F.lit("level"), F.substring("guid", -1, 1))
    levelled = tags(spark, sf_dir).withColumn("attributes", level)
    found = graph.propagate_tags(placed_edges(spark, sf_dir), levelled)
    return found.withColumn("attributes", F.to_json("attributes"))


def retag_after_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags and their nearest sources after the edges that leave customers with a 3 at the end and
    the tags of entities with a 7 at the end are gone, from those before."""
    placed = placed_edges(spark, sf_dir)
    before = placed.by_source
    gone = (F.col("src_guid").startswith("customer:")) & F.col("src_guid").endswith("3")
    own = tags(spark, sf_dir).select("guid", "classification")
    spread = materialize(spread_tags(placed, own), "spread").frame
    left = before.filter(~gone)
    untagged = F.col("guid").endswith("7")
    return retag(
        spread,
        graph.EdgeTable(left, left, placed.buckets),
        own.filter(~untagged),
        own.filter(untagged),
        before.filter(gone),
    )


def export_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes and edges in one table, told apart by ``kind``."""
    nodes, links = graph.export_lineage(
        graph_edges(spark, sf_dir), catalog(spark, sf_dir), EXPORT_ROOT
    )
    flat = nodes.select(
        F.lit("node").alias("kind"),
        "id",
        "label",
        "type",
        F.col("properties.qualifiedName").alias("qualified_name"),
        F.col("properties.createdBy").alias("created_by"),
        F.col("properties.createTime").alias("create_time"),
    )
    return flat.unionByName(
        links.select(F.lit("edge").alias("kind"), "source", "target", "label"),
        allowMissingColumns=True,
    )


QUERIES = {
    "build_edges": build_edges,
    "lineage_down": lineage_down,
    "lineage_up": lineage_up,
    "lineage_both": lineage_both,
    "lineage_by_bucket": lineage_by_bucket,
    "lineage_counts": lineage_counts,
    "has_lineage": has_lineage,
    "impact": impact,
    "propagate_tags": propagate_tags,
    "retag_after_change": retag_after_change,
    "export_lineage": export_lineage,
}


def _values(guids: tuple[str, ...]) -> str:
    return ", ".join(f"('{guid}')" for guid in guids)


def _walks(root_guids: tuple[str, ...], depth: int, *directions: str) -> str:
    walks = [
        walk_sql("down" if d == graph.OUTPUT else "up", _values(root_guids), depth, d == graph.OUTPUT)
        for d in directions
    ]
    return f"WITH RECURSIVE {EDGES_SQL}, " + ", ".join(walks)


_DOWN = "SELECT root, guid, hop, 'OUTPUT' AS direction FROM down"
_UP = "SELECT root, guid, hop, 'INPUT' AS direction FROM up"

_BOTH = f"{_walks(MIXED_ROOTS, 2, graph.OUTPUT, graph.INPUT)} {_DOWN} UNION ALL {_UP}"

ORACLES = {
    "build_edges": f"WITH {EDGES_SQL} SELECT * FROM edges",
    "lineage_down": f"{_walks(DOWN_ROOTS, 4, graph.OUTPUT)} {_DOWN}",
    "lineage_up": f"{_walks(UP_ROOTS, 4, graph.INPUT)} {_UP}",
    "lineage_both": _BOTH,
    "lineage_by_bucket": _BOTH,
    "lineage_counts": f"""WITH {EDGES_SQL}, e AS (
  SELECT src_guid AS guid, 0 AS i, 1 AS o FROM edges
  UNION ALL SELECT dst_guid, 1, 0 FROM edges)
SELECT guid, SUM(i)::BIGINT AS n_inputs, SUM(o)::BIGINT AS n_outputs FROM e GROUP BY guid""",
    "has_lineage": f"""WITH {EDGES_SQL} SELECT 'customer:' || c_custkey AS guid, c_name AS name
FROM customer WHERE 'customer:' || c_custkey IN
  (SELECT src_guid FROM edges UNION SELECT dst_guid FROM edges)""",
    "impact": f"""{_walks(DOWN_ROOTS, 50, graph.OUTPUT)}, {CATALOG_SQL}, {TAGS_SQL}
SELECT root, down.guid, name, type_name, classification, hop FROM down
JOIN tags ON tags.guid = down.guid LEFT JOIN catalog ON catalog.guid = down.guid
WHERE classification IN ('PII', 'Confidential', 'BusinessCritical')""",
    "propagate_tags": f"""WITH RECURSIVE {EDGES_SQL}, {TAGS_SQL},
t(guid, classification, source, hop) AS (
  SELECT guid, classification, guid, 0 FROM tags
  UNION
  SELECT dst_guid, classification, source, hop + 1 FROM t JOIN edges ON src_guid = t.guid
  WHERE hop < 50),
nearest AS (
  SELECT * FROM t QUALIFY ROW_NUMBER() OVER (
    PARTITION BY guid, classification ORDER BY hop, source) = 1)
SELECT guid, classification, '{{"level":"' || right(source, 1) || '"}}' AS attributes,
  hop > 0 AS propagated FROM nearest""",
    "retag_after_change": f"""WITH RECURSIVE {EDGES_SQL}, {TAGS_SQL},
t(guid, classification, source, hop) AS (
  SELECT guid, classification, guid, 0 FROM tags WHERE right(guid, 1) <> '7'
  UNION
  SELECT dst_guid, classification, source, hop + 1 FROM t JOIN edges ON src_guid = t.guid
  WHERE hop < 50 AND NOT (src_guid LIKE 'customer:%' AND right(src_guid, 1) = '3'))
SELECT guid, classification, hop, source FROM t QUALIFY ROW_NUMBER() OVER (
  PARTITION BY guid, classification ORDER BY hop, source) = 1""",
    "export_lineage": f"""{_walks((EXPORT_ROOT,), graph.EXPORT_DEPTH, graph.OUTPUT, graph.INPUT)},
{CATALOG_SQL},
ids AS (SELECT guid FROM down UNION SELECT guid FROM up),
links AS (
  SELECT src_guid, dst_guid FROM edges WHERE src_guid IN
    (SELECT guid FROM down WHERE hop < {graph.EXPORT_DEPTH})
  UNION
  SELECT src_guid, dst_guid FROM edges WHERE dst_guid IN
    (SELECT guid FROM up WHERE hop < {graph.EXPORT_DEPTH}))
SELECT 'node' AS kind, ids.guid AS id, COALESCE(name, 'Unknown') AS label, type_name AS type,
  qualified_name, owner AS created_by,
  CASE WHEN name IS NOT NULL THEN TIMESTAMP '2024-01-01 00:00:00' END AS create_time,
  NULL AS source, NULL AS target
FROM ids LEFT JOIN catalog ON catalog.guid = ids.guid
UNION ALL
SELECT 'edge', NULL, sha256(src_guid || '|' || dst_guid), NULL, NULL, NULL, NULL, src_guid,
  dst_guid FROM links""",
}
