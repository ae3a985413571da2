"""Lineage edges, traversal, impact analysis and tag propagation."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.materialize import WrittenTable, materialize, read_written
from tablewarden.operators.model import EDGES

# Hops followed when none are given, for traversal and for export.
DEFAULT_DEPTH = 5
EXPORT_DEPTH = 3

# Tags that make an entity critical in an impact analysis.
CRITICAL_TAGS = ["PII", "Confidential", "BusinessCritical"]

INPUT, OUTPUT, BOTH = "INPUT", "OUTPUT", "BOTH"


def build_edges(process_io: DataFrame, unique: bool = False, tasks: int | None = None) -> DataFrame:
    """Directed edges dataset -> process for inputs, process -> dataset for outputs.

    ``unique`` says that no row of ``process_io`` is repeated, which saves the shuffle.
    ``tasks`` is the number of tasks that share the rows to be made distinct, so that the
    memory of one does not depend on how much is read or merged into a task.
    """
    is_input = F.col("direction") == "input"
    edges = process_io.select(
        F.when(is_input, F.col("dataset_guid")).otherwise(F.col("process_guid")).alias("src_guid"),
        F.when(is_input, F.col("process_guid")).otherwise(F.col("dataset_guid")).alias("dst_guid"),
    )
    if unique:
        return edges
    return (edges.repartition(tasks, "src_guid", "dst_guid") if tasks else edges).distinct()


# Fixed value: what is recorded of each version of an edge table.
PUBLISHED = "version STRING, buckets INT, published_at BIGINT"


@dataclass(frozen=True)
class EdgeTable:
    """Edges in folders by hash bucket of their source, and again by that of their target.

    A hop reads only the buckets of its nodes: their numbers, of which there are at most
    ``buckets``, are known when the nodes have been written and become a plain filter on
    folders. The files of a bucket with a hot node are split among tasks like any others.
    A side that no walk needs may be left out.
    """

    by_source: DataFrame | None
    by_target: DataFrame | None
    buckets: int

    def side(self, forward: bool) -> DataFrame:
        found = self.by_source if forward else self.by_target
        if found is None:
            raise ValueError("the edge table was written without the side that this walk needs")
        return found


_SIDES = {True: ("by_source", "src_guid"), False: ("by_target", "dst_guid")}


def _bucket(column: str, buckets: int) -> str:
    return f"CAST(pmod(xxhash64({column}), {buckets}) AS INT)"


def write_edges(
    edges: DataFrame, path: str, buckets: int, directions: str = BOTH
) -> EdgeTable:
    """Write a new version of the edge table below ``path`` and publish it.

    Choose buckets of some hundred megabytes. The version and its number of buckets are
    recorded in one row when both sides are whole, so readers see the version before or this
    one and need no number. ``directions`` leaves out the side that walks will not need.
    """
    spark = edges.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    wanted = [d for d in (True, False) if directions in (BOTH, OUTPUT if d else INPUT)]
    once = materialize(edges.select("src_guid", "dst_guid"), "edges").frame if len(wanted) > 1 else edges
    for forward in wanted:
        folder, key = _SIDES[forward]
        keyed = once.selectExpr("src_guid", "dst_guid", f"{_bucket(key, buckets)} AS bucket")
        if buckets > 1:
            # Files by bucket; one bucket has no others to be kept apart from.
            keyed = keyed.hint("rebalance", F.col("bucket"))
        keyed.write.partitionBy("bucket").parquet(f"{path}/{version}/{folder}")
    record = spark.createDataFrame([(version, buckets, time.time_ns())], PUBLISHED)
    record.coalesce(1).write.mode("append").parquet(f"{path}/published")
    return _open_edges(spark, f"{path}/{version}", buckets, wanted)


def place_edges(edges: DataFrame, path: str, tasks: int) -> EdgeTable:
    """Write the edges below ``path``, dealt to ``tasks`` buckets by their source.

    For walks from so many nodes that a hop meets all edges: a hop down joins them where they
    lie, and only its nodes are shuffled. A hop up shuffles the edges once. The table is named
    only until it is opened, so that nothing is left in the session's catalog.
    """
    spark = edges.sparkSession
    name = f"edges_{uuid.uuid4().hex}"
    dealt = edges.select("src_guid", "dst_guid").repartition(tasks, "src_guid")
    writer = dealt.write.format("parquet").bucketBy(tasks, "src_guid").option("compression", "zstd")
    writer.option("path", f"{path}/{name}").saveAsTable(name)
    placed = spark.table(name).withColumn("bucket", F.lit(0))
    # The table lies at a path of its own: its files stay.
    spark.sql(f"DROP TABLE {name}")
    return EdgeTable(placed, placed, 1)


def _open_edges(spark: SparkSession, path: str, buckets: int, sides: list[bool]) -> EdgeTable:
    reader = spark.read.schema(EDGES + ", bucket INT")
    found = [reader.parquet(f"{path}/{_SIDES[s][0]}") if s in sides else None for s in (True, False)]
    return EdgeTable(*found, buckets)


def read_edges(spark: SparkSession, path: str, directions: str = BOTH) -> EdgeTable:
    """The version of the edge table below ``path`` that was published last."""
    known = spark.read.schema(PUBLISHED).parquet(f"{path}/published")
    newest = known.orderBy(F.desc("published_at")).first()
    if newest is None:
        raise ValueError(f"no edge table is published below {path}")
    sides = [d for d in (True, False) if directions in (BOTH, OUTPUT if d else INPUT)]
    return _open_edges(spark, f"{path}/{newest['version']}", newest["buckets"], sides)


def _steps(edges: DataFrame | EdgeTable, forward: bool) -> tuple[DataFrame, list[str]]:
    """Edges as (guid, next_guid) in walking direction, and the columns to join on."""
    here, there = ("src_guid", "dst_guid") if forward else ("dst_guid", "src_guid")
    ends = [f"{here} AS guid", f"{there} AS next_guid"]
    if isinstance(edges, DataFrame):
        return edges.selectExpr(*ends), ["guid"]
    return edges.side(forward).selectExpr("bucket", *ends), ["bucket", "guid"]


def _is_split(edges: DataFrame | EdgeTable) -> bool:
    return isinstance(edges, EdgeTable) and edges.buckets > 1


def _written(nodes: DataFrame, edges: DataFrame | EdgeTable, label: str) -> WrittenTable:
    """Nodes written once, with the buckets that they fall into.

    Next to an edge table of several buckets they lie in folders by bucket as well.
    """
    if not _is_split(edges):
        return materialize(nodes, label)
    bucket = F.expr(_bucket("guid", edges.buckets))
    placed = nodes.withColumn("bucket", bucket)
    return materialize(placed, label, "bucket", buckets=F.collect_set("bucket"))


def _edges_of(edges: DataFrame | EdgeTable, nodes: WrittenTable, forward: bool) -> DataFrame:
    """Rows of ``nodes`` with the ``next_guid`` of each of their edges."""
    steps, on = _steps(edges, forward)
    frame = nodes.frame
    if _is_split(edges):
        steps = steps.filter(F.col("bucket").isin(sorted(nodes.metrics["buckets"])))
    elif "bucket" in on:
        steps, on = steps.drop("bucket"), ["guid"]
    return frame.join(steps, on)


def _unseen(reached: DataFrame, seen: DataFrame, edges: EdgeTable, keys: list[str]) -> DataFrame:
    """The nodes of a hop that are new, where the nodes seen lie in the buckets of the edges.

    The hop is written first. So its buckets are known, and of the nodes seen only those in
    the same buckets are read.
    """
    written = _written(reached, edges, "reached")
    if not written.rows:
        return written.frame
    near = seen.filter(F.col("bucket").isin(sorted(written.metrics["buckets"]))).select("bucket", *keys)
    same = [written.frame[k].eqNullSafe(near[k]) for k in ("bucket", *keys)]
    return written.frame.join(near, reduce(Column.__and__, same), "left_anti").drop("bucket")


# Hops that are taken one by one. A walk that is not at its end by then is in a deep graph.
SINGLE_HOPS = 16


def _walk(
    edges: DataFrame | EdgeTable,
    seeds: DataFrame,
    depth: int | None,
    forward: bool,
    source: str | None = None,
) -> DataFrame:
    """Breadth-first walk from all seeds at once, the least hop per (labels, guid).

    ``seeds`` has a ``guid`` and label columns that travel along. Each hop joins only the
    nodes found by the hop before. Known nodes are dropped in one aggregate over these and
    all nodes seen so far, or, next to an edge table of several buckets, by a join with the
    seen nodes of the buckets that the hop has reached. The new nodes are written to the shared
    folder. So cycles end, paths do not multiply, plans stay short, a lost executor costs
    at most the current hop, and the size of a written frontier decides whether the next
    join broadcasts it. A node with very many edges is a hot join key; adaptive execution
    splits its partition, which it can because the frontier is a table and not the output
    of an aggregate on the same key. ``source`` names a column of numbers that is no label: of
    several ways to a node with the least hop, the one with the least source counts.

    After ``SINGLE_HOPS`` hops the rest of the way is walked over contracted chains.
    """
    labels = [c for c in seeds.columns if c not in ("guid", source)]
    keys = [*labels, "guid"]
    carried = [] if source is None else [source]

    def nearest(rows: DataFrame, hop: int) -> DataFrame:
        """The nodes first reached by ``hop``; numbers only, which a hash table can hold."""
        least = [F.min(F.when(F.col("hop") == hop, F.col(c))).alias(c) for c in carried]
        return rows.groupBy(*keys).agg(F.min("hop").alias("hop"), *least).filter(f"hop = {hop}")

    first = nearest(seeds.selectExpr(*keys, *carried, "0 AS hop"), 0).select(*keys, *carried, "hop")
    frontier = _written(first, edges, "frontier")
    paths, seen, hop = frontier.paths, frontier.frame, 0
    while frontier.rows and (depth is None or hop < depth) and hop < SINGLE_HOPS:
        hop += 1
        reached = _edges_of(edges, frontier, forward).selectExpr(
            *labels, "next_guid AS guid", *carried, f"{hop} AS hop"
        )
        if _is_split(edges):
            fresh = _unseen(nearest(reached, hop), seen, edges, keys)
        else:
            fresh = nearest(seen.unionByName(reached), hop)
        frontier = _written(fresh.select(*keys, *carried, "hop"), edges, "frontier")
        if frontier.rows:
            paths += frontier.paths
            seen = read_written(seeds.sparkSession, paths, seen)
    seen = seen.select(*keys, *carried, "hop")
    if frontier.rows and (depth is None or hop < depth):
        start = materialize(frontier.frame.select(*keys, *carried, "hop"), "deep-frontier").frame
        return _walk_chains(_steps(edges, forward)[0], start, seen, depth, keys, carried)
    return seen


def _least(rows: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """The row with the least hop of each node, then the least source."""
    best = F.min(F.struct("hop", *carried)).alias("_best")
    return rows.groupBy(*keys).agg(best).select(*keys, *[f"_best.{c}" for c in carried], "_best.hop")


def _walk_chains(
    steps: DataFrame, start: DataFrame, seen: DataFrame, depth: int | None, keys: list[str], carried: list[str]
) -> DataFrame:
    """The walk on from ``start``, in rounds that do not grow with the length of chains.

    A node with one edge in and one edge out is part of a chain, unless the walk stands on it.
    Each node of a chain learns the node before the chain and its distance from it by doubling:
    it takes the pointer of the node it points to, so a chain of n nodes takes about log2 n
    rounds. Chains then are single edges as long as they were. The walk over these repeats
    while it finds shorter ways; at last the nodes of the chains get the hop of the node
    before them and their distance. A ring that no other edge leads into is never reached.
    """
    spark = start.sparkSession
    steps = materialize(steps.select("guid", "next_guid").distinct(), "steps").frame
    stands = materialize(start.select("guid").distinct(), "stands").frame
    ends = F.array(
        F.struct(F.col("guid").alias("n"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("next_guid").alias("n"), F.lit(0).alias("o"), F.lit(1).alias("i")),
    )
    single = (
        steps.filter("guid != next_guid").select(F.inline(ends)).groupBy("n")
        .agg(F.sum("o").alias("o"), F.sum("i").alias("i")).filter("o = 1 AND i = 1")
    )
    loops = steps.filter("guid = next_guid").select(F.col("guid").alias("n"))
    outside = stands.select(F.col("guid").alias("n")).unionByName(loops)
    links = materialize(single.select("n").join(outside, "n", "left_anti"), "links")
    inner = links.frame
    # (node of a chain, node pointed to, distance, whether that is a chain's node too)
    into = steps.join(inner.withColumnRenamed("n", "next_guid"), "next_guid")
    on = inner.select(F.col("n").alias("guid"), F.lit(True).alias("_on"))
    pointers = into.join(on, "guid", "left").select(
        F.col("next_guid").alias("node"), F.col("guid").alias("head"), F.lit(1).cast("long").alias("distance"),
        F.coalesce("_on", F.lit(False)).alias("open"),
    )
    table = materialize(pointers, "pointers", open=F.count_if("open"))
    reach = 1
    while table.metrics["open"] and reach <= links.rows:
        reach *= 2
        all_rows = table.frame
        ahead = all_rows.select(
            F.col("node").alias("head"), F.col("head").alias("_head"), F.col("distance").alias("_more"),
            F.col("open").alias("_open"),
        )
        moved = all_rows.filter("open").join(ahead, "head").select(
            "node", F.col("_head").alias("head"), (F.col("distance") + F.col("_more")).alias("distance"),
            F.col("_open").alias("open"),
        )
        table = materialize(all_rows.filter("NOT open").unionByName(moved), "pointers", open=F.count_if("open"))
    chains = table.frame.filter("NOT open").drop("open")
    # Edges between nodes that are on no chain, and from the node before a chain to the one behind it.
    behind = steps.join(inner.withColumnRenamed("n", "next_guid"), "next_guid", "left_anti")
    far = behind.join(chains, F.col("guid") == F.col("node")).select(
        F.col("head").alias("guid"), "next_guid", (F.col("distance") + 1).alias("length")
    )
    near = behind.join(inner.withColumnRenamed("n", "guid"), "guid", "left_anti").select(
        "guid", "next_guid", F.lit(1).cast("long").alias("length")
    )
    short = far.unionByName(near).groupBy("guid", "next_guid").agg(F.min("length").alias("length"))
    roads = materialize(short, "roads").frame
    labels = [k for k in keys if k != "guid"]
    within = F.lit(True) if depth is None else F.col("hop") <= depth
    known = seen.withColumn("hop", F.col("hop").cast("long"))
    found = materialize(known, "found")
    frontier, paths = start.withColumn("hop", F.col("hop").cast("long")), found.paths
    state = found.frame
    while True:
        went = frontier.join(roads, "guid").select(
            *labels, F.col("next_guid").alias("guid"), *carried, (F.col("hop") + F.col("length")).alias("hop")
        )
        mark = F.lit(True)
        both = state.withColumn("_old", mark).unionByName(went.filter(within).withColumn("_old", ~mark))
        value = F.struct("hop", *carried)
        best = both.groupBy(*keys).agg(
            F.min(value).alias("_best"), F.min(F.when(F.col("_old"), value)).alias("_known")
        )
        better = best.filter("_known IS NULL OR _best < _known")
        written = materialize(
            better.select(*keys, *[f"_best.{c}" for c in carried], "_best.hop"), "found"
        )
        if not written.rows:
            break
        frontier, paths = written.frame, paths + written.paths
        state = read_written(spark, paths, state)
    final = materialize(_least(state, keys, carried), "walked").frame
    inside = final.join(chains.withColumnRenamed("head", "guid"), "guid").select(
        *labels, F.col("node").alias("guid"), *carried, (F.col("hop") + F.col("distance")).alias("hop")
    )
    every = _least(final.unionByName(inside.filter(within)), keys, carried)
    return materialize(every.withColumn("hop", F.col("hop").cast("int")), "deep-walk").frame


def lineage(
    edges: DataFrame | EdgeTable,
    roots: DataFrame,
    depth: int | None = DEFAULT_DEPTH,
    direction: str = BOTH,
) -> DataFrame:
    """Nodes within ``depth`` hops of each root: root, guid, hop, direction.

    ``roots`` has one column ``guid``. OUTPUT follows edges downstream, INPUT upstream,
    BOTH is the union of the two walks (not an undirected walk). Each walk holds its root
    at hop 0. ``depth=None`` walks until nothing new is found.
    """
    seeds = roots.select(F.col("guid").alias("root"), F.col("guid"))
    walks = []
    if direction in (OUTPUT, BOTH):
        walks.append(_walk(edges, seeds, depth, True).withColumn("direction", F.lit(OUTPUT)))
    if direction in (INPUT, BOTH):
        walks.append(_walk(edges, seeds, depth, False).withColumn("direction", F.lit(INPUT)))
    if not walks:
        raise ValueError(f"direction must be {INPUT}, {OUTPUT} or {BOTH}")
    return reduce(DataFrame.unionByName, walks)


def lineage_counts(edges: DataFrame, guids: DataFrame | None = None) -> DataFrame:
    """Incoming and outgoing edges of every node, or of the given ones.

    Edges are counted before anything is joined, so a hub moves as one row per task. A given
    node without edges has 0 of both.
    """
    ends = F.array(
        F.struct(F.col("src_guid").alias("guid"), F.lit(0).alias("i"), F.lit(1).alias("o")),
        F.struct(F.col("dst_guid").alias("guid"), F.lit(1).alias("i"), F.lit(0).alias("o")),
    )
    counts = (
        edges.select(F.inline(ends))
        .groupBy("guid")
        .agg(F.sum("i").alias("n_inputs"), F.sum("o").alias("n_outputs"))
    )
    if guids is None:
        return counts
    asked = guids.select("guid").distinct()
    zero = F.lit(0).cast("long")
    return asked.join(counts, "guid", "left").select(
        "guid", *[F.coalesce(n, zero).alias(n) for n in ("n_inputs", "n_outputs")]
    )


def linked_nodes(edges: DataFrame) -> DataFrame:
    """Every node that has an edge, once."""
    return edges.select(F.explode(F.array("src_guid", "dst_guid")).alias("guid")).distinct()


def has_lineage(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """The entities that take part in lineage."""
    return entities.join(linked_nodes(edges), "guid", "left_semi").select(*entities.columns)


def impact(
    edges: DataFrame | EdgeTable,
    entities: DataFrame,
    classifications: DataFrame,
    roots: DataFrame,
    depth: int | None = None,
    tags: list[str] = CRITICAL_TAGS,
) -> DataFrame:
    """Critical entities downstream of the roots, one row per entity and critical tag.

    The whole graph is walked unless a depth is given. The roots themselves are included when they carry such a tag.
    """
    reached = lineage(edges, roots, depth, OUTPUT).select("root", "guid", "hop")
    hits = (
        classifications.filter(F.col("classification").isin(tags))
        .select("guid", "classification")
        .join(reached, "guid")
        .distinct()
    )
    return hits.join(
        _described(reached, entities).select("guid", "name", "type_name"), "guid", "left"
    ).select("root", "guid", "name", "type_name", "classification", "hop")


def _described(nodes: DataFrame, entities: DataFrame) -> DataFrame:
    """The entities of some nodes.

    A walk that found few nodes is broadcast here by its written size, so that the whole
    catalog is filtered where it lies and only the few entities move.
    """
    return entities.join(nodes.select("guid"), "guid", "left_semi").select(*entities.columns)


def propagate_tags(
    edges: DataFrame | EdgeTable, classifications: DataFrame, tags: list[str] | None = None
) -> DataFrame:
    """Tags of each entity, its own and those of everything upstream of it.

    The walk carries the tag and not its source, so its state is bounded by tags times
    nodes however many entities carry a tag. Own tags keep ``propagated`` false. A tag
    brings the attributes it has where it comes from: of several sources the nearest, then
    the one with the least guid.
    """
    chosen = classifications.select("guid", "classification", "attributes")
    if tags is not None:
        chosen = chosen.filter(F.col("classification").isin(tags))
    # Sources as numbers in the order of their guids: numbers can be compared in a hash table.
    sources = chosen.select("guid").distinct().repartitionByRange("guid").sortWithinPartitions("guid")
    numbered = materialize(sources.withColumn("source", F.monotonically_increasing_id()), "sources").frame
    # An entity that carries a tag twice gives the values that sort first.
    values = chosen.groupBy("guid", "classification").agg(
        F.min_by("attributes", F.to_json(F.array_sort(F.map_entries("attributes")))).alias("attributes")
    )
    own = materialize(values.join(numbered, "guid"), "tag-values").frame
    walked = _walk(edges, own.select("classification", "guid", "source"), None, True, "source")
    reached = materialize(walked, "tagged").frame
    return reached.join(own.drop("guid"), ["source", "classification"], "left").select(
        "guid", "classification", "attributes", (F.col("hop") > 0).alias("propagated")
    )


def export_lineage(
    edges: DataFrame | EdgeTable, entities: DataFrame, root: str, depth: int = EXPORT_DEPTH
) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the lineage around one root, ready to be written as JSON lines.

    The edges are those that the walks up and down followed.
    """
    start = entities.sparkSession.createDataFrame([(root,)], "guid STRING")
    walked = lineage(edges, start, depth, BOTH)
    # Both walks hold the root, and a cycle may put a node into both.
    ids = walked.select("guid").distinct()
    nodes = ids.join(_described(walked, entities), "guid", "left").select(
        F.col("guid").alias("id"),
        F.coalesce("name", F.lit("Unknown")).alias("label"),
        F.col("type_name").alias("type"),
        F.struct(
            F.col("qualified_name").alias("qualifiedName"),
            F.col("owner").alias("createdBy"),
            F.col("create_time").alias("createTime"),
        ).alias("properties"),
    )
    inner = walked.filter(F.col("hop") < depth)

    def followed_from(direction: str) -> DataFrame:
        forward = direction == OUTPUT
        nodes = inner.filter(F.col("direction") == direction).select("guid").distinct()
        here, there = ("guid", "next_guid") if forward else ("next_guid", "guid")
        taken = _edges_of(edges, _written(nodes, edges, "exported"), forward)
        return taken.select(F.col(here).alias("src_guid"), F.col(there).alias("dst_guid"))

    followed = followed_from(OUTPUT).unionByName(followed_from(INPUT)).distinct()
    links = followed.select(
        F.col("src_guid").alias("source"),
        F.col("dst_guid").alias("target"),
        F.sha2(F.concat_ws("|", "src_guid", "dst_guid"), 256).alias("label"),
    )
    return nodes, links
