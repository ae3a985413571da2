"""The benchmark tables seen as employee records, a lineage graph and a catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.materialize import scratch_path
from tablewarden.operators.entities import bulk_batch
from tablewarden.operators.lineage import BOTH, EdgeTable, build_edges, place_edges, write_edges
from tablewarden.operators.tagging import apply_classification

RUN_DATE = "2024-01-31"


# Columns of the tables that the queries need, and their types.
TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
    "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named columns of a table, as its files have them; a column they lack is an error."""
    names = [part.split()[0] for part in TABLE_SCHEMAS[name].split(", ")]
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    absent = [n for n in names if n not in found.columns]
    if absent:
        raise ValueError(f"{name} lacks {', '.join(absent)}")
    return found.select(*names)


def node(kind: str, key: Column | str) -> Column:
    """Graph node id such as ``customer:7``."""
    return F.concat(F.lit(f"{kind}:"), F.col(key).cast("string"))


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as employee records; types as they come from the source."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("age"),
        F.col("l_extendedprice").alias("salary"),
        F.col("l_returnflag").alias("department"),
    )


# Line items that one task handles, about, where they are dealt by key.
TASK_ROWS = 250_000


def row_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for work on all line items; these are counted from the footers of their files."""
    rows = table(spark, sf_dir, "lineitem").count()
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def graph_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Process inputs and outputs, each once.

    customer -> order process -> part -> supply process -> nation of the supplier. Pairs
    of keys are made distinct as numbers, before they become node names.
    """
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")

    def side(df: DataFrame, process: Column, direction: str, dataset: Column) -> DataFrame:
        return df.select(
            process.alias("process_guid"),
            F.lit(direction).alias("direction"),
            dataset.alias("dataset_guid"),
        )

    # Dealt before they are made distinct: a task's memory then depends neither on how many rows
    # its part of a file has nor on how many partitions adaptive execution merges.
    tasks = row_tasks(spark, sf_dir)
    made = lineitem.select("l_orderkey", "l_partkey").repartition(tasks, "l_orderkey", "l_partkey").distinct()
    supplied = lineitem.select("l_partkey", "l_suppkey").repartition(tasks, "l_partkey", "l_suppkey").distinct()
    return bulk_batch(
        side(orders, node("order", "o_orderkey"), "input", node("customer", "o_custkey")),
        side(made, node("order", "l_orderkey"), "output", node("part", "l_partkey")),
        side(supplied, node("supply", "l_suppkey"), "input", node("part", "l_partkey")),
        side(supplier, node("supply", "s_suppkey"), "output", node("nation", "s_nationkey")),
    )


# Edges that one bucket of the edge table holds, about.
BUCKET_EDGES = 4_000_000


def graph_edges(spark: SparkSession, sf_dir: str, directions: str = BOTH) -> EdgeTable:
    """The edge table, written once in buckets; every line item gives two edges at most."""
    buckets = 1 + 2 * table(spark, sf_dir, "lineitem").count() // BUCKET_EDGES
    edges = build_edges(graph_io(spark, sf_dir), unique=True)
    return write_edges(edges, scratch_path(spark, "edges-by-bucket"), buckets, directions)


def placed_edges(spark: SparkSession, sf_dir: str) -> EdgeTable:
    """The edges dealt by their source, for walks down from a large part of all nodes."""
    edges = build_edges(graph_io(spark, sf_dir), unique=True)
    return place_edges(edges, scratch_path(spark, "edges-by-source"), row_tasks(spark, sf_dir))


def _entities(
    df: DataFrame,
    kind: str,
    key: str,
    name: str,
    owner: str,
    description: str,
    attributes: dict[str, str],
    status: str = "'ACTIVE'",
) -> DataFrame:
    """Entity rows of one kind; every argument after the kind is a SQL expression."""
    guid = f"concat('{kind}:', CAST({key} AS STRING))"
    pairs = ", ".join(f"'{k}', CAST({column} AS STRING)" for k, column in attributes.items())
    return df.selectExpr(
        f"{guid} AS guid",
        f"'{kind}' AS type_name",
        f"concat({guid}, '@primary') AS qualified_name",
        f"{name} AS name",
        f"{owner} AS owner",
        f"{description} AS description",
        f"{status} AS status",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS create_time",
        f"map({pairs}) AS attributes",
    )


def part_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as datasets, owned by their brand and described by their type."""
    return _entities(
        table(spark, sf_dir, "part"),
        "part",
        "p_partkey",
        "p_name",
        "p_brand",
        "p_type",
        {"brand": "p_brand", "type": "p_type", "size": "p_size"},
    )


def customer_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as datasets.

    Those of one segment have no description, those in debt no owner, and those deep in
    debt are deleted.
    """
    return _entities(
        table(spark, sf_dir, "customer"),
        "customer",
        "c_custkey",
        "c_name",
        "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END",
        "CASE WHEN c_mktsegment <> 'BUILDING' THEN concat('Customer in ', c_mktsegment) END",
        {"segment": "c_mktsegment", "nation": "c_nationkey"},
        "CASE WHEN c_acctbal < -900 THEN 'DELETED' ELSE 'ACTIVE' END",
    )


def nation_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entities(
        table(spark, sf_dir, "nation"),
        "nation",
        "n_nationkey",
        "n_name",
        "CAST(NULL AS STRING)",
        "'Nation'",
        {"region": "n_regionkey"},
    )


def supply_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as supply processes."""
    return _entities(
        table(spark, sf_dir, "supplier"),
        "supply",
        "s_suppkey",
        "s_name",
        "'ETL_SERVICE'",
        "CAST(NULL AS STRING)",
        {"nation": "s_nationkey"},
    )


def order_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as order processes."""
    return _entities(
        table(spark, sf_dir, "orders"),
        "order",
        "o_orderkey",
        "concat('order_', CAST(o_orderkey AS STRING))",
        "'ETL_SERVICE'",
        "o_orderpriority",
        {
            "status": "o_orderstatus",
            "price": "o_totalprice",
            "priority": "o_orderpriority",
            "customer": "o_custkey",
        },
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entities: customers, parts, nations, supplies and orders."""
    kinds = [customer_entities, part_entities, nation_entities, supply_entities, order_entities]
    return bulk_batch(*[kind(spark, sf_dir) for kind in kinds])


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags given by rules on owner, type and attributes of the entities."""
    parts = part_entities(spark, sf_dir)
    customers = customer_entities(spark, sf_dir)
    nations = nation_entities(spark, sf_dir)
    return (
        apply_classification(parts, F.col("owner").isin("Brand#1", "Brand#2"), "PII")
        .unionByName(apply_classification(parts, F.col("description") == "PROMO", "Internal"))
        .unionByName(
            apply_classification(
                customers, F.col("attributes")["segment"] == "BUILDING", "BusinessCritical"
            )
        )
        .unionByName(
            apply_classification(nations, F.col("attributes")["region"] == "0", "Confidential")
        )
    )


def roots(spark: SparkSession, *guids: str) -> DataFrame:
    """Start nodes of a traversal, given as parameters."""
    return spark.createDataFrame([(g,) for g in guids], "guid STRING")


# ---- the same views for the SQL check --------------------------------------------------

EMP_SQL = """emp AS (
  SELECT l_orderkey AS id, l_linenumber AS line, l_quantity AS age,
         l_extendedprice AS salary, l_returnflag AS department
  FROM lineitem)"""

EDGES_SQL = """edges AS (
  SELECT 'customer:' || o_custkey AS src_guid, 'order:' || o_orderkey AS dst_guid FROM orders
  UNION SELECT 'order:' || l_orderkey, 'part:' || l_partkey FROM lineitem
  UNION SELECT 'part:' || l_partkey, 'supply:' || l_suppkey FROM lineitem
  UNION SELECT 'supply:' || s_suppkey, 'nation:' || s_nationkey FROM supplier)"""

CATALOG_SQL = """catalog AS (
  SELECT 'customer:' || c_custkey AS guid, 'customer' AS type_name,
         'customer:' || c_custkey || '@primary' AS qualified_name, c_name AS name,
         CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS owner,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN 'Customer in ' || c_mktsegment END
           AS description,
         CASE WHEN c_acctbal < -900 THEN 'DELETED' ELSE 'ACTIVE' END AS status
  FROM customer
  UNION ALL
  SELECT 'part:' || p_partkey, 'part', 'part:' || p_partkey || '@primary', p_name, p_brand,
         p_type, 'ACTIVE' FROM part
  UNION ALL
  SELECT 'nation:' || n_nationkey, 'nation', 'nation:' || n_nationkey || '@primary', n_name,
         NULL, 'Nation', 'ACTIVE' FROM nation
  UNION ALL
  SELECT 'supply:' || s_suppkey, 'supply', 'supply:' || s_suppkey || '@primary', s_name,
         'ETL_SERVICE', NULL, 'ACTIVE' FROM supplier
  UNION ALL
  SELECT 'order:' || o_orderkey, 'order', 'order:' || o_orderkey || '@primary',
         'order_' || o_orderkey, 'ETL_SERVICE', o_orderpriority, 'ACTIVE' FROM orders)"""

TAGS_SQL = """tags AS (
  SELECT 'part:' || p_partkey AS guid, 'PII' AS classification FROM part
  WHERE p_brand IN ('Brand#1', 'Brand#2')
  UNION ALL SELECT 'part:' || p_partkey, 'Internal' FROM part WHERE p_type = 'PROMO'
  UNION ALL SELECT 'customer:' || c_custkey, 'BusinessCritical' FROM customer
  WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT 'nation:' || n_nationkey, 'Confidential' FROM nation
  WHERE n_regionkey = 0)"""


def walk_sql(name: str, root_list: str, depth: int, forward: bool) -> str:
    """Recursive SQL for one walk; ``root_list`` is a VALUES list."""
    here, there = ("src_guid", "dst_guid") if forward else ("dst_guid", "src_guid")
    return f"""{name}_steps(root, guid, hop) AS (
  SELECT r, r, 0 FROM (VALUES {root_list}) v(r)
  UNION
  SELECT s.root, e.{there}, s.hop + 1
  FROM {name}_steps s JOIN edges e ON e.{here} = s.guid WHERE s.hop < {depth}),
{name} AS (SELECT root, guid, MIN(hop) AS hop FROM {name}_steps GROUP BY root, guid)"""
