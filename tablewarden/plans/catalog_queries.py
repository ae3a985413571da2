"""Queries over the metadata catalog, with the SQL that gives the same result."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions import documents as docs
from tablewarden.functions import naming
from tablewarden.materialize import materialize
from tablewarden.operators import audit, columns, entities, relationships, tagging, validation
from tablewarden.operators import search as searching
from tablewarden.operators.lineage import build_edges
from tablewarden.operators.model import RELATIONSHIP_DEFS
from tablewarden.operators.quality import column_stats
from tablewarden.operators.typedefs import (
    ENTITY,
    Attr,
    TypeDef,
    default_types,
    list_types,
    register_types,
)
from tablewarden.plans.views import (
    TABLE_SCHEMAS,
    CATALOG_SQL,
    EDGES_SQL,
    TAGS_SQL,
    catalog,
    customer_entities,
    graph_io,
    node,
    order_entities,
    part_entities,
    table,
    tags,
)
from tablewarden.sources.files import read_parquet

RUN_TIME = datetime(2024, 1, 31, 12, 0, 0)
RUN_SECONDS = 1_706_702_400

HARVESTED = list(TABLE_SCHEMAS)

PII_RULES = [
    ("blue_ring", None),
    ("red_widget", "promo"),
    ("Small_Ring", "economy"),
    ("name", "string"),
]

ORDER_TYPE = TypeDef(
    "order",
    ENTITY,
    ("Process",),
    (
        Attr("status", required=True, enum=("O", "F")),
        Attr("price", "float"),
        Attr("priority", "int"),
        Attr("customer", "long", required=True, unique=True),
        Attr("clerk", required=True),
    ),
)

RELATIONSHIP_ENDS = [
    ("placed", "customer", "orders", "SINGLE", "order", "customer", "SINGLE"),
    ("contains", "order", "parts", "SET", "part", "orders", "SET"),
    ("supplied", "part", "supplier", "SET", "supply", "parts", "SINGLE"),
]


# ---- building and merging entities -----------------------------------------------------


def harvest_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column entities of the tables with the statistics captured from their rows."""
    frames = {name: read_parquet(spark, f"{sf_dir}/{name}.parquet") for name in HARVESTED}
    listed = [(name, df.schema, None) for name, df in frames.items()]
    found = entities.harvest_tables(spark, "bench", listed).filter("type_name = 'hive_column'")
    counts = [
        column_stats(df, bounds=False, distinct=False).select(
            naming.column_name(F.lit("bench"), F.lit(name), "column_name").alias("qualified_name"),
            "n_rows",
            "n_nulls",
        )
        for name, df in frames.items()
    ]
    return found.join(entities.bulk_batch(*counts), "qualified_name").select(
        "guid",
        "qualified_name",
        "name",
        F.col("attributes")["type"].alias("type"),
        F.col("attributes")["table"].alias("table_name"),
        "n_rows",
        "n_nulls",
    )


def _key_entities(df: DataFrame, type_name: str, key: str, owner: str, at: str) -> DataFrame:
    text = F.col(key).cast("string")
    return entities.entity_rows(
        df,
        F.lit(type_name),
        naming.table_name(F.lit("bench"), F.concat(F.lit(f"{type_name}_"), text)),
        F.concat(F.lit(f"{type_name}_"), text),
        owner,
        None,
        at,
    )


def _existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").withColumn(
        "created", F.expr("TIMESTAMP_NTZ '1990-01-01 00:00:00'")
    )
    return _key_entities(customers, "customer", "c_custkey", "c_mktsegment", "created")


def upsert_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known customers, then customers named by orders and orders named by line items."""
    incoming = entities.bulk_batch(
        _key_entities(
            table(spark, sf_dir, "orders"), "customer", "o_custkey", "o_orderstatus", "o_orderdate"
        ),
        _key_entities(
            table(spark, sf_dir, "lineitem"), "order", "l_orderkey", "l_returnflag", "l_shipdate"
        ),
    )
    merged = entities.upsert_entities(_existing(spark, sf_dir), incoming)
    return merged.select("guid", "type_name", "qualified_name", "name", "owner", "create_time")


def bulk_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch of file, table, column and process entities with differing columns."""
    pages = table(spark, sf_dir, "pages")
    files = entities.dataset_entities(pages, "url", "HTML", "Web page").select(
        "type_name", "qualified_name", "name", "description"
    )
    parts = part_entities(spark, sf_dir).select("type_name", "qualified_name", "name", "owner")
    supplies = table(spark, sf_dir, "supplier").select(
        F.lit("supply").alias("type_name"),
        F.concat(node("supply", "s_suppkey"), F.lit("@primary")).alias("qualified_name"),
        F.col("s_name").alias("name"),
    )
    return entities.bulk_batch(files, parts, supplies)


def register_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    files = entities.dataset_entities(pages, "url", "HTML", "Web page")
    return files.select("guid", "type_name", "qualified_name", "name", "owner", "description")


def register_processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a process run at its order date."""
    runs = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("order_"), F.col("o_custkey").cast("string")).alias("name"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("description"),
        F.col("o_orderdate").alias("run_ts"),
    )
    stamped = entities.process_entities(runs)
    marked = entities.process_entities(runs, epoch_mark=True)
    return stamped.unionByName(marked).select(
        "guid", "type_name", "qualified_name", "name", "description", "create_time"
    )


def process_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs and outputs of supply processes, exploded from arrays."""
    lineitem = table(spark, sf_dir, "lineitem")
    runs = lineitem.select(
        node("order", "l_orderkey").alias("guid"),
        F.array(node("part", "l_partkey"), node("supply", "l_suppkey")).alias("inputs"),
        F.array(node("line", "l_linenumber")).alias("outputs"),
    )
    return entities.process_io(runs)


def resolve_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders to customers and on to nations; the part key stands in as a wrong customer."""
    orders = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        naming.table_name(
            F.lit("bench"), F.concat(F.lit("customer_"), F.col("l_partkey").cast("string"))
        ).alias("ref_qualified_name"),
    )
    customers = _existing(spark, sf_dir)
    found = entities.resolve_refs(orders, customers, "customer", "customer")
    nation_name = F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"))
    homes = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("customer_"), F.col("c_custkey").cast("string")).alias("customer_name"),
        naming.entity_guid(F.lit("nation"), naming.table_name(F.lit("bench"), nation_name)).alias(
            "ref_guid"
        ),
    )
    nations = _key_entities(
        table(spark, sf_dir, "nation").withColumn("created", F.lit(None).cast("timestamp_ntz")),
        "nation",
        "n_nationkey",
        "n_name",
        "created",
    )
    chained = found.join(homes, "customer_name", "left")
    return entities.resolve_refs(chained, nations, "nation", "nation")


def missing_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers named by orders that the live catalog does not hold."""
    expected = table(spark, sf_dir, "orders").select(
        F.lit("customer").alias("type_name"),
        F.concat(
            F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")
        ).alias("name"),
    )
    return entities.missing_entities(customer_entities(spark, sf_dir), expected)


def entity_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part entities encoded as JSON documents and decoded again."""
    parts = part_entities(spark, sf_dir)
    tagged = parts.join(tagging.tag_sets(tags(spark, sf_dir)), "guid", "left")
    encoded = tagged.select(
        "guid", docs.encode_document("type_name", "attributes", "tags").alias("document")
    )
    decoded = encoded.withColumn("entity", docs.decode_document("document"))
    return decoded.select(
        "guid",
        F.col("entity.typeName").alias("type_name"),
        F.col("entity.attributes")["brand"].alias("brand"),
        F.col("entity.attributes")["size"].alias("size"),
        F.concat_ws(",", docs.tag_set("entity.classifications")).alias("tags"),
        F.get_json_object("document", "$.attributes.type").alias("part_type"),
    )


# ---- types and rules -------------------------------------------------------------------


def list_entity_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types derived from part types, their attributes from brands."""
    defs = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("type_name"),
        F.when(F.col("p_size") > 25, "ENTITY").otherwise("CLASSIFICATION").alias("category"),
        F.col("p_brand").alias("attr_name"),
    )
    return list_types(defs, "ENTITY")


def validate_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a type with an enum, a wrong type, a unique and a missing attribute."""
    orders = order_entities(spark, sf_dir)
    stray = customer_entities(spark, sf_dir)
    return validation.validate_entities(
        entities.bulk_batch(orders, stray), register_types(spark, [ORDER_TYPE])
    )


def validate_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality check per order and a KPI per customer against the built-in types.

    The KPI has no name, and its target is the market segment, which is no number. The
    check has an attribute that its type does not declare, and its id is the customer's.
    """
    none = F.lit(None).cast("string")
    orders = table(spark, sf_dir, "orders")
    checks = entities.entity_rows(
        orders,
        F.lit("DataQualityCheck"),
        F.concat(F.lit("check:"), F.col("o_orderkey").cast("string")),
        none,
        attributes=F.create_map(
            F.lit("checkId"), F.col("o_custkey").cast("string"),
            F.lit("threshold"), F.col("o_totalprice").cast("string"),
            F.lit("priority"), F.col("o_orderpriority"),
        ),
    )
    kpis = entities.entity_rows(
        table(spark, sf_dir, "customer"),
        F.lit("BusinessKPI"),
        F.concat(F.lit("kpi:"), F.col("c_custkey").cast("string")),
        none,
        attributes=F.create_map(
            F.lit("kpiId"), F.col("c_custkey").cast("string"), F.lit("targetValue"), F.col("c_mktsegment")
        ),
    )
    both = entities.bulk_batch(checks, kpis)
    return validation.validate_entities(both, default_types(spark))


def search_without_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose batch had no status column are live."""
    parts = part_entities(spark, sf_dir)
    mixed = entities.bulk_batch(
        parts.filter("guid LIKE '%1'"), parts.filter("guid NOT LIKE '%1'").drop("status")
    )
    return _page(searching.search(mixed, type_name="part", name_contains="ring"))


def cardinality_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    links = [
        relationships.link(
            orders, "placed", node("customer", "o_custkey"), node("order", "o_orderkey")
        ),
        relationships.link(
            lines, "contains", node("order", "l_orderkey"), node("part", "l_partkey")
        ),
        relationships.link(
            lines, "supplied", node("part", "l_partkey"), node("supply", "l_suppkey")
        ),
    ]
    ends = spark.createDataFrame(RELATIONSHIP_ENDS, RELATIONSHIP_DEFS)
    return validation.cardinality_violations(entities.bulk_batch(*links), ends)


def tag_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as columns: the name is the column name and the type its data type."""
    cols = table(spark, sf_dir, "part").select(
        node("part", "p_partkey").alias("guid"),
        F.regexp_replace("p_name", " ", "_").alias("name"),
        F.lower("p_type").alias("data_type"),
    )
    return tagging.tag_pii(cols, PII_RULES).select("guid", "classification", "propagated")


def classify_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tag with attributes for promoted parts that are not tagged as internal yet."""
    return tagging.apply_classification(
        part_entities(spark, sf_dir),
        F.col("owner").isin("Brand#3", "Brand#4") | (F.col("description") == "PROMO"),
        "Internal",
        {"level": "Internal", "justification": "Promotion"},
        tags(spark, sf_dir),
    ).select(
        "guid", "classification", F.col("attributes")["level"].alias("level"), "propagated"
    )


def tag_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.tag_sets(tags(spark, sf_dir)).select(
        "guid", F.concat_ws(",", "tags").alias("tags"), F.size("tags").alias("n_tags")
    )


def business_metadata_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last properties written per user and kind of event."""
    events = table(spark, sf_dir, "events").select(
        node("user", "user_id").alias("guid"),
        F.col("event_type").alias("bm_name"),
        F.create_map(F.lit("k"), F.get_json_object("props", "$.k")).alias("attributes"),
        F.col("ts").alias("written_at"),
        F.col("event_id").alias("seq"),
    )
    earlier, later = events.filter("value < 10"), events.filter("value >= 10 OR value IS NULL")
    return tagging.apply_business_metadata(earlier, later).select(
        "guid", "bm_name", F.col("attributes")["k"].alias("k"), "written_at", "seq"
    )


# ---- search and audit ------------------------------------------------------------------


def _page(found: DataFrame) -> DataFrame:
    return found.select("guid", "type_name", "qualified_name", "name", "owner")


def search_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page(
        searching.search(
            catalog(spark, sf_dir),
            type_name="part",
            attributes={"owner": "Brand#13", "type": "PROMO"},
        )
    )


def search_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page(searching.search(catalog(spark, sf_dir), type_name="part", name_contains="ring"))


def search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page(
        searching.search(catalog(spark, sf_dir), type_name="customer", text="FURN")
    )


def search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page(
        searching.search(catalog(spark, sf_dir), type_name="customer", limit=10, offset=20)
    )


def search_tag_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page(
        searching.search(
            catalog(spark, sf_dir),
            tags(spark, sf_dir),
            type_name="part",
            tag="PII",
            limit=10,
            offset=5,
        )
    )


def catalog_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.catalog_summary(catalog(spark, sf_dir), tags(spark, sf_dir))


def metadata_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = ["described", "owned", "tagged", "with_lineage"]
    found = audit.metadata_audit(
        catalog(spark, sf_dir),
        tags(spark, sf_dir),
        build_edges(graph_io(spark, sf_dir), unique=True),
    )
    return found.withColumns({name: F.round(name, 6) for name in shares})


# ---- columns ---------------------------------------------------------------------------


def _line_columns(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """Suppliers as tables, parts as columns, and the last return flag as the type."""
    return (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_linestatus") == status)
        .groupBy(
            node("supply", "l_suppkey").alias("table_name"),
            node("part", "l_partkey").alias("name"),
        )
        .agg(F.max("l_returnflag").alias("data_type"))
    )


def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of all supplier tables between finished and open line items."""
    return columns.schema_diff(
        _line_columns(spark, sf_dir, "F"),
        _line_columns(spark, sf_dir, "O"),
        ["table_name", "name"],
    )


def _known_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as tables and parts of finished line items as their columns.

    Written once: the table is joined twice, and a join with a table, unlike one behind
    an aggregate on the same key, lets adaptive execution split a hot key.
    """
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == "F")
    named = lines.select("l_suppkey", "l_partkey").distinct().select(
        node("supply", "l_suppkey").alias("table_name"), node("part", "l_partkey").alias("name")
    )
    known = named.withColumn("guid", F.concat_ws(".", "table_name", "name"))
    return materialize(known, "columns").frame


def _mapping(lines: DataFrame) -> DataFrame:
    """Mapping between supplier tables by line item.

    Each maps its part from its supplier's table to the table of the supplier whose key
    is its line number.
    """
    return lines.select("l_suppkey", "l_partkey", "l_linenumber").distinct().select(
        node("supply", "l_suppkey").alias("src_table"),
        node("part", "l_partkey").alias("src_column"),
        node("supply", "l_linenumber").alias("dst_table"),
        node("part", "l_partkey").alias("dst_column"),
    )


def _open_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping by open line items: source and target names may be unknown columns."""
    return _mapping(table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == "O"))


def column_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.column_lineage(_known_columns(spark, sf_dir), _open_mapping(spark, sf_dir))


def column_processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processes of all line items; only the other two need unknown names."""
    return columns.column_processes(_mapping(table(spark, sf_dir, "lineitem")), RUN_TIME).select(
        "guid", "type_name", "qualified_name", "name", "create_time"
    )


def column_process_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.column_process_io(
        _known_columns(spark, sf_dir), _open_mapping(spark, sf_dir), RUN_TIME
    )


QUERIES = {
    "harvest_columns": harvest_columns,
    "upsert_entities": upsert_entities,
    "bulk_entities": bulk_entities,
    "register_datasets": register_datasets,
    "register_processes": register_processes,
    "process_io": process_io,
    "resolve_refs": resolve_refs,
    "missing_entities": missing_entities,
    "entity_documents": entity_documents,
    "list_types": list_entity_types,
    "validate_entities": validate_entities,
    "validate_checks": validate_checks,
    "search_without_status": search_without_status,
    "cardinality_violations": cardinality_violations,
    "tag_pii": tag_pii,
    "classify_by_rule": classify_by_rule,
    "tag_sets": tag_sets,
    "business_metadata_latest": business_metadata_latest,
    "search_attributes": search_attributes,
    "search_contains": search_contains,
    "search_text": search_text,
    "search_page": search_page,
    "search_tag_page": search_tag_page,
    "catalog_summary": catalog_summary,
    "metadata_audit": metadata_audit,
    "schema_diff": schema_diff,
    "column_lineage": column_lineage,
    "column_processes": column_processes,
    "column_process_io": column_process_io,
}

# ---- the same in SQL -------------------------------------------------------------------

_TABLE_COLUMNS = {name: ddl.lower() for name, ddl in TABLE_SCHEMAS.items()}


def _harvest_sql() -> str:
    parts = []
    for name, ddl in _TABLE_COLUMNS.items():
        for column, kind in (pair.split() for pair in ddl.split(", ")):
            qn = f"bench.{name}.{column}@primary"
            parts.append(
                f"SELECT sha256('hive_column|{qn}') AS guid, '{qn}' AS qualified_name, "
                f"'{column}' AS name, '{kind}' AS type, 'bench.{name}@primary' AS table_name, "
                f"COUNT(*) AS n_rows, COUNT(*) - COUNT({column}) AS n_nulls FROM {name}"
            )
    return "\nUNION ALL\n".join(parts)


def _key_sql(source: str, type_name: str, key: str, owner: str, at: str) -> str:
    name = f"'{type_name}_' || {key}"
    return f"""SELECT sha256('{type_name}|bench.' || {name} || '@primary') AS guid,
  '{type_name}' AS type_name, 'bench.' || {name} || '@primary' AS qualified_name,
  {name} AS name, {owner} AS owner, {at} AS create_time FROM {source}"""


_PAGE = "guid, type_name, qualified_name, name, owner"
_LIVE = f"WITH {CATALOG_SQL}, live AS (SELECT * FROM catalog WHERE status <> 'DELETED')"

_COLUMN_VERSIONS = """v AS (
  SELECT 'supply:' || l_suppkey AS table_name, 'part:' || l_partkey AS name, l_linestatus AS s,
         MAX(l_returnflag) AS data_type
  FROM lineitem GROUP BY ALL)"""

_MAPPING = f"""{_COLUMN_VERSIONS},
cols AS (SELECT table_name, name, table_name || '.' || name AS guid FROM v WHERE s = 'F'),
mapping AS (
  SELECT DISTINCT 'supply:' || l_suppkey AS src_table, 'part:' || l_partkey AS src_column,
         'supply:' || l_linenumber AS dst_table, 'part:' || l_partkey AS dst_column
  FROM lineitem WHERE l_linestatus = 'O')"""

ORACLES = {
    "harvest_columns": _harvest_sql(),
    "upsert_entities": f"""WITH existing AS ({_key_sql(
        "customer", "customer", "c_custkey", "c_mktsegment", "TIMESTAMP '1990-01-01 00:00:00'"
    )}),
incoming AS ({_key_sql("orders", "customer", "o_custkey", "o_orderstatus", "o_orderdate")}
UNION ALL {_key_sql("lineitem", "order", "l_orderkey", "l_returnflag", "l_shipdate")}),
firsts AS (SELECT * FROM incoming i
  WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.guid = i.guid)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY guid ORDER BY create_time, owner) = 1)
SELECT * FROM existing UNION ALL SELECT * FROM firsts""",
    "bulk_entities": """SELECT 'fs_path' AS type_name, url || '@primary' AS qualified_name,
  split_part(url, '/', -1) AS name, 'Web page file in HTML format' AS description,
  NULL AS owner FROM pages
UNION ALL SELECT 'part', 'part:' || p_partkey || '@primary', p_name, NULL, p_brand FROM part
UNION ALL SELECT 'supply', 'supply:' || s_suppkey || '@primary', s_name, NULL, NULL
FROM supplier""",
    "register_datasets": """SELECT sha256('fs_path|' || url || '@primary') AS guid,
  'fs_path' AS type_name, url || '@primary' AS qualified_name,
  split_part(url, '/', -1) AS name, 'ETL_SERVICE' AS owner,
  'Web page file in HTML format' AS description FROM pages""",
    "register_processes": """WITH r AS (
  SELECT 'order_' || o_custkey AS name, o_orderdate AS t,
    CASE WHEN o_orderstatus = 'O' THEN o_orderpriority
      ELSE 'ETL process transforming data: order_' || o_custkey END AS description
  FROM orders),
q AS (
  SELECT *, name || '_' || strftime(t, '%Y%m%d%H%M%S') || '@primary' AS qn FROM r
  UNION ALL
  SELECT *, name || '_' || (epoch_us(t) // 1000000)::BIGINT || '@primary' AS qn FROM r)
SELECT sha256('etl_process|' || qn) AS guid, 'etl_process' AS type_name,
  qn AS qualified_name, name, description, t AS create_time FROM q""",
    "process_io": """SELECT 'order:' || l_orderkey AS process_guid, 'input' AS direction,
  'part:' || l_partkey AS dataset_guid FROM lineitem
UNION ALL SELECT 'order:' || l_orderkey, 'input', 'supply:' || l_suppkey FROM lineitem
UNION ALL SELECT 'order:' || l_orderkey, 'output', 'line:' || l_linenumber FROM lineitem""",
    "resolve_refs": """SELECT l_orderkey, l_linenumber,
  CASE WHEN c_custkey IS NOT NULL
    THEN sha256('customer|bench.customer_' || c_custkey || '@primary') END AS customer_guid,
  'customer_' || c_custkey AS customer_name,
  CASE WHEN n_nationkey IS NOT NULL
    THEN sha256('nation|bench.nation_' || n_nationkey || '@primary') END AS nation_guid,
  'nation_' || n_nationkey AS nation_name
FROM lineitem LEFT JOIN customer ON c_custkey = l_partkey
LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "missing_entities": f"""WITH {CATALOG_SQL}
SELECT DISTINCT 'customer' AS type_name, 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS name
FROM orders WHERE NOT EXISTS (
  SELECT 1 FROM catalog WHERE type_name = 'customer' AND status = 'ACTIVE'
    AND catalog.name = 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0'))""",
    "entity_documents": f"""WITH {TAGS_SQL}, t AS (
  SELECT guid, string_agg(classification, ',' ORDER BY classification) AS tags
  FROM tags GROUP BY guid)
SELECT 'part:' || p_partkey AS guid, 'part' AS type_name, p_brand AS brand,
  p_size::VARCHAR AS size, COALESCE(t.tags, '') AS tags, p_type AS part_type
FROM part LEFT JOIN t ON t.guid = 'part:' || p_partkey""",
    "list_types": "SELECT DISTINCT p_type AS type_name FROM part WHERE p_size > 25",
    "validate_entities": """SELECT 'order:' || o_orderkey AS guid, 'order' AS type_name,
  'status' AS attribute, 'not_in_enum' AS kind, o_orderstatus AS value, 1::BIGINT AS n
FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
UNION ALL SELECT 'order:' || o_orderkey, 'order', 'priority', 'wrong_type', o_orderpriority, 1
FROM orders WHERE TRY_CAST(o_orderpriority AS INTEGER) IS NULL
UNION ALL SELECT 'order:' || o_orderkey, 'order', 'clerk', 'missing_required', NULL, 1
FROM orders
UNION ALL SELECT 'customer:' || c_custkey, 'customer', NULL, 'unknown_type', NULL, 1
FROM customer
UNION ALL SELECT NULL, 'order', 'customer', 'duplicate_unique', o_custkey::VARCHAR, COUNT(*)
FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1""",
    "validate_checks": """WITH c AS (
  SELECT sha256('DataQualityCheck|check:' || o_orderkey) AS guid, o_custkey, o_orderpriority FROM orders),
k AS (SELECT sha256('BusinessKPI|kpi:' || c_custkey) AS guid, c_mktsegment FROM customer)
SELECT guid, 'DataQualityCheck' AS type_name, 'priority' AS attribute,
  'undeclared_attribute' AS kind, o_orderpriority AS value, 1::BIGINT AS n FROM c
UNION ALL SELECT NULL, 'DataQualityCheck', 'checkId', 'duplicate_unique', o_custkey::VARCHAR, COUNT(*)
FROM c GROUP BY o_custkey HAVING COUNT(*) > 1
UNION ALL SELECT guid, 'BusinessKPI', 'kpiName', 'missing_required', NULL, 1 FROM k
UNION ALL SELECT guid, 'BusinessKPI', 'targetValue', 'wrong_type', c_mktsegment, 1 FROM k""",
    "search_without_status": f"""WITH {CATALOG_SQL} SELECT {_PAGE} FROM catalog
WHERE type_name = 'part' AND name LIKE '%ring%' AND (guid NOT LIKE '%1' OR status <> 'DELETED')""",
    "cardinality_violations": """WITH l AS (
  SELECT 'placed' AS rel_type, 'end1' AS rel_end, 'customer:' || o_custkey AS guid,
    'order:' || o_orderkey AS partner FROM orders
  UNION SELECT 'placed', 'end2', 'order:' || o_orderkey, 'customer:' || o_custkey FROM orders
  UNION SELECT 'supplied', 'end2', 'supply:' || l_suppkey, 'part:' || l_partkey FROM lineitem)
SELECT rel_type, rel_end, guid, COUNT(*) AS n_partners FROM l
GROUP BY ALL HAVING COUNT(*) > 1""",
    "tag_pii": """SELECT 'part:' || p_partkey AS guid, 'PII' AS classification,
  FALSE AS propagated FROM part
WHERE p_name = 'blue ring' OR (p_name = 'red widget' AND p_type = 'PROMO')
  OR (p_name = 'small ring' AND p_type = 'ECONOMY')""",
    "classify_by_rule": """SELECT 'part:' || p_partkey AS guid, 'Internal' AS classification,
  'Internal' AS level, FALSE AS propagated FROM part
WHERE p_brand IN ('Brand#3', 'Brand#4') AND p_type <> 'PROMO'""",
    "tag_sets": f"""WITH {TAGS_SQL} SELECT guid,
  string_agg(classification, ',' ORDER BY classification) AS tags,
  COUNT(*)::INTEGER AS n_tags FROM (SELECT DISTINCT * FROM tags) GROUP BY guid""",
    "business_metadata_latest": """SELECT 'user:' || user_id AS guid, event_type AS bm_name,
  json_extract_string(props, '$.k') AS k, ts AS written_at, event_id AS seq FROM events
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC)
  = 1""",
    "search_attributes": f"""SELECT 'part:' || p_partkey AS guid, 'part' AS type_name,
  'part:' || p_partkey || '@primary' AS qualified_name, p_name AS name, p_brand AS owner
FROM part WHERE p_brand = 'Brand#13' AND p_type = 'PROMO'""",
    "search_contains": f"""{_LIVE} SELECT {_PAGE} FROM live
WHERE type_name = 'part' AND contains(name, 'ring')""",
    "search_text": f"""{_LIVE} SELECT {_PAGE} FROM live WHERE type_name = 'customer'
  AND (contains(name, 'FURN') OR contains(qualified_name, 'FURN')
    OR contains(description, 'FURN'))""",
    "search_page": f"""{_LIVE} SELECT {_PAGE} FROM live WHERE type_name = 'customer'
ORDER BY qualified_name, guid LIMIT 10 OFFSET 20""",
    "search_tag_page": f"""{_LIVE}, {TAGS_SQL} SELECT {_PAGE} FROM live
WHERE type_name = 'part' AND guid IN (SELECT guid FROM tags WHERE classification = 'PII')
ORDER BY qualified_name, guid LIMIT 10 OFFSET 5""",
    "catalog_summary": f"""WITH {CATALOG_SQL}, {TAGS_SQL}
SELECT 'type' AS kind, type_name AS name, COUNT(*) AS n_entities FROM catalog GROUP BY type_name
UNION ALL
SELECT 'classification', classification, COUNT(DISTINCT guid) FROM tags
GROUP BY classification""",
    "metadata_audit": f"""WITH {CATALOG_SQL}, {TAGS_SQL}, {EDGES_SQL},
f AS (
  SELECT type_name, (COALESCE(description, '') <> '')::INT AS d,
    (COALESCE(owner, '') <> '')::INT AS o,
    (guid IN (SELECT guid FROM tags))::INT AS t,
    (guid IN (SELECT src_guid FROM edges UNION SELECT dst_guid FROM edges))::INT AS l
  FROM catalog)
SELECT type_name, COUNT(*) AS n_entities, ROUND(AVG(d), 6) AS described,
  ROUND(AVG(o), 6) AS owned, ROUND(AVG(t), 6) AS tagged, ROUND(AVG(l), 6) AS with_lineage
FROM f GROUP BY type_name""",
    "schema_diff": f"""WITH {_COLUMN_VERSIONS}
SELECT COALESCE(a.table_name, b.table_name) AS table_name, COALESCE(a.name, b.name) AS name,
  a.data_type AS old_type, b.data_type AS new_type,
  CASE WHEN a.name IS NULL THEN 'added' WHEN b.name IS NULL THEN 'removed' ELSE 'retyped' END
    AS change
FROM (SELECT * FROM v WHERE s = 'F') a
FULL JOIN (SELECT * FROM v WHERE s = 'O') b ON a.table_name = b.table_name AND a.name = b.name
WHERE a.data_type IS DISTINCT FROM b.data_type""",
    "column_lineage": f"""WITH {_MAPPING}
SELECT src_table, dst_table, s.guid AS src_guid, d.guid AS dst_guid FROM mapping
JOIN cols s ON s.table_name = src_table AND s.name = src_column
JOIN cols d ON d.table_name = dst_table AND d.name = dst_column""",
    "column_processes": f"""WITH {_MAPPING},
p AS (SELECT DISTINCT src_table || '_to_' || dst_table AS pair FROM mapping)
SELECT sha256('ColumnLineageProcess|column_lineage_' || pair || '_{RUN_SECONDS}') AS guid,
  'ColumnLineageProcess' AS type_name,
  'column_lineage_' || pair || '_{RUN_SECONDS}' AS qualified_name,
  'column_mapping_' || pair AS name, TIMESTAMP '{RUN_TIME}' AS create_time FROM p""",
    "column_process_io": f"""WITH {_MAPPING}, io AS (
  SELECT DISTINCT src_table || '_to_' || dst_table AS pair, 'input' AS direction, guid
  FROM mapping JOIN cols ON table_name = src_table AND name = src_column
  UNION ALL
  SELECT DISTINCT src_table || '_to_' || dst_table, 'output', guid
  FROM mapping JOIN cols ON table_name = dst_table AND name = dst_column)
SELECT sha256('ColumnLineageProcess|column_lineage_' || pair || '_{RUN_SECONDS}')
    AS process_guid, direction, guid AS dataset_guid FROM io""",
}
