"""Queries over several runs, loads and batches, with the SQL that gives the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewarden.materialize import materialize, scratch_path
from tablewarden.operators import (
    audit,
    columns,
    entities,
    gram_index,
    integrity,
    lineage,
    load_stats,
    pages,
    plan_mapping,
    runs,
    transforms,
)
from tablewarden.operators.model import ENTITIES
from tablewarden.plans.catalog_queries import _existing, _key_entities
from tablewarden.plans.record_queries import TRANSFORM_SQL
from tablewarden.plans.views import (
    CATALOG_SQL,
    EDGES_SQL,
    EMP_SQL,
    RUN_DATE,
    catalog,
    employees,
    graph_io,
    node,
    row_tasks,
    table,
)
from tablewarden.streaming import ingest, merged

PAGE_ROWS = 25
RANGES = 7


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities that arrive as files in two runs, merged into a catalog that knows the customers.

    Finished orders and line items come first, the others in the second run.
    """
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "merged")
    merged.start_catalog(_existing(spark, sf_dir), target)
    found = merged.read_merged(spark, target)
    for status in ("F", "not F"):
        done = status == "F"
        orders = table(spark, sf_dir, "orders").filter((F.col("o_orderstatus") == "F") == done)
        lines = table(spark, sf_dir, "lineitem").filter((F.col("l_linestatus") == "F") == done)
        arriving = entities.bulk_batch(
            _key_entities(orders, "customer", "o_custkey", "o_orderstatus", "o_orderdate"),
            _key_entities(lines, "order", "l_orderkey", "l_returnflag", "l_shipdate"),
        )
        arriving.write.mode("append").option("compression", "zstd").parquet(landing)
        files = spark.readStream.schema(ENTITIES).parquet(landing)
        found = ingest.merge_stream(files, target, f"{target}-progress")
    return found.select("guid", "type_name", "qualified_name", "name", "owner", "create_time")


def verify_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that orders name and the catalog lacks, and those in it without lineage.

    Customers of one nation have no status, as in a batch that had no such column: they are live.
    """
    known = catalog(spark, sf_dir).filter("type_name = 'customer'")
    unset = F.when(F.col("attributes")["nation"] != "3", F.col("status"))
    expected = table(spark, sf_dir, "orders").select(
        F.lit("customer").alias("type_name"),
        F.concat(node("customer", "o_custkey"), F.lit("@primary")).alias("qualified_name"),
    )
    edges = lineage.build_edges(graph_io(spark, sf_dir), unique=True)
    return audit.catalog_faults(known.withColumn("status", unset), edges, expected, "customer")


def search_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by a part of their name, customers by any text, and a text too short for grams."""
    index = gram_index.write_index(catalog(spark, sf_dir), scratch_path(spark, "grams"))
    wanted = [("part", "ring", ("name",)), ("customer", "FURN", gram_index.FIELDS), ("nation", "ON_1", ("name",)),
              ("supply", "r#", ("name",))]
    found = [
        gram_index.contains(index, text, fields)
        .filter(F.col("type_name") == kind)
        .select(F.lit(text).alias("text"), "guid", "name", "description")
        for kind, text, fields in wanted
    ]
    return entities.bulk_batch(*found)


def deep_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page in the middle of the catalog, one near its end, and the one that follows the first."""
    known = catalog(spark, sf_dir).select("guid", "type_name", "qualified_name", "name")
    count = known.count()
    ordered = pages.write_ordered(known, scratch_path(spark, "ordered"), range_rows=-(-count // RANGES))
    middle = pages.page(ordered, count // 2, PAGE_ROWS)
    last = middle.orderBy(F.desc("qualified_name"), F.desc("guid")).select("qualified_name", "guid").first()
    parts = {
        "middle": middle,
        "end": pages.page(ordered, count - 10, PAGE_ROWS),
        "next": pages.page_after(ordered, tuple(last), PAGE_ROWS),
    }
    return entities.bulk_batch(*[df.select(F.lit(name).alias("page"), "*") for name, df in parts.items()])


LOADED = {"orders": "o_orderstatus"}
STATS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate"]


def load_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as three loads by status: statistics of all, and whether the estimates are near."""
    orders, path = table(spark, sf_dir, "orders"), scratch_path(spark, "load-stats")
    rows = orders.select(*STATS)
    for load in ("O", "F", "P"):
        load_stats.store_load(orders.filter(F.col("o_orderstatus") == load).select(*STATS), path, load)
    merged_rows = load_stats.merged_stats(load_stats.read_loads(spark, path))
    errors = load_stats.measured_errors(rows, merged_rows)
    return merged_rows.join(errors, "column_name").select(
        "column_name",
        "n_loads",
        "n_rows",
        "n_nulls",
        "least",
        "greatest",
        (F.col("distinct_error") <= load_stats.DISTINCT_ERROR).alias("distinct_near"),
        (F.col("rank_error") <= load_stats.RANK_ERROR).alias("median_near"),
    )


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Line numbers as runs, suppliers as tables, parts of a size as columns, flags as types."""
    lines = table(spark, sf_dir, "lineitem")
    column = (F.col("l_partkey") % 50).cast("string")
    seen = lines.select(
        F.col("l_linenumber").alias("run"),
        node("supply", "l_suppkey").alias("table_name"),
        F.concat(F.lit("part:"), column).alias("name"),
        F.col("l_returnflag").alias("data_type"),
    )
    return seen, lines.select(F.col("l_linenumber").alias("run")).distinct()


COLUMN_KEYS = ["table_name", "name"]


def schema_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.schema_intervals(*_snapshots(spark, sf_dir), COLUMN_KEYS, row_tasks(spark, sf_dir))


def schema_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that each run had, read from the intervals, which are worked out once."""
    intervals = materialize(schema_intervals(spark, sf_dir), "intervals").frame
    runs = _snapshots(spark, sf_dir)[1]
    found = [
        columns.schema_as_of(intervals, F.lit(r["run"])).withColumn("run", F.lit(r["run"]))
        for r in runs.orderBy("run").collect()
    ]
    return entities.bulk_batch(*found)


def schema_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = _snapshots(spark, sf_dir)[1].agg(F.min("run")).first()[0]
    return columns.schema_changes(schema_intervals(spark, sf_dir), COLUMN_KEYS, F.lit(first))


def load_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a load of them that lost, changed and repeated some and added others."""
    source = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    changed = F.when(key % 1009 == 5, F.lit("X")).otherwise(F.col("o_orderstatus"))
    kept = source.filter(key % 997 != 3).withColumn("o_orderstatus", changed)
    more = kept.filter(key % 1013 == 7)
    others = source.filter(key % 1019 == 11).withColumn("o_orderkey", -key - 1)
    loaded = kept.unionByName(more).unionByName(others)
    return integrity.reconcile_loads(source, loaded, scratch_path(spark, "integrity"), ("o_orderkey",), 64)


def run_processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job per order status, and one that fails, as processes with what their runs did."""
    facts: list[DataFrame] = []
    for status in ("O", "F", "P"):
        with runs.record_run(spark, facts, f"orders_{status}", "FILTER") as run:
            orders = run.reads(table(spark, sf_dir, "orders"))
            kept = run.writes(orders.filter(F.col("o_orderstatus") == status))
            kept.write.parquet(scratch_path(spark, "orders-of-status"))
    try:
        with runs.record_run(spark, facts, "orders_strict", "CHECK", "Refuses all orders") as run:
            refused = run.reads(table(spark, sf_dir, "orders")).select(F.raise_error(F.lit("refused")))
            refused.write.format("noop").mode("overwrite").save()
    except Exception:  # noqa: BLE001 - the failure is what is recorded
        pass
    found = runs.run_processes(entities.bulk_batch(*facts))
    value = F.col("attributes")
    return found.select(
        "type_name",
        "name",
        "description",
        value["operation"].alias("operation"),
        value["rows_in"].alias("rows_in"),
        value["rows_out"].alias("rows_out"),
        value["status"].alias("status"),
        value["user_name"].isNotNull().alias("has_user"),
        (value["start_time"] <= value["end_time"]).alias("in_order"),
        F.coalesce(value["message"].contains("refused"), F.lit(False)).alias("says_why"),
    )


def _segments(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """What the customers of a nation spent by market segment, and the segment's place in it."""
    spent = (
        orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
        .groupBy("c_nationkey", "c_mktsegment")
        .agg(
            F.sum("o_totalprice").alias("spent"),
            F.max("o_orderdate").alias("last_order"),
            F.max(F.when(F.col("c_acctbal") < 0, F.col("c_name"))).alias("in_debt"),
        )
    )
    named = spent.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    place = F.rank().over(Window.partitionBy("n_name").orderBy(F.desc("spent")))
    return named.select("n_name", F.col("c_mktsegment").alias("segment"), "last_order", "in_debt", place.alias("place"))


def plan_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of two jobs, mapped by their plans, and how many rows have a value on both sides."""
    read = {name: table(spark, sf_dir, name) for name in ("lineitem", "orders", "customer", "nation")}
    jobs = {
        "employees": transforms.transform_employees(employees(spark, sf_dir), RUN_DATE),
        "segments": _segments(read["orders"], read["customer"], read["nation"]),
    }
    pairs = [plan_mapping.plan_mapping(job, target, read) for target, job in jobs.items()]
    return plan_mapping.mapping_fill(pairs[0].union(pairs[1]), {**read, **jobs})


QUERIES = {
    "plan_lineage": plan_lineage,
    "stream_upsert": stream_upsert,
    "verify_catalog": verify_catalog,
    "search_grams": search_grams,
    "deep_pages": deep_pages,
    "load_statistics": load_statistics,
    "schema_intervals": schema_intervals,
    "schema_as_of": schema_as_of,
    "schema_changes": schema_changes,
    "load_integrity": load_integrity,
    "run_processes": run_processes,
}


# ---- the same in SQL -------------------------------------------------------------------

_MAPPED = [
    ("lineitem", "l_orderkey", "employees", "id", "SIMPLE"),
    ("lineitem", "l_linenumber", "employees", "line", "SIMPLE"),
    ("lineitem", "l_quantity", "employees", "age", "EXPRESSION"),
    ("lineitem", "l_extendedprice", "employees", "salary", "EXPRESSION"),
    ("lineitem", "l_returnflag", "employees", "department", "SIMPLE"),
    ("lineitem", "l_quantity", "employees", "employee_category", "EXPRESSION"),
    ("lineitem", "l_extendedprice", "employees", "salary_band", "EXPRESSION"),
    ("nation", "n_name", "segments", "n_name", "SIMPLE"),
    ("customer", "c_mktsegment", "segments", "segment", "SIMPLE"),
    ("orders", "o_orderdate", "segments", "last_order", "EXPRESSION"),
    ("customer", "c_acctbal", "segments", "in_debt", "EXPRESSION"),
    ("customer", "c_name", "segments", "in_debt", "EXPRESSION"),
    ("nation", "n_name", "segments", "place", "EXPRESSION"),
    ("orders", "o_totalprice", "segments", "place", "EXPRESSION"),
]

def _arrivals(source: str, type_name: str, key: str, owner: str, at: str, status: str) -> str:
    name = f"'{type_name}_' || {key}"
    return f"""SELECT sha256('{type_name}|bench.' || {name} || '@primary') AS guid,
  '{type_name}' AS type_name, 'bench.' || {name} || '@primary' AS qualified_name, {name} AS name,
  {owner} AS owner, {at} AS create_time, CASE WHEN {status} = 'F' THEN 1 ELSE 2 END AS run FROM {source}"""


_RUNS = """snaps AS (
  SELECT l_linenumber AS run, 'supply:' || l_suppkey AS table_name, 'part:' || (l_partkey % 50) AS name,
    MIN(l_returnflag) AS data_type FROM lineitem GROUP BY ALL),
runs AS (
  SELECT run, row_number() OVER (ORDER BY run) AS n, lead(run) OVER (ORDER BY run) AS after
  FROM (SELECT DISTINCT l_linenumber AS run FROM lineitem)),
marked AS (
  SELECT s.*, n, after,
    n - row_number() OVER (PARTITION BY table_name, name, data_type ORDER BY n) AS island
  FROM snaps s JOIN runs USING (run)),
intervals AS (
  SELECT table_name, name, data_type, MIN(run) AS from_run, arg_max(coalesce(after, -1), n) AS last
  FROM marked GROUP BY table_name, name, data_type, island),
valid AS (SELECT table_name, name, data_type, from_run, nullif(last, -1) AS to_run FROM intervals)"""

ORACLES = {
    "plan_lineage": f"""WITH {EMP_SQL}, employees AS ({TRANSFORM_SQL}), spent AS (
  SELECT c_nationkey, c_mktsegment AS segment, SUM(o_totalprice) AS spent, MAX(o_orderdate) AS last_order,
    MAX(CASE WHEN c_acctbal < 0 THEN c_name END) AS in_debt
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL), segments AS (
  SELECT n_name, segment, last_order, in_debt, RANK() OVER (PARTITION BY n_name ORDER BY spent DESC) AS place
  FROM spent JOIN nation ON c_nationkey = n_nationkey)
"""
    + "\nUNION ALL ".join(
        f"SELECT '{s}' AS src_table, '{c}' AS src_column, '{t}' AS dst_table, '{d}' AS dst_column, "
        f"'{how}' AS dependency, (SELECT COUNT({c}) FROM {s}) AS src_filled, (SELECT COUNT({d}) FROM {t}) AS dst_filled"
        for s, c, t, d, how in _MAPPED
    ),
    "stream_upsert": f"""WITH arrived AS (
{_arrivals("customer", "customer", "c_custkey", "c_mktsegment", "TIMESTAMP '1990-01-01 00:00:00'", "''")
    .replace("CASE WHEN '' = 'F' THEN 1 ELSE 2 END", "0")}
UNION ALL {_arrivals("orders", "customer", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderstatus")}
UNION ALL {_arrivals("lineitem", "order", "l_orderkey", "l_returnflag", "l_shipdate", "l_linestatus")})
SELECT guid, type_name, qualified_name, name, owner, create_time FROM arrived
QUALIFY ROW_NUMBER() OVER (PARTITION BY guid ORDER BY run, create_time, owner) = 1""",
    "verify_catalog": f"""WITH {EDGES_SQL}, live AS (
  SELECT 'customer:' || c_custkey AS guid FROM customer WHERE c_nationkey = 3 OR c_acctbal >= -900)
SELECT DISTINCT 'missing' AS fault, 'customer' AS type_name, 'customer:' || o_custkey || '@primary' AS named
FROM orders WHERE 'customer:' || o_custkey NOT IN (SELECT guid FROM live)
UNION ALL
SELECT 'no_lineage', 'customer', guid || '@primary' FROM live
WHERE guid NOT IN (SELECT src_guid FROM edges UNION SELECT dst_guid FROM edges)""",
    "search_grams": f"""WITH {CATALOG_SQL}
SELECT 'ring' AS text, guid, name, description FROM catalog WHERE type_name = 'part' AND contains(name, 'ring')
UNION ALL SELECT 'FURN', guid, name, description FROM catalog WHERE type_name = 'customer'
  AND (contains(name, 'FURN') OR contains(qualified_name, 'FURN') OR contains(description, 'FURN'))
UNION ALL SELECT 'ON_1', guid, name, description FROM catalog WHERE type_name = 'nation' AND contains(name, 'ON_1')
UNION ALL SELECT 'r#', guid, name, description FROM catalog WHERE type_name = 'supply' AND contains(name, 'r#')""",
    "deep_pages": f"""WITH {CATALOG_SQL}, placed AS (
  SELECT guid, type_name, qualified_name, name, COUNT(*) OVER () AS n,
    row_number() OVER (ORDER BY qualified_name, guid) - 1 AS spot FROM catalog)
SELECT 'middle' AS page, guid, type_name, qualified_name, name FROM placed
WHERE spot >= n // 2 AND spot < n // 2 + {PAGE_ROWS}
UNION ALL SELECT 'end', guid, type_name, qualified_name, name FROM placed WHERE spot >= n - 10
UNION ALL SELECT 'next', guid, type_name, qualified_name, name FROM placed
WHERE spot >= n // 2 + {PAGE_ROWS} AND spot < n // 2 + {2 * PAGE_ROWS}""",
    "load_statistics": "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(DISTINCT o_orderstatus) AS n_loads, COUNT(*) AS n_rows,
  COUNT(*) - COUNT({c}) AS n_nulls, {f"MIN({c})::DOUBLE" if number else "NULL::DOUBLE"} AS least,
  {f"MAX({c})::DOUBLE" if number else "NULL::DOUBLE"} AS greatest, TRUE AS distinct_near,
  {"TRUE" if number else "NULL::BOOLEAN"} AS median_near FROM orders"""
        for c, number in zip(STATS, (True, True, True, False, False))
    ),
    "schema_intervals": f"WITH {_RUNS} SELECT * FROM valid",
    "schema_as_of": f"WITH {_RUNS} SELECT table_name, name, data_type, run FROM snaps",
    "schema_changes": f"""WITH {_RUNS},
pairs AS (
  SELECT r.run, r.n, k.table_name, k.name, s.data_type AS new_type, o.data_type AS old_type
  FROM runs r CROSS JOIN (SELECT DISTINCT table_name, name FROM snaps) k
  LEFT JOIN snaps s ON s.run = r.run AND s.table_name = k.table_name AND s.name = k.name
  LEFT JOIN runs b ON b.n = r.n - 1
  LEFT JOIN snaps o ON o.run = b.run AND o.table_name = k.table_name AND o.name = k.name)
SELECT table_name, name, run, old_type, new_type,
  CASE WHEN old_type IS NULL THEN 'added' WHEN new_type IS NULL THEN 'removed' ELSE 'retyped' END AS change
FROM pairs WHERE n > 1 AND old_type IS DISTINCT FROM new_type""",
    "load_integrity": """WITH l AS (
  SELECT o_orderkey, o_orderkey % 997 <> 3 AS there, o_orderkey % 1009 = 5 AND o_orderstatus <> 'X' AS other,
    o_orderkey % 1013 = 7 AS twice FROM orders)
SELECT o_orderkey, CASE WHEN NOT there THEN 'missing' WHEN other THEN 'changed' ELSE 'repeated' END AS kind,
  1::BIGINT AS n_source, CASE WHEN NOT there THEN 0 WHEN twice THEN 2 ELSE 1 END::BIGINT AS n_target
FROM l WHERE NOT there OR other OR twice
UNION ALL SELECT -o_orderkey - 1, 'added', 0, 1 FROM orders WHERE o_orderkey % 1019 = 11""",
    "run_processes": """WITH o AS (SELECT COUNT(*)::VARCHAR AS n FROM orders),
s AS (SELECT v.status, COUNT(o_orderkey)::VARCHAR AS n FROM (VALUES ('O'), ('F'), ('P')) v(status)
  LEFT JOIN orders ON o_orderstatus = v.status GROUP BY v.status)
SELECT 'etl_process' AS type_name, 'orders_' || s.status AS name,
  'ETL process transforming data: orders_' || s.status AS description, 'FILTER' AS operation, o.n AS rows_in,
  s.n AS rows_out, 'SUCCEEDED' AS status, TRUE AS has_user, TRUE AS in_order, FALSE AS says_why FROM s, o
UNION ALL SELECT 'etl_process', 'orders_strict', 'Refuses all orders', 'CHECK', NULL, NULL, 'FAILED', TRUE, TRUE, TRUE""",
}
