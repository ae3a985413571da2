"""Entities, types, tags, search, validation and audit on small catalogs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablewarden.functions import documents as docs
from tablewarden.functions import naming, times
from tablewarden.operators import audit, entities, relationships, tagging, typedefs, validation
from tablewarden.operators.model import CLASSIFICATIONS, EDGES, ENTITIES, ENTITY_COLUMNS
from tablewarden.operators.search import search

T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def batch(spark, *items):
    """Entities from (type, qualified name, name, owner, description, created)."""
    df = spark.createDataFrame(
        list(items), "t STRING, q STRING, n STRING, o STRING, d STRING, c TIMESTAMP_NTZ"
    )
    return entities.entity_rows(df, "t", "q", "n", "o", "d", "c")


# ---- names, times, documents -----------------------------------------------------------


def test_names(spark):
    df = spark.createDataFrame([("db", "t", "c", "/a/b/f.csv")], "d STRING, t STRING, c STRING, p STRING")
    row = df.select(
        naming.database_name("d"),
        naming.table_name("d", "t"),
        naming.column_name("d", "t", "c", "west"),
        naming.base_name("p"),
        naming.dataset_name("p"),
        naming.process_name("t", F.lit(17)),
    ).first()
    assert tuple(row) == (
        "db@primary",
        "db.t@primary",
        "db.t.c@west",
        "f.csv",
        "/a/b/f.csv@primary",
        "t_17@primary",
    )


def test_guid_depends_on_type_and_name_only(spark):
    first = batch(spark, ("a", "x", "n", "o", "d", T0)).first()
    again = batch(spark, ("a", "x", "m", None, None, T1)).first()
    other = batch(spark, ("b", "x", "n", "o", "d", T0)).first()
    assert first.guid == again.guid != other.guid and len(first.guid) == 64


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epochs_ignore_the_session_zone(spark, zone):
    kept = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(1_700_000_000_123,)], "ms BIGINT")
        row = df.select(
            times.from_epoch_millis("ms").cast("string").alias("a"),
            times.from_epoch_seconds(F.expr("ms div 1000")).cast("string").alias("b"),
            times.to_epoch_millis(times.from_epoch_millis("ms")).alias("back"),
            times.run_stamp(times.from_epoch_millis("ms")).alias("stamp"),
            times.time_literal(T0).cast("string").alias("literal"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)
    assert (row.a, row.b) == ("2023-11-14 22:13:20.123", "2023-11-14 22:13:20")
    assert row.literal == "2024-01-01 00:00:00"
    assert (row.back, row.stamp) == (1_700_000_000_123, "20231114221320")


def test_default_description(spark):
    df = spark.createDataFrame([("x", None), ("x", ""), ("x", "given")], "n STRING, d STRING")
    got = [r[0] for r in df.select(docs.default_description("d", "n", "table")).collect()]
    assert got == ["Table created by ETL process: x"] * 2 + ["given"]


def test_documents_round_trip(spark):
    df = spark.createDataFrame(
        [("t", {"a": "1"}, ["y", "x", "y"])], "t STRING, a MAP<STRING,STRING>, c ARRAY<STRING>"
    )
    text = df.select(docs.encode_document("t", "a", "c").alias("j"))
    assert text.first().j == '{"typeName":"t","attributes":{"a":"1"},"classifications":["y","x","y"]}'
    back = text.select(docs.decode_document("j").alias("e")).select(
        "e.typeName", "e.attributes", docs.tag_set("e.classifications")
    )
    assert tuple(back.first()) == ("t", {"a": "1"}, ["x", "y"])


def test_column_mapping(spark):
    df = spark.createDataFrame([([("a", "b")],)], "m ARRAY<STRUCT<s: STRING, t: STRING>>")
    assert df.select(docs.column_mapping("m")).first()[0] == {"a": "b"}


# ---- merging ---------------------------------------------------------------------------


def test_upsert_keeps_the_first_writer(spark):
    old = batch(spark, ("t", "a", "old", "o", None, T1))
    new = batch(
        spark,
        ("t", "a", "late", "o", None, T0),
        ("t", "b", "second", "o", None, T1),
        ("t", "b", "first", None, None, T0),
        ("u", "a", "other type", "o", None, T1),
    )
    merged = entities.upsert_entities(old, new)
    assert merged.columns == ENTITY_COLUMNS
    assert rows(merged, "type_name", "qualified_name", "name") == [
        ("t", "a", "old"),
        ("t", "b", "first"),
        ("u", "a", "other type"),
    ]


def test_upsert_twice_is_upsert_once(spark):
    old = batch(spark, ("t", "a", "x", "o", None, T0))
    new = batch(spark, ("t", "b", "y", "o", None, T0), ("t", "b", "z", "o", None, T0))
    once = entities.upsert_entities(old, new)
    twice = entities.upsert_entities(once, new)
    assert rows(once, *ENTITY_COLUMNS) == rows(twice, *ENTITY_COLUMNS)


def test_upsert_of_a_hot_key(spark):
    hot = spark.range(9000).select(
        F.lit("t").alias("type_name"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("q"),
        F.col("id").cast("string").alias("n"),
    )
    new = entities.entity_rows(hot, "type_name", "q", "n")
    merged = entities.upsert_entities(spark.createDataFrame([], ENTITIES), new)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert merged.count() == 6001
    assert merged.filter("qualified_name = 'hot'").first().name == "0"


def test_bulk_batch_fills_missing_columns(spark):
    a = spark.createDataFrame([("x", 1)], "n STRING, size INT")
    b = spark.createDataFrame([("y", "t")], "n STRING, kind STRING")
    assert rows(entities.bulk_batch(a, b), "n", "size", "kind") == [
        ("x", 1, None),
        ("y", None, "t"),
    ]


def test_missing_entities_ignore_deleted(spark):
    have = batch(spark, ("t", "a", "x", "o", None, T0), ("t", "b", "y", "o", None, T0))
    have = have.withColumn("status", F.when(F.col("name") == "y", "DELETED").otherwise("ACTIVE"))
    expected = spark.createDataFrame(
        [("t", "x"), ("t", "y"), ("u", "x"), ("u", "x")], "type_name STRING, name STRING"
    )
    assert rows(entities.missing_entities(have, expected), "type_name", "name") == [
        ("t", "y"),
        ("u", "x"),
    ]


def test_references_by_guid_and_by_name(spark):
    parents = batch(
        spark,
        ("db", "one@primary", "one", "o", None, T0),
        ("db", "two@primary", "two", "o", None, T0),
        ("other", "one@primary", "wrong", "o", None, T0),
    )
    two = parents.filter("name = 'two'").first().guid
    child = spark.createDataFrame(
        [("a", None, "one@primary"), ("b", two, None), ("c", None, "no@primary"), ("d", None, None)],
        "n STRING, ref_guid STRING, ref_qualified_name STRING",
    )
    got = entities.resolve_refs(child, parents, "db")
    assert rows(got, "n", "parent_name") == [("a", "one"), ("b", "two"), ("c", None), ("d", None)]


def test_same_name_in_two_databases(spark):
    names = [f"{db}.t@primary" for db in ("one", "two")]
    both = batch(spark, *[("table", q, "t", "o", None, T0) for q in names])
    assert entities.first_by_key(both).count() == 2


# ---- harvesting ------------------------------------------------------------------------


def test_harvest_schema(spark):
    df = spark.createDataFrame([], "id INT COMMENT 'key', name STRING")
    got = entities.harvest_schema(df, "db", "t", create_time=T0)
    assert rows(got, "type_name", "qualified_name", "description") == [
        ("hive_column", "db.t.id@primary", "key"),
        ("hive_column", "db.t.name@primary", ""),
        ("hive_db", "db@primary", "Database for ETL processing: db"),
        ("hive_table", "db.t@primary", "Table created by ETL process: t"),
    ]
    column = got.filter("name = 'id'").first()
    assert column.attributes == {"type": "int", "position": "0", "table": "db.t@primary"}


def test_dataset_entities(spark):
    df = spark.createDataFrame([("/x/employees.csv",), ("/y/employees.csv",)], "p STRING")
    got = entities.dataset_entities(df, "p", "CSV")
    assert rows(got, "qualified_name", "name", "description") == [
        ("/x/employees.csv@primary", "employees.csv", "Employee data file in CSV format"),
        ("/y/employees.csv@primary", "employees.csv", "Employee data file in CSV format"),
    ]


def test_processes_are_new_each_run(spark):
    runs = spark.createDataFrame(
        [("load", "text", T0), ("load", None, T1)],
        "name STRING, description STRING, run_ts TIMESTAMP_NTZ",
    )
    got = entities.process_entities(runs)
    assert rows(got, "qualified_name", "description") == [
        ("load_20240101000000@primary", "text"),
        ("load_20240102000000@primary", "ETL process transforming data: load"),
    ]
    marked = entities.process_entities(runs, epoch_mark=True)
    assert "load_1704067200@primary" in {r.qualified_name for r in marked.collect()}


def test_process_io(spark):
    runs = spark.createDataFrame(
        [("p", ["a", "b"], ["c"]), ("q", [], ["d"])],
        "guid STRING, inputs ARRAY<STRING>, outputs ARRAY<STRING>",
    )
    assert rows(entities.process_io(runs), "process_guid", "direction", "dataset_guid") == [
        ("p", "input", "a"),
        ("p", "input", "b"),
        ("p", "output", "c"),
        ("q", "output", "d"),
    ]


# ---- types and validation --------------------------------------------------------------


def test_type_definitions(spark):
    defs = typedefs.default_types(spark)
    count = {c: typedefs.list_types(defs, c).count() for c in ("ENTITY", "CLASSIFICATION")}
    assert count == {"ENTITY": 5, "CLASSIFICATION": 7}
    assert typedefs.list_types(defs, "BUSINESS_METADATA").count() == 3
    assert typedefs.list_types(defs).count() == 15
    assert typedefs.default_relationships(spark).count() == 3
    key = defs.filter("type_name = 'DataPipeline' AND attr_name = 'pipelineId'").first()
    assert (key.is_optional, key.is_unique, key.min_count) == (False, True, 1)


def entity(guid, type_name, **attributes):
    return (guid, type_name, guid, guid, None, None, "ACTIVE", T0, attributes)


def violations(spark, items, defs):
    found = validation.validate_entities(
        spark.createDataFrame(items, ENTITIES), typedefs.register_types(spark, defs)
    )
    return rows(found, "guid", "attribute", "kind", "value", "n")


def test_parents_undeclared_and_all_broken_rules(spark):
    def_of = typedefs.TypeDef
    defs = [
        def_of("base", "ENTITY", ("Asset",), (typedefs.Attr("owner_id", required=True), typedefs.Attr("size", "int"))),
        def_of("middle", "ENTITY", ("base",)),
        def_of("leaf", "ENTITY", ("middle",), (
            typedefs.Attr("size", "long"),
            typedefs.Attr("tags", "array<string>", max_count=2, enum=("a", "b")),
        )),
    ]
    items = [
        entity("1", "leaf", owner_id="x", size="99999999999", tags='["a"]'),
        entity("2", "leaf", tags='["a", "b", "c"]', colour="red"),
        entity("3", "middle", owner_id="y", size="99999999999"),
    ]
    assert violations(spark, items, defs) == [
        ("2", "colour", "undeclared_attribute", "red", 1),
        ("2", "owner_id", "missing_required", None, 1),
        ("2", "tags", "cardinality", '["a", "b", "c"]', 1),
        ("2", "tags", "not_in_enum", '["a", "b", "c"]', 1),
        ("3", "size", "wrong_type", "99999999999", 1),
    ]
    circle = [def_of("p", "ENTITY", ("q",)), def_of("q", "ENTITY", ("p",))]
    with pytest.raises(validation.TypeCycleError):
        violations(spark, items, circle)


def test_partition_of_a_hot_type_is_split(spark, skew_settings):
    rows_of = spark.range(20_000).selectExpr(
        "CAST(id AS STRING) AS guid", "IF(id % 40 = 0, 'other', 'hot') AS type_name",
        "map('size', CAST(id AS STRING), 'text', repeat('x', 50)) AS attributes",
    )
    defs = [typedefs.TypeDef(t, "ENTITY", (), (typedefs.Attr("size", "int"),)) for t in ("hot", "other")]
    found = validation.validate_entities(rows_of, typedefs.register_types(spark, defs))
    assert {r.kind: r["count"] for r in found.groupBy("kind").count().collect()} == {"undeclared_attribute": 20_000}
    done = found.filter("guid IS NOT NULL")
    done.collect()
    assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()


def test_expected_entities_by_qualified_name(spark, catalog):
    key = catalog.filter("type_name = 'table'").select("type_name", "qualified_name").limit(1)
    assert entities.missing_entities(catalog, key).count() == 0
    other = key.select("type_name", F.concat(F.lit("other."), "qualified_name").alias("qualified_name"))
    assert entities.missing_entities(catalog, other).count() == 1


def test_search_keeps_entities_without_a_status(spark):
    items = [(g, "t", g, g, None, None, s, T0, {}) for g, s in (("1", None), ("2", "DELETED"), ("3", "ACTIVE"))]
    found = search(spark.createDataFrame(items, ENTITIES), type_name="t")
    assert rows(found, "guid") == [("1",), ("3",)]


def test_kpi_without_its_required_name(spark):
    kpi = entity("k", "BusinessKPI", kpiId="1", formula="f", targetValue="80000.0", lastUpdated="5")
    assert violations(spark, [kpi], typedefs.ENTITY_TYPES) == [
        ("k", "kpiName", "missing_required", None, 1)
    ]


def test_undefined_tag(spark):
    tagged = [entity("s", "ETL_Source"), entity("p", "PII")]
    assert violations(spark, tagged, typedefs.TAG_TYPES) == [("s", None, "unknown_type", None, 1)]


def test_enum_type_cardinality_and_unique(spark):
    defs = [
        typedefs.TypeDef(
            "thing",
            typedefs.ENTITY,
            (),
            (
                typedefs.Attr("level", required=True, enum=("low", "high")),
                typedefs.Attr("ratio", "float"),
                typedefs.Attr("day", "date"),
                typedefs.Attr("laws", "array<string>", cardinality="SET", max_count=2, enum=("A", "B", "C")),
                typedefs.Attr("key", unique=True),
            ),
        )
    ]
    items = [
        entity("ok", "thing", level="low", ratio="0.5", day="2024-01-31", laws='["A"]', key="1"),
        entity("enum", "thing", level="mid", laws='["A","Z"]', key="2"),
        entity("type", "thing", level="low", ratio="x", day="soon", laws="none", key="2"),
        entity("many", "thing", level="high", laws='["A","B","C"]', key="2"),
        entity("gone", "thing"),
    ]
    assert violations(spark, items, defs) == [
        ("enum", "laws", "not_in_enum", '["A","Z"]', 1),
        ("enum", "level", "not_in_enum", "mid", 1),
        ("gone", "level", "missing_required", None, 1),
        ("many", "laws", "cardinality", '["A","B","C"]', 1),
        ("type", "day", "wrong_type", "soon", 1),
        ("type", "laws", "wrong_type", "none", 1),
        ("type", "ratio", "wrong_type", "x", 1),
        (None, "key", "duplicate_unique", "2", 3),
    ]


def test_cardinality_of_ends(spark):
    df = spark.createDataFrame(
        [("c1", "d1"), ("c1", "d2"), ("c1", "d2"), ("c2", "d1")], "a STRING, b STRING"
    )
    links = relationships.link(df, "DataQualityAssessment", "a", "b").unionByName(
        relationships.link(df, "KPIDependency", "a", "b")
    )
    found = validation.cardinality_violations(links, typedefs.default_relationships(spark))
    assert rows(found, "rel_type", "rel_end", "guid", "n_partners") == [
        ("DataQualityAssessment", "end1", "c1", 2)
    ]


# ---- tags ------------------------------------------------------------------------------


def test_tagging_twice_changes_nothing(spark):
    have = batch(spark, ("t", "a", "x", "o", None, T0), ("t", "b", "y", "o", None, T0))
    first = tagging.apply_classification(have, F.col("name") == "x", "PII", {"why": "name"})
    assert rows(first, "classification", "attributes", "propagated") == [
        ("PII", {"why": "name"}, False)
    ]
    again = tagging.apply_classification(have, F.lit(True), "PII", None, first)
    assert [r.guid for r in again.collect()] == [have.filter("name = 'y'").first().guid]


def test_pii_by_name_and_type(spark):
    cols = spark.createDataFrame(
        [("1", "Name", "string"), ("2", "age", "int"), ("3", "age", "string"), ("4", "id", "int")],
        "guid STRING, name STRING, data_type STRING",
    )
    got = tagging.tag_pii(cols, [("name", None), ("AGE", "int")])
    assert rows(got, "guid", "classification") == [("1", "PII"), ("2", "PII")]


def test_tag_sets(spark):
    tags = spark.createDataFrame(
        [("a", "y", None, False), ("a", "x", None, False), ("a", "y", None, True)], CLASSIFICATIONS
    )
    assert rows(tagging.tag_sets(tags), "guid", "tags") == [("a", ["x", "y"])]


def test_last_business_metadata_wins(spark):
    ddl = "guid STRING, bm_name STRING, attributes MAP<STRING,STRING>, written_at TIMESTAMP_NTZ, seq BIGINT"
    old = spark.createDataFrame(
        [("a", "g", {"v": "1"}, T0, 1), ("a", "h", {"v": "2"}, T1, 1)], ddl
    )
    new = spark.createDataFrame(
        [("a", "g", {"v": "3"}, T1, 2), ("a", "g", {"v": "4"}, T1, 3), ("a", "h", {"v": "0"}, T0, 9)],
        ddl,
    )
    got = tagging.apply_business_metadata(old, new)
    assert rows(got, "guid", "bm_name", "attributes") == [("a", "g", {"v": "4"}), ("a", "h", {"v": "2"})]


# ---- search ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def catalog(spark):
    items = [
        ("1", "table", "db.orders@p", "orders", "ann", "all orders", "ACTIVE", T0, {"fmt": "csv"}),
        ("2", "table", "db.Orders_old@p", "Orders_old", "bob", None, "DELETED", T0, {"fmt": "csv"}),
        ("3", "table", "db.parts@p", "parts", "ann", "of orders", "ACTIVE", T0, {}),
        ("4", "file", "x/orders.csv@p", "orders.csv", None, None, "ACTIVE", T0, {"fmt": "csv"}),
    ]
    return spark.createDataFrame(items, ENTITIES)


@pytest.fixture(scope="module")
def tags(spark):
    return spark.createDataFrame(
        [("1", "PII", None, False), ("1", "PII", None, True), ("4", "PII", None, False)],
        CLASSIFICATIONS,
    )


@pytest.mark.parametrize(
    "criteria, guids",
    [
        ({}, "134"),
        ({"include_deleted": True}, "1234"),
        ({"type_name": "table"}, "13"),
        ({"attributes": {"owner": "ann", "fmt": "csv"}}, "1"),
        ({"name_contains": "orders"}, "14"),
        ({"name_contains": "Orders", "include_deleted": True}, "2"),
        ({"type_name": "table", "text": "orders"}, "13"),
        ({"tag": "PII"}, "14"),
        ({"tag": "PII", "type_name": "file"}, "4"),
        ({"tag": "Public"}, ""),
        ({"limit": 2}, "13"),
        ({"limit": 2, "offset": 1}, "34"),
        ({"limit": 2, "offset": 5}, ""),
    ],
)
def test_search(catalog, tags, criteria, guids):
    found = search(catalog, tags, **criteria)
    assert sorted(r.guid for r in found.collect()) == list(guids)
    assert found.columns == ENTITY_COLUMNS


# ---- audit -----------------------------------------------------------------------------


def test_summary_and_audit(spark, catalog, tags):
    edges = spark.createDataFrame([("1", "p"), ("p", "3")], EDGES)
    assert rows(audit.catalog_summary(catalog, tags), "kind", "name", "n_entities") == [
        ("classification", "PII", 2),
        ("type", "file", 1),
        ("type", "table", 3),
    ]
    got = {r.type_name: r for r in audit.metadata_audit(catalog, tags, edges).collect()}
    assert tuple(got["file"])[1:] == (1, 0.0, 0.0, 1.0, 0.0)
    assert [round(v, 3) for v in tuple(got["table"])[1:]] == [3, 0.667, 1.0, 0.333, 0.667]


def test_verify_catalog(spark, catalog):
    edges = spark.createDataFrame([("1", "p"), ("p", "3")], EDGES)
    ddl = "type_name STRING, name STRING"
    expected = spark.createDataFrame([("table", "orders"), ("table", "parts")], ddl)
    audit.verify_catalog(catalog, edges, expected, ["orders"])
    with pytest.raises(audit.CatalogVerificationError, match="table:Orders_old"):
        gone = spark.createDataFrame([("table", "Orders_old")], ddl)
        audit.verify_catalog(catalog, edges, gone, [])
    with pytest.raises(audit.CatalogVerificationError, match="orders.csv"):
        audit.verify_catalog(catalog, edges, expected, ["orders", "orders.csv"])
