"""Traversal, impact, propagation and export on small graphs, against brute force."""

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablewarden.materialize import materialize
from tablewarden.operators import columns, lineage as lin
from tablewarden.operators.entities import entity_rows, resolve_refs
from tablewarden.operators.model import CLASSIFICATIONS, EDGES, ENTITIES, PROCESS_IO
from tablewarden.operators.retag import affected_nodes, retag, spread_tags, tags_of
from tablewarden.plans import views
from tablewarden.plans.registry import QUERIES


def edges_of(spark, text):
    return spark.createDataFrame([tuple(p) for p in text.split()], EDGES)


def roots_of(spark, names):
    return spark.createDataFrame([(n,) for n in names], "guid STRING")


def hops(df):
    return {(r.root, r.guid, r.direction): r.hop for r in df.collect()}


def brute(pairs, names, depth, forward):
    """Least hops from each root by plain breadth-first search."""
    result = {}
    for root in names:
        level, seen, hop = {root}, {root: 0}, 0
        while level and (depth is None or hop < depth):
            hop += 1
            level = {
                (b if forward else a) for a, b in pairs if (a if forward else b) in level
            } - set(seen)
            seen.update(dict.fromkeys(level, hop))
        for guid, hop in seen.items():
            result[(root, guid, "OUTPUT" if forward else "INPUT")] = hop
    return result


def test_edges_from_process_io(spark):
    io = spark.createDataFrame(
        [("p", "input", "a"), ("p", "output", "b"), ("p", "input", "a")], PROCESS_IO
    )
    got = {tuple(r) for r in lin.build_edges(io).collect()}
    assert got == {("a", "p"), ("p", "b")} and lin.build_edges(io).count() == 2


GRAPHS = {
    "cycle with an exit": "ab bc ca cd",
    "diamond": "ab ac bd cd de",
    "self loop": "aa ab",
    "two parts": "ab cd",
    "shortcut": "ab bc cd ad",
}


@pytest.mark.parametrize("text", GRAPHS.values(), ids=GRAPHS.keys())
@pytest.mark.parametrize("depth", [0, 1, 2, None])
def test_walks(spark, text, depth):
    names = ["a", "d", "z"]
    pairs = [tuple(p) for p in text.split()]
    got = hops(lin.lineage(edges_of(spark, text), roots_of(spark, names), depth))
    want = brute(pairs, names, depth, True) | brute(pairs, names, depth, False)
    assert got == want


def test_random_graph(spark):
    rnd = random.Random(7)
    pairs = sorted({(f"n{rnd.randrange(40)}", f"n{rnd.randrange(40)}") for _ in range(90)})
    edges = spark.createDataFrame(pairs, EDGES)
    names = ["n0", "n5", "n9"]
    down = hops(lin.lineage(edges, roots_of(spark, names), 3, "OUTPUT"))
    assert down == brute(pairs, names, 3, True)


@pytest.mark.parametrize("text", GRAPHS.values(), ids=GRAPHS.keys())
def test_walks_over_buckets(spark, tmp_path, text):
    names = ["a", "d", "z"]
    pairs = [tuple(p) for p in text.split()]
    table = lin.write_edges(edges_of(spark, text), str(tmp_path / "e"), 4)
    got = hops(lin.lineage(table, roots_of(spark, names), None))
    assert got == brute(pairs, names, None, True) | brute(pairs, names, None, False)


def test_a_hop_reads_only_the_buckets_of_its_nodes(spark, tmp_path):
    table = lin.write_edges(hub_edges(spark), str(tmp_path / "e"), 50)
    start = lin._written(roots_of(spark, ["n1"]), table, "f")
    joined = lin._edges_of(table, start, True)
    assert joined.count() == 1
    bucket = spark.sql(f"SELECT {lin._bucket(repr('n1'), 50)}").first()[0]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    filters = " ".join(re.findall(r"PartitionFilters: \[[^]]*\]", plan))
    assert re.search(rf"bucket#\d+ = {bucket}\)", filters)


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_readers_need_no_bucket_count(spark, tmp_path, buckets):
    path = str(tmp_path / "e")
    lin.write_edges(edges_of(spark, "xy"), path, 7)
    lin.write_edges(edges_of(spark, "ab bc cd de"), path, buckets)
    got = hops(lin.lineage(lin.read_edges(spark, path), roots_of(spark, ["a"]), None, "OUTPUT"))
    assert {row[1] for row in got} == set("abcde")


def test_one_sided_table_refuses_the_other_walk(spark, tmp_path):
    table = lin.write_edges(edges_of(spark, "ab"), str(tmp_path / "e"), 2, "OUTPUT")
    assert lin.lineage(table, roots_of(spark, ["a"]), 1, "OUTPUT").count() == 2
    with pytest.raises(ValueError):
        lin.lineage(table, roots_of(spark, ["a"]), 1, "INPUT")


def deep_pairs(seed):
    """Long chains with branches, short cuts, rings, loops and repeated edges."""
    import random

    rng = random.Random(seed)
    pairs, end = [], 0
    for _ in range(6):
        start, end = end, end + rng.randint(20, 45)
        pairs += [(n, n + 1) for n in range(start, end)]
    pairs += [(rng.randint(0, end), rng.randint(0, end)) for _ in range(rng.choice([0, 2, 5]))]
    pairs += [(1000 + n, 1000 + (n + 1) % 30) for n in range(30)] + [(7, 7), (40, 40), (3, 4)]
    pairs += [(2000 + n, 2000 + (n + 1) % 30) for n in range(30)] + [(end, 2000)]
    return [(f"n{a}", f"n{b}") for a, b in pairs]


@pytest.mark.parametrize("seed, depth", [(0, None), (1, None), (2, 50)])
def test_deep_walks(spark, seed, depth):
    pairs = deep_pairs(seed)
    edges = spark.createDataFrame(pairs, EDGES)
    names = ["n0", "n60", "n1005"]
    for direction, forward in (("OUTPUT", True), ("INPUT", False)):
        found = lin.lineage(edges, roots_of(spark, names), depth, direction)
        assert hops(found) == brute(pairs, names, 10_000 if depth is None else depth, forward)


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    edges = spark.createDataFrame([(f"n{n}", f"n{n + 1}") for n in range(2000)], EDGES)
    rounds, write = [], lin.materialize

    def counted(df, label, *args, **kwargs):
        rounds.append(label)
        return write(df, label, *args, **kwargs)

    monkeypatch.setattr(lin, "materialize", counted)
    found = lin.lineage(edges, roots_of(spark, ["n0"]), None, "OUTPUT")
    assert found.count() == 2001 and found.agg(F.max("hop")).first()[0] == 2000
    assert found.filter("guid != concat('n', hop)").count() == 0
    # One write per single hop, one per doubling, a few for the contracted graph.
    assert rounds.count("pointers") <= 12 and len(rounds) <= lin.SINGLE_HOPS + 12 + 12


def test_tags_go_down_long_chains_from_the_nearest_source(spark):
    pairs = [(f"n{n}", f"n{n + 1}") for n in range(90)] + [("z", "n30"), ("a", "n30"), ("n20", "m0"), ("m0", "n60")]
    tags = spark.createDataFrame(
        [(g, "T", {"from": g}, False) for g in ("n0", "z", "a", "n85")], CLASSIFICATIONS
    )
    found = lin.propagate_tags(spark.createDataFrame(pairs, EDGES), tags)
    got = {r.guid: r.attributes["from"] for r in found.collect()}
    assert len(got) == 94
    # n60 is reached from n0 by the short cut in 22 hops, from n30's parents in 31.
    want = {"n0": "n0", "n29": "n0", "n30": "a", "n59": "a", "n60": "n0", "n84": "n0", "n85": "n85", "n90": "n85", "m0": "n0"}
    assert {k: got[k] for k in want} == want


def test_a_hop_reads_only_the_seen_nodes_of_its_buckets(spark, tmp_path, monkeypatch):
    pairs = [(f"n{n}", f"n{n + 1}") for n in range(12)] + [("n5", "n2"), ("n9", "n9")]
    edges = lin.write_edges(spark.createDataFrame(pairs, EDGES), str(tmp_path), 64)
    plans, unseen = [], lin._unseen

    def kept(*args):
        found = unseen(*args)
        plans.append(found._jdf.queryExecution().optimizedPlan().toString())
        return found

    monkeypatch.setattr(lin, "_unseen", kept)
    found = lin.lineage(edges, roots_of(spark, ["n0"]), None, "OUTPUT")
    assert hops(found) == brute(pairs, ["n0"], 99, True)
    assert len(plans) == 13
    # A hop of one or two nodes reads the seen nodes of one or two buckets of 64.
    for plan in plans[:-1]:
        assert "bucket#" in plan and (" IN (" not in plan or plan.split(" IN (")[1].split(")")[0].count(",") <= 1)


def test_down_and_up_mirror(spark):
    text = GRAPHS["diamond"]
    nodes = sorted(set(text) - {" "})
    everything = lin.lineage(edges_of(spark, text), roots_of(spark, nodes), None)
    down = {(r.root, r.guid) for r in everything.collect() if r.direction == "OUTPUT"}
    up = {(r.guid, r.root) for r in everything.collect() if r.direction == "INPUT"}
    assert down == up


def test_unknown_direction(spark):
    with pytest.raises(ValueError):
        lin.lineage(edges_of(spark, "ab"), roots_of(spark, "a"), 1, "SIDEWAYS")


def test_counts_and_presence(spark):
    edges = edges_of(spark, "ab ac bc")
    got = {r.guid: (r.n_inputs, r.n_outputs) for r in lin.lineage_counts(edges).collect()}
    assert got == {"a": (0, 2), "b": (1, 1), "c": (2, 0)}
    have = spark.createDataFrame([("a",), ("x",)], "guid STRING")
    asked = sorted(tuple(r) for r in lin.lineage_counts(edges, have).collect())
    assert asked == [("a", 0, 2), ("x", 0, 0)]
    assert [r.guid for r in lin.has_lineage(edges, have).collect()] == ["a"]


@pytest.fixture(scope="module")
def entities(spark):
    items = [(g, "table", g, f"name {g}", "o", None, "ACTIVE", None, {}) for g in "abcd"]
    return spark.createDataFrame(items, ENTITIES)


def tag_rows(spark, *pairs):
    return spark.createDataFrame([(g, t, {}, False) for g, t in pairs], CLASSIFICATIONS)


def test_impact(spark, entities):
    tags = tag_rows(
        spark, ("a", "PII"), ("c", "PII"), ("c", "Confidential"), ("c", "Public"), ("d", "PII")
    )
    found = lin.impact(edges_of(spark, "ab bc xd"), entities, tags, roots_of(spark, "a"))
    got = sorted((r.guid, r.name, r.classification, r.hop) for r in found.collect())
    assert got == [
        ("a", "name a", "PII", 0),
        ("c", "name c", "Confidential", 2),
        ("c", "name c", "PII", 2),
    ]


def test_propagation(spark):
    tags = tag_rows(spark, ("a", "PII"), ("b", "PII"), ("b", "Public"), ("z", "PII"))
    plain = ["guid", "classification", "propagated"]
    found = lin.propagate_tags(edges_of(spark, "ab bc ca"), tags)
    got = {tuple(r) for r in found.select(plain).collect()}
    assert got == {
        ("a", "PII", False),
        ("b", "PII", False),
        ("c", "PII", True),
        ("z", "PII", False),
        ("b", "Public", False),
        ("c", "Public", True),
        ("a", "Public", True),
    }
    only = lin.propagate_tags(edges_of(spark, "ab"), tags, ["Public"])
    assert {tuple(r) for r in only.select(plain).collect()} == {("b", "Public", False)}


def test_propagated_tags_keep_the_attributes_of_the_nearest_source(spark):
    carried = [("a", "1"), ("b", "2"), ("c", "3"), ("x", "9")]
    tags = spark.createDataFrame([(g, "T", {"level": v}, False) for g, v in carried], CLASSIFICATIONS)
    found = lin.propagate_tags(edges_of(spark, "ab bd cd de xy"), tags)
    assert found.columns == tags.columns
    got = {r.guid: (r.attributes["level"], r.propagated) for r in found.collect()}
    assert got["a"] == ("1", False) and got["b"] == ("2", False)
    assert got["d"] == ("2", True) and got["e"] == ("2", True) and got["y"] == ("9", True)


def test_export(spark, entities):
    edges = edges_of(spark, "ab bc cd de ef xa")
    nodes, links = lin.export_lineage(edges, entities, "a", 2)
    assert sorted((r.id, r.label) for r in nodes.collect()) == [
        ("a", "name a"),
        ("b", "name b"),
        ("c", "name c"),
        ("x", "Unknown"),
    ]
    assert sorted((r.source, r.target) for r in links.collect()) == [
        ("a", "b"),
        ("b", "c"),
        ("x", "a"),
    ]


N = 30_000


def hub_edges(spark):
    """A third of all edges leave one node."""
    source = F.when(F.col("id") % 3 == 0, "hub").otherwise(F.concat(F.lit("n"), "id"))
    return spark.range(0, N, 1, 8).select(
        source.alias("src_guid"), F.sha2(F.col("id").cast("string"), 256).alias("dst_guid")
    )


def test_hub_is_walked_whole(spark):
    found = lin.lineage(hub_edges(spark), roots_of(spark, ["hub", "n1"]), None, lin.OUTPUT)
    assert found.count() == 2 + N // 3 + 1


def test_hub_is_walked_whole_without_broadcasts(spark, skew_settings):
    everything = hub_edges(spark).select(F.col("src_guid").alias("guid")).distinct()
    found = lin.lineage(hub_edges(spark), everything, 1, lin.OUTPUT)
    assert found.filter("hop = 1").count() == N
    tags = everything.selectExpr("guid", "'T' AS classification", "map() AS attributes")
    reached = lin.propagate_tags(hub_edges(spark), tags)
    assert reached.filter("propagated").count() == N


def test_partition_of_a_hot_node_is_split(spark, skew_settings):
    """The join of a hop, with a frontier too large to broadcast.

    The frontier has to be a written table: behind an aggregate on the join key it would
    share a stage with the join, and adaptive execution could not split the partition.
    """
    steps = hub_edges(spark).selectExpr("src_guid AS guid", "dst_guid AS next_guid")
    frontier = materialize(steps.select("guid").distinct(), "frontier").frame
    joined = frontier.join(steps, "guid")
    assert len(joined.collect()) == N
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_children_of_a_hot_parent_are_split(spark, skew_settings):
    child = spark.range(0, N, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hub@p")
        .otherwise(F.concat(F.lit("p"), "id"))
        .alias("ref_qualified_name"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    parents = spark.range(0, N, 1, 8).select(
        F.when(F.col("id") == 0, "hub@p").otherwise(F.concat(F.lit("p"), "id")).alias("q")
    )
    parents = entity_rows(parents, F.lit("table"), "q", "q")
    found = resolve_refs(child, parents, "table")
    rows = found.collect()
    assert len(rows) == N and all(r.parent_guid for r in rows)
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


# ---- columns ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def table_columns(spark):
    return spark.createDataFrame(
        [("s", "a"), ("s", "b"), ("t", "x"), ("t", "y"), ("u", "a")], "table_name STRING, name STRING"
    ).withColumn("guid", F.concat_ws(".", "table_name", "name"))


@pytest.fixture(scope="module")
def mapping(spark):
    return spark.createDataFrame(
        [("s", "a", "t", "x"), ("s", "b", "t", "nope"), ("s", "nope", "t", "y")],
        "src_table STRING, src_column STRING, dst_table STRING, dst_column STRING",
    )


def test_column_lineage_skips_unknown_names(table_columns, mapping):
    got = [tuple(r) for r in columns.column_lineage(table_columns, mapping).collect()]
    assert got == [("s", "t", "s.a", "t.x")]


def test_column_process_keeps_each_known_side(table_columns, mapping):
    run_ts = datetime(2024, 1, 1)
    process = columns.column_processes(mapping, run_ts).collect()
    assert [(p.name, p.qualified_name) for p in process] == [
        ("column_mapping_s_to_t", "column_lineage_s_to_t_1704067200")
    ]
    io = columns.column_process_io(table_columns, mapping, run_ts)
    guid = process[0].guid
    assert {tuple(r) for r in io.collect()} == {
        (guid, "input", "s.a"),
        (guid, "input", "s.b"),
        (guid, "output", "t.x"),
        (guid, "output", "t.y"),
    }


def test_column_edges_can_be_walked(spark, table_columns, mapping):
    edges = columns.column_lineage(table_columns, mapping).select("src_guid", "dst_guid")
    got = hops(lin.lineage(edges, roots_of(spark, ["s.a"]), 1, "OUTPUT"))
    assert got == {("s.a", "s.a", "OUTPUT"): 0, ("s.a", "t.x", "OUTPUT"): 1}


def test_schema_diff(spark):
    ddl = "column_name STRING, data_type STRING"
    old = spark.createDataFrame([("a", "int"), ("b", "int"), ("c", "int")], ddl)
    new = spark.createDataFrame([("a", "int"), ("b", "string"), ("d", "int")], ddl)
    got = {tuple(r) for r in columns.schema_diff(old, new, ["column_name"]).collect()}
    assert got == {
        ("b", "int", "string", "retyped"),
        ("c", "int", None, "removed"),
        ("d", None, "int", "added"),
    }


def test_column_processes_of_all_line_items(spark, sf_dir, tmp_path):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    finished = lines.where("l_linestatus = 'F'")
    finished.write.parquet(str(tmp_path / "lineitem.parquet"))
    pairs = finished.select("l_suppkey", "l_linenumber").distinct().count()
    assert QUERIES["column_processes"](spark, str(tmp_path)).count() == pairs > 0


@pytest.mark.parametrize("seed", [1, 2])
def test_retagging_after_a_change_equals_a_full_run(spark, tmp_path, seed):
    """Tags and edges added and removed at once, in a graph with cycles; once over buckets."""
    rng = random.Random(seed)
    nodes = [f"n{n}" for n in range(60)]
    pairs = {(rng.choice(nodes), rng.choice(nodes)) for _ in range(75)}
    more = {(rng.choice(nodes), rng.choice(nodes)) for _ in range(6)} - pairs
    less = set(rng.sample(sorted(pairs), 6))
    old = {(rng.choice(nodes), rng.choice("AB")) for _ in range(12)}
    new = (old - set(rng.sample(sorted(old), 4))) | {(rng.choice(nodes), "A")}
    before = spark.createDataFrame(sorted(pairs), EDGES)
    after = spark.createDataFrame(sorted((pairs - less) | more), EDGES)
    rewired = spark.createDataFrame(sorted(less | more), EDGES)
    retagged = spark.createDataFrame([(g,) for g, _ in sorted(old ^ new)], "guid STRING")
    spread = spread_tags(before, tag_rows(spark, *sorted(old)))
    tags = tag_rows(spark, *sorted(new))
    edges = lin.write_edges(after, str(tmp_path / "edges"), 4) if seed == 2 else after
    found = retag(spread, edges, tags, retagged, rewired)
    assert rows_of(found) == rows_of(spread_tags(after, tags))
    plain = ["guid", "classification", "propagated"]
    whole = lin.propagate_tags(after, tags)
    assert rows_of(tags_of(found, tags).select(plain)) == rows_of(whole.select(plain))


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_a_cycle_does_not_hold_up_a_tag(spark):
    before = edges_of(spark, "ab bc cb cd xy")
    tags = tag_rows(spark, ("a", "PII"), ("x", "PII"))
    spread = spread_tags(before, tags)
    none = spark.createDataFrame([], "guid STRING")
    cut = spark.createDataFrame([("a", "b")], EDGES)
    after = edges_of(spark, "bc cb cd xy")
    assert rows_of(affected_nodes(after, none, cut)) == [("b",), ("c",), ("d",)]
    found = retag(spread, after, tags, none, cut)
    assert rows_of(found) == [("a", "PII", 0, "a"), ("x", "PII", 0, "x"), ("y", "PII", 1, "x")]
    same = retag(spread, before, tags, none, cut.limit(0))
    assert rows_of(same) == rows_of(spread)


# ---- sizes ------------------------------------------------------------------------------


def test_a_hop_down_moves_only_its_nodes(spark, tmp_path, skew_settings):
    pairs = [(f"n{i}", f"n{(7 * i + 3) % 40}") for i in range(40)] + [(f"n{i}", f"n{i + 1}") for i in range(39)]
    edges = spark.createDataFrame(pairs, EDGES)
    placed = lin.place_edges(edges, str(tmp_path / "placed"), 5)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("edges_")]
    nodes = materialize(roots_of(spark, ["n1", "n5"]), "nodes")
    hop = lin._edges_of(placed, nodes, True)
    assert {(r.guid, r.next_guid) for r in hop.collect()} == {p for p in pairs if p[0] in ("n1", "n5")}
    assert hop._jdf.queryExecution().sparkPlan().toString().count("Scan parquet") == 2
    assert hop._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange ") == 1
    tags = spark.createDataFrame([("n3", "PII", {"a": "1"}, False), ("n9", "PII", {"a": "2"}, False)], CLASSIFICATIONS)
    rows = [
        sorted((r.guid, r.attributes["a"], r.propagated) for r in lin.propagate_tags(e, tags).collect())
        for e in (edges, placed)
    ]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("name", ["propagate_tags", "retag_after_change"])
def test_walks_from_many_nodes_use_placed_edges(spark, sf_dir, monkeypatch, name):
    used = []

    def place(edges, path, tasks):
        used.append(tasks)
        return lin_place(edges, path, tasks)

    lin_place = lin.place_edges
    monkeypatch.setattr(views, "place_edges", place)
    QUERIES[name](spark, sf_dir)
    assert used == [views.row_tasks(spark, sf_dir)]


@pytest.mark.parametrize("name", ["build_edges", "lineage_counts", "has_lineage", "verify_catalog", "metadata_audit"])
def test_tasks_that_make_edges_distinct_grow_with_the_table(spark, sf_dir, monkeypatch, name):
    monkeypatch.setattr(views, "TASK_ROWS", 500)
    tasks = views.row_tasks(spark, sf_dir)
    lines = views.table(spark, sf_dir, "lineitem").count()
    assert tasks == -(-lines // 500)
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(.*?, (\d+)\), REPARTITION_BY_NUM", plan)
    assert dealt.count(str(tasks)) >= (3 if name == "build_edges" else 2)
