"""Streams into the catalog, deep pages, grams, sketches, intervals and integrity."""

import os
import random
import time
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablewarden.materialize import scratch_path
from tablewarden.operators import audit, columns, entities, gram_index, integrity, load_stats, pages, runs
from tablewarden.operators.model import EDGES
from tablewarden.plans import views
from tablewarden.plans.registry import QUERIES
from tablewarden.streaming import ingest, merged

T0 = datetime(2024, 1, 1)


def batch(spark, *names, kind="a", owner="o", at=T0):
    df = spark.createDataFrame([(n, owner, at) for n in names], "n STRING, o STRING, c TIMESTAMP_NTZ")
    return entities.entity_rows(df, F.lit(kind), "n", "n", "o", None, "c")


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


# ---- streams into the catalog ----------------------------------------------------------


def known(spark, path):
    return sorted((r.name, r.owner) for r in merged.read_merged(spark, path).collect())


def test_a_batch_is_merged_once(spark, tmp_path):
    path = str(tmp_path / "c")
    merged.start_catalog(batch(spark, "x"), path)
    arriving = batch(spark, "x", "y", "y", owner="late")
    for _ in range(3):
        merged.merge_batch(arriving, path, "s", 0)
    merged.merge_batch(batch(spark, "y", "z", owner="later"), path, "s", 1)
    assert known(spark, path) == [("x", "o"), ("y", "late"), ("z", "later")]


def test_failure_between_merge_and_commit(spark, tmp_path):
    path = str(tmp_path / "c")
    merged.start_catalog(batch(spark, "x"), path)
    # Written, but the driver is gone before the commit: readers do not see it.
    assert merged.write_part(batch(spark, "y", owner="lost"), path, "s", 0) == 1
    assert known(spark, path) == [("x", "o")]
    # The rerun finds another file in its batch as well, and replaces what was written.
    merged.merge_batch(batch(spark, "y", "w", owner="again"), path, "s", 0)
    assert known(spark, path) == [("w", "again"), ("x", "o"), ("y", "again")]


def test_failed_stream_runs_again(spark, tmp_path, monkeypatch):
    """The stream dies after the merge, then after the commit; each rerun ends with one row per key."""
    landing, path, progress = (str(tmp_path / n) for n in ("l", "c", "p"))
    merged.start_catalog(batch(spark, "x"), path)
    batch(spark, "x", "y").write.parquet(landing)
    commit = merged.commit
    steps = []

    def dies_before(*args):
        steps.append("before")
        raise RuntimeError("lost")

    def dies_after(*args):
        steps.append("after")
        commit(*args)
        raise RuntimeError("lost")

    def run():
        files = spark.readStream.schema(batch(spark).schema).parquet(landing)
        return ingest.merge_stream(files, path, progress)

    for broken in (dies_before, dies_after):
        monkeypatch.setattr(merged, "commit", broken)
        with pytest.raises(Exception, match="lost"):
            run()
    monkeypatch.setattr(merged, "commit", commit)
    assert sorted(r.name for r in run().collect()) == ["x", "y"]
    assert steps == ["before", "after"]
    batch(spark, "y", "z").write.mode("append").parquet(landing)
    assert sorted(r.name for r in run().collect()) == ["x", "y", "z"]


def test_a_new_checkpoint_overwrites_nothing(spark, tmp_path):
    landing, path = str(tmp_path / "l"), str(tmp_path / "c")
    batch(spark, "x", "y").write.parquet(landing)
    for progress in ("p1", "p2"):
        files = spark.readStream.schema(batch(spark).schema).parquet(landing)
        found = ingest.merge_stream(files, path, str(tmp_path / progress))
        batch(spark, f"z{progress}").write.mode("append").parquet(landing)
    assert sorted(r.name for r in found.collect()) == ["x", "y", "zp1"]


def test_files_of_known_entities_are_not_registered_again(spark, tmp_path):
    landing, path = tmp_path / "landing", str(tmp_path / "c")
    landing.mkdir()

    def run():
        return ingest.merge_new_files(spark, str(landing), path, str(tmp_path / "p"), "CSV", "*.csv")

    (landing / "a.csv").write_text("1")
    first = run().collect()
    assert [r.name for r in first] == ["a.csv"]
    time.sleep(1.1)
    # The same file with a new time is a new file to the stream, but a known entity.
    (landing / "a.csv").write_text("2")
    os.utime(landing / "a.csv")
    (landing / "b.csv").write_text("1")
    found = run()
    assert sorted(r.name for r in found.collect()) == ["a.csv", "b.csv"]
    assert found.filter("name = 'a.csv'").first() == first[0]


def test_entities_without_a_status_are_there(spark):
    known_rows = batch(spark, "x", "gone").withColumn("status", F.when(F.col("name") == "gone", "DELETED"))
    expected = spark.createDataFrame([("a", "x"), ("a", "gone"), ("a", "new")], "type_name STRING, name STRING")
    assert sorted(r.name for r in entities.missing_entities(known_rows, expected).collect()) == ["gone", "new"]
    edges = spark.createDataFrame([], EDGES)
    faults = audit.catalog_faults(known_rows, edges, expected, "a").collect()
    assert sorted((r.fault, r.named) for r in faults) == [("missing", "gone"), ("missing", "new"), ("no_lineage", "x")]
    guid = known_rows.filter("name = 'x'").first().guid
    edges = spark.createDataFrame([(guid, "other")], EDGES)
    audit.verify_catalog(known_rows, edges, expected.filter("name = 'x'"), ["x"])


# ---- deep pages ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ordered(spark, tmp_path_factory):
    """50,000 rows in some 50 ranges; the first key repeats, and some rows repeat both keys."""
    df = spark.range(50_000).select(
        F.when(F.col("id") % 1000 > 0, F.format_string("q%03d", F.pmod(F.xxhash64("id"), F.lit(700)))).alias("q"),
        (F.col("id") - F.col("id") % 2).alias("g"),
        F.col("id").alias("v"),
    )
    path = str(tmp_path_factory.mktemp("pages") / "o")
    table = pages.write_ordered(df, path, ("q", "g"), 1000)
    rows = sorted(
        (tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0], r[1], f'{{"v":{r[2]}}}')
    )
    return table, rows


@pytest.mark.parametrize("offset, limit", [(0, 5), (9_990, 20), (25_000, 2500), (49_995, 20), (50_000, 5), (7, 0)])
def test_pages_by_offset(ordered, offset, limit):
    table, rows = ordered
    got = [tuple(r) for r in pages.page(table, offset, limit).collect()]
    assert got == rows[offset : offset + limit]


def test_a_deep_page_reads_one_or_two_ranges(ordered):
    table, _ = ordered
    assert len(table.ranges) > 30
    for found in (pages.page(table, 40_000, 20), pages.page_after(table, ("q350", 1), 20)):
        filters = plan_of(found).split("PartitionFilters: [")[1].split("]\n")[0]
        ranges = filters.split(" IN (")[1].split(")")[0].split(",") if " IN (" in filters else ["one"]
        assert "_range#" in filters and len(ranges) <= 3


def test_walking_by_last_key_gives_all_rows(spark, tmp_path):
    rng = random.Random(2)
    rows = [(None if rng.random() < 0.1 else f"q{rng.randint(0, 40)}", f"g{n}") for n in range(500)]
    table = pages.write_ordered(spark.createDataFrame(rows, "q STRING, g STRING"), str(tmp_path / "o"), ("q", "g"), 40)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    got = [tuple(r) for r in pages.page(table, 0, 97).collect()]
    while True:
        more = [tuple(r) for r in pages.page_after(table, got[-1], 97).collect()]
        if not more:
            break
        got += more
    assert got == want


def test_pages_of_nothing(spark, tmp_path):
    table = pages.write_ordered(spark.createDataFrame([], "q STRING, g STRING"), str(tmp_path / "o"), ("q", "g"))
    assert pages.page(table, 0, 10).count() == 0


# ---- grams -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(3)
    words = ["ring", "bring", "rin", "ingot", "Ünï", "日本語字", "a%b_c", "", "gring\\o", "xx"]
    rows = [
        (str(n), None if n % 17 == 0 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 6))),
         rng.choice(words) + str(n % 13))
        for n in range(4000)
    ]
    return spark.createDataFrame(rows, "guid STRING, name STRING, description STRING")


@pytest.fixture(scope="module")
def index(texts, tmp_path_factory):
    return gram_index.write_index(texts, str(tmp_path_factory.mktemp("grams")), ("name", "description"))


@pytest.mark.parametrize("text", ["ring", "ing", "ring bring", "gring\\", "本語字", "a%b", "Ünï", "zzz", "xx1", "in", "", "ringring", "t12"])
@pytest.mark.parametrize("fields", [("name",), ("name", "description")])
def test_grams_find_what_a_scan_finds(texts, index, text, fields):
    holds = " OR ".join(f"contains({f}, '{text.replace(chr(92), chr(92) * 2)}')" for f in fields)
    want = sorted(r.guid for r in texts.filter(holds).collect())
    got = gram_index.contains(index, text, fields)
    assert sorted(r.guid for r in got.collect()) == want
    assert got.columns == texts.columns


def test_grams_of_an_empty_table(spark, texts, tmp_path):
    empty = gram_index.write_index(texts.limit(0), str(tmp_path), ("name",))
    assert gram_index.contains(empty, "ring", ("name",)).count() == 0


def test_gap_coding_round_trip(spark):
    rng = random.Random(4)
    for size in (1, 2, 63, 64, 65, 1000, 70_000):
        numbers = sorted(rng.sample(range(1 << 17), size))
        df = spark.createDataFrame([(numbers,)], "n ARRAY<INT>").select(gram_index.gap_coded(F.col("n")).alias("g"))
        row = df.select("g", gram_index.numbers_of(F.col("g")).alias("n")).first()
        assert row.n == numbers
        assert row.g[0][0] == numbers[0] and max(map(len, row.g)) <= gram_index.RUN


def test_a_search_reads_postings_before_rows(index):
    plan = plan_of(gram_index.candidates(index, "ring", ("name",)))
    assert plan.count("Scan parquet") == 2 and "/lists" in plan and "/rows" not in plan
    assert "PartitionFilters: [isnotnull(folder" in plan or "folder#" in plan.split("PartitionFilters:")[1][:80]
    with pytest.raises(ValueError, match="owner"):
        gram_index.contains(index, "ring", ("owner",))


# ---- sketches --------------------------------------------------------------------------


def test_statistics_of_all_loads(spark, tmp_path):
    df = spark.range(60_000).select(
        (F.col("id") % 20_000).alias("k"),
        F.when(F.col("id") % 3 > 0, F.sqrt("id")).alias("x"),
        F.concat(F.lit("t"), (F.col("id") % 777).cast("string")).alias("t"),
        F.lit(None).cast("int").alias("none"),
        F.array("id").alias("nested"),
        (F.col("id") % 7).alias("load"),
    )
    path = str(tmp_path / "s")
    for n in range(7):
        for _ in range(1 + n % 2):
            # A load that is run again replaces its own statistics.
            load_stats.store_load(df.filter(F.col("load") == n).drop("load"), path, f"d{n}")
    load_stats.store_load(df.limit(0).drop("load"), path, "empty")
    merged_rows = load_stats.merged_stats(load_stats.read_loads(spark, path))
    rows = {r.column_name: r for r in merged_rows.collect()}
    assert set(rows) == {"k", "x", "t", "none"}
    assert all((r.n_rows, r.n_loads) == (60_000, 8) for r in rows.values())
    assert (rows["x"].n_nulls, rows["none"].n_nulls) == (20_000, 60_000)
    assert (rows["k"].least, rows["k"].greatest, rows["t"].least) == (0.0, 19_999.0, None)
    assert rows["none"].n_distinct == 0 and rows["none"].quantiles is None
    for r in load_stats.measured_errors(df, merged_rows).collect():
        assert r.distinct_error <= load_stats.DISTINCT_ERROR
        assert (r.rank_error or 0) <= load_stats.RANK_ERROR
    with pytest.raises(ValueError):
        load_stats.store_load(df, path, "a/b")


# ---- intervals -------------------------------------------------------------------------


def test_intervals_against_every_run(spark):
    rng = random.Random(5)
    runs = sorted(rng.sample(range(100), 12))
    names, at = [f"c{n}" for n in range(15)], {}
    for run in runs:
        for name in names:
            if rng.random() < 0.6:
                at[run, name] = rng.choice(["int", "string", None])
    snaps = spark.createDataFrame([(r, n, t) for (r, n), t in at.items()], "run INT, name STRING, data_type STRING")
    all_runs = spark.createDataFrame([(r,) for r in runs], "run INT")
    found = columns.schema_intervals(snaps.unionByName(snaps.limit(5)), all_runs, ["name"])
    for run in runs:
        got = {r["name"]: r.data_type for r in columns.schema_as_of(found, F.lit(run)).collect()}
        assert got == {n: t for (r, n), t in at.items() if r == run}
    want = set()
    for before, run in zip(runs, runs[1:]):
        for name in names:
            old, new = ((r, name) in at for r in (before, run))
            if old and new and at[before, name] != at[run, name]:
                want.add((name, run, at[before, name], at[run, name], "retyped"))
            elif new and not old:
                want.add((name, run, None, at[run, name], "added"))
            elif old and not new:
                want.add((name, run, at[before, name], None, "removed"))
    got = columns.schema_changes(found, ["name"], F.lit(runs[0])).select("name", "run", "old_type", "new_type", "change")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


# ---- integrity -------------------------------------------------------------------------


def test_differences_against_counting(spark, tmp_path):
    rng = random.Random(6)
    source = [(rng.choice([None, *range(80)]), rng.choice(["a", "b", None])) for _ in range(300)]
    target = [r for r in source if rng.random() < 0.95] + [(rng.randint(60, 90), "a") for _ in range(8)]
    frames = [spark.createDataFrame(rows, "k INT, v STRING").repartition(5) for rows in (source, target)]
    got = integrity.reconcile_loads(*frames, str(tmp_path), ("k",), 16)
    want = []
    for k in {r[0] for r in source + target}:
        one, two = (Counter(r for r in rows if r[0] == k) for rows in (source, target))
        if one != two:
            kind = "missing" if not two else "added" if not one else "repeated" if set(one) == set(two) else "changed"
            want.append((k, kind, sum(one.values()), sum(two.values())))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_order_does_not_matter_and_equal_buckets_are_not_read(spark, tmp_path):
    df = spark.range(2000).select("id", (F.col("id") % 7).cast("string").alias("v"))
    other = df.orderBy(F.desc("id")).withColumn("v", F.when(F.col("id") == 77, "x").otherwise(F.col("v")))
    written = [
        integrity.write_bucketed(d, str(tmp_path / n), ("id",), 32) for n, d in (("a", df), ("b", other), ("c", df.repartition(3)))
    ]
    assert integrity.differing_buckets(written[0], written[2]) == []
    (bucket,) = integrity.differing_buckets(written[0], written[1])
    found = integrity.differences(written[0], written[1])
    assert [tuple(r) for r in found.collect()] == [(77, "changed", 1, 1)]
    plan = plan_of(found)
    assert f"({bucket})" in plan.replace("Some", "") or f"_bucket#" in plan and f"= {bucket})" in plan
    with pytest.raises(ValueError):
        integrity.differing_buckets(written[0], integrity.write_bucketed(df, scratch_path(spark, "o"), ("id",), 8))


# ---- facts of runs ---------------------------------------------------------------------


def test_facts_of_runs(spark):
    facts = []
    with runs.record_run(spark, facts, "job", "LOAD") as run:
        out = run.reads(spark.range(100)).filter("id % 4 = 0").unionByName(run.reads(spark.range(10)))
        run.writes(out).write.format("noop").mode("overwrite").save()
    with pytest.raises(KeyError):
        with runs.record_run(spark, facts, "bad", description="Says no") as run:
            run.reads(spark.range(5))
            raise KeyError("no such table")
    good, bad = (f.first() for f in facts)
    assert (good.rows_in, good.rows_out, good.status, good.message) == (110, 35, "SUCCEEDED", None)
    assert good.user_name and good.start_time <= good.end_time and good.operation == "LOAD"
    assert (bad.rows_in, bad.rows_out, bad.status) == (None, None, "FAILED") and "no such table" in bad.message
    found = {r.name: r for r in runs.run_processes(facts[0].unionByName(facts[1])).collect()}
    assert found["job"].attributes["rows_out"] == "35" and "message" not in found["job"].attributes
    assert found["bad"].attributes["status"] == "FAILED" and "rows_in" not in found["bad"].attributes
    assert found["job"].qualified_name.startswith("job_20") and found["job"].create_time == good.start_time


def test_columns_of_the_sample_graph_have_comments(spark):
    from tablewarden.plans import jobs

    found = jobs.sample_graph(spark, "demo", "sample_etl", T0).entities.filter("type_name = 'hive_column'").collect()
    assert len(found) == 14 and all(r.description for r in found)
    assert {r.description for r in found if r.name == "adjusted_salary"} == {
        "Adjusted salary", "Adjusted salary after calculations",
    }


# ---- sizes ------------------------------------------------------------------------------


def test_a_batch_is_written_twice_at_most(spark, tmp_path, monkeypatch):
    labels, written = [], merged.materialize

    def noted(df, label, *args, **more):
        labels.append(label)
        return written(df, label, *args, **more)

    monkeypatch.setattr(merged, "materialize", noted)
    catalog = str(tmp_path / "catalog")
    names = spark.range(30).select(F.concat(F.lit("t"), (F.col("id") % 20).cast("string")).alias("n"))
    rows = entities.entity_rows(names, F.lit("hive_table"), "n", "n")
    assert merged.write_part(rows, catalog, "s", 0) == 20
    assert labels == ["batch"]
    assert spark.read.parquet(f"{catalog}/parts/s-0").count() == 20
    assert all(".zstd." in f.name for f in (tmp_path / "catalog/parts/s-0").glob("part-*"))


def test_gaps_cut_each_run_once():
    assert str(gram_index.gap_coded(F.col("numbers"))).count("slice(") == 1


def test_intervals_are_worked_out_once(spark, sf_dir):
    plan = QUERIES["schema_as_of"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "lineitem" not in plan


def test_a_task_sorts_its_share_of_columns(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(views, "TASK_ROWS", 500)
    tasks = views.row_tasks(spark, sf_dir)
    plan = QUERIES["schema_intervals"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert f", {tasks}), REPARTITION_BY_NUM" in plan
