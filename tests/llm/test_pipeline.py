"""The stages on odd tables, and the whole run on a small one."""

import pytest

import corpus_pipeline
from tablewarden.llm import decontaminate, line_runs, quality_rules, simhash
from tablewarden.llm.common import components
from texts_fixture import frame, prose


# Names that the stages use for themselves.
MADE = (
    "__id __hash __text __row __m __f __f0 __f1 __f2 __j0 __j1 __k __k0 __k1 __g __n __level __kept __base_failed "
    "__gone __at __line __h1 __h2 __rank __next __first __part __fp __class __root __min __first_id __first_hash "
    "item_id start end edits spans kept score component_id fingerprint"
).split()


@pytest.mark.parametrize("clashes", [False, True])
def test_stages_take_odd_rows(spark, sf_dir, clashes):
    docs = frame(spark)
    if clashes:
        docs = docs.selectExpr("*", *[f"concat('{name}', doc_id) AS `{name}`" for name in MADE], "1 AS `a.b c`")
    before = {tuple(r) for r in docs.drop("text", "n_chars").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns, name
        after = [tuple(r) for r in kept.drop("text", "n_chars").collect()]
        assert 0 < len(after) <= docs.count() and set(after) <= before, name
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert pieces.count() >= docs.count()


def test_stages_take_empty_tables(spark, sf_dir):
    docs = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0, name


def test_run_equals_stages_by_hand(spark, sf_dir):
    """Each decision, made again from the operators' own brute force, on the smallest table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    good = {r.doc_id for r in quality_rules.rules_report(docs).collect() if r.kept}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in good)
    first, cleaned = {}, []
    for doc, text in rows:
        lines = text.split("\n")
        worded = [(n, x.strip(line_runs.BLANKS)) for n, x in enumerate(lines) if x.strip(line_runs.BLANKS)]
        gone = set()
        for at, (a, x) in enumerate(worded):
            if len(x) >= 50 or len(x.split()) >= 8:
                gone |= {a} if first.setdefault(x, (doc, at)) != (doc, at) else set()
        for at, ((a, x), (b, y)) in enumerate(zip(worded, worded[1:])):
            source, place = first.setdefault((x, y), (doc, at))
            gone |= {a, b} if source != doc or at >= place + 2 else set()
        cleaned.append((doc, "\n".join(x for n, x in enumerate(lines) if n not in gone)))
    prints = {doc: simhash.simhash(text) for doc, text in cleaned}
    group = {doc: doc for doc in prints}
    for a in sorted(prints):
        for b in sorted(prints):
            if (prints[a] ^ prints[b]).bit_count() <= 4 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    index = decontaminate.build_index(sorted(benchmark))
    left = {d for d, t in cleaned if group[d] == d and not decontaminate.matches(index, t)}
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in got} == left
    assert 0 < len(left) < docs.count()


def test_components_against_search(spark):
    import random

    rng = random.Random(5)
    pairs = [(n, n + 1) for n in range(1000, 1200)] + [(0, n) for n in range(1, 300)]
    pairs += [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(300)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_words_of_fixture_are_distinct():
    assert prose(1, 50) != prose(2, 50)
