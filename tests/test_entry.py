"""Every query against its SQL, and the contract of the entry points."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from tablewarden.plans.registry import ORACLES as SQL
from tablewarden.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "id",
        "line",
        "age",
        "salary",
        "department",
        "employee_category",
        "salary_band",
        "processed_date",
    ]


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    compare(spark, QUERIES[name], SQL[name], sf_dir, con)


def test_golden_walk(spark):
    down = QUERIES["lineage_down"](spark, "/root/testdata/sf0.01")
    count = {r.hop: r["count"] for r in down.groupBy("hop").count().collect()}
    assert count == {0: 1, 1: 10, 2: 42, 3: 100, 4: 25}
