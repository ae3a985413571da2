"""Compare a query with its SQL: column names, types of values and all rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        raise AssertionError("decimal value in a result")
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value + 0.0, 9)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def compare(spark, query, sql, sf_dir, con=None):
    con = con or connect(sf_dir)
    df = query(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = _rows(names, cursor.fetchall())
    assert got[0] == want[0], f"columns {got[0]} != {want[0]}"
    assert len(got[1]) == len(want[1]), f"rows {len(got[1])} != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        assert a == b, f"{a} != {b}"
    types = [type(v) for row in got[1][:1] for v in row]
    types_sql = [type(v) for row in want[1][:1] for v in row]
    assert types == types_sql, f"{types} != {types_sql}"
    return len(got[1])
