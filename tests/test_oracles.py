import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry


def norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"create view {f[:-8]} as select * from '{data}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - {n for n in entry.oracle_sql() if n.startswith(("p1_", "p4_", "p5_", "p7_", "p8_", "p9_", "p10_"))}))
def test_query_matches_sql(spark, data, duck, name):
    df = entry.queries()[name](spark, data)
    cols = sorted(df.columns)
    cur = duck.execute(entry.oracle_sql()[name])
    at = [[c[0] for c in cur.description].index(c) for c in cols]
    want = Counter(repr([norm(r[i]) for i in at]) for r in cur.fetchall())
    assert Counter(repr([norm(r[c]) for c in cols]) for r in df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
