from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import canon

D = "/root/testdata/sf0.001"
CORE = {k: v for f in entry.families() for k, v in f.QUERIES.items()}
SQL = {k: v for f in entry.families() for k, v in f.ORACLE.items()}


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for t in os.listdir(D):
        path = os.path.join(D, t)
        c.sql(f"create view {t[:-8]} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_against_its_sql(spark, con, name):
    df = CORE[name](spark, D)
    columns = sorted(df.columns)
    mine = Counter(tuple(canon(r[c]) for c in columns) for r in df.collect())
    if name in SQL:
        rel = con.sql(SQL[name])
        assert sorted(rel.columns) == columns
        at = [rel.columns.index(c) for c in columns]
        assert mine == Counter(tuple(canon(r[i]) for i in at) for r in rel.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
