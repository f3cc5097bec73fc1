"""Every registered query against its SQL oracle on the smallest bench tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from marginalia.sources.roles import TABLES

SF = "/root/testdata/sf0.001"


def canon(v):
    if isinstance(v, float):
        return round(v, 9) + 0.0
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cols = sdf.columns
    s_rows = Counter(tuple(canon(r[c]) for c in sorted(cols)) for r in sdf.collect())
    cur = con.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    assert sorted(d_cols) == sorted(cols)
    idx = [d_cols.index(c) for c in sorted(cols)]
    d_rows = Counter(tuple(canon(r[i]) for i in idx) for r in cur.fetchall())
    assert s_rows == d_rows


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "month" in df.columns
