"""The registered queries against their SQL on the small tables, as far as these are there."""

import collections
import os
from decimal import Decimal

import pytest

import __spark_entry__ as e

SMALL = "/root/testdata/sf0.001"
NAMES = sorted(n for n in e.oracle_sql() if not n.startswith("op") and n != "pipeline")


def same(v):
    return str(v.normalize()) if isinstance(v, Decimal) else repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_like_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "events", "labels"):
        con.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    df = e.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    want = con.sql(e.oracle_sql()[name])
    assert sorted(want.columns) == columns
    order = [list(want.columns).index(c) for c in columns]
    got = collections.Counter(tuple(same(r[c]) for c in columns) for r in df.collect())
    assert got == collections.Counter(tuple(same(r[i]) for i in order) for r in want.fetchall())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", ["pass2_results", "removal_counts"])
def test_like_sql_by_position(spark, name):
    """The columns come in the SQL's order too: who compares rows by position finds no difference."""
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "events", "labels"):
        con.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    df, want = e.queries()[name](spark, SMALL), con.sql(e.oracle_sql()[name])
    assert df.columns == list(want.columns)
    assert collections.Counter(map(tuple, df.collect())) == collections.Counter(want.fetchall())


def test_entry(spark):
    if os.path.isdir(SMALL):
        assert e.entry(spark).count() > 0
