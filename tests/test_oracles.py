"""Every session query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__
from tidemark import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or v != v:
        return None
    return v.tolist() if hasattr(v, "tolist") else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    want = duck.sql(registry.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    at = [want.columns.index(c) for c in cols]
    a = sorted((tuple(plain(r[c]) for c in cols) for r in got.collect()), key=str)
    b = sorted((tuple(plain(r[k]) for k in at) for r in want.fetchall()), key=str)
    assert a == b


def test_entry_and_names(spark):
    assert set(registry.oracle_sql()) <= set(registry.queries()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns[:2] == ["symbol", "trading_date"]
