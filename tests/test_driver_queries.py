"""Every registered driver query against its DuckDB oracle (sf0.001)."""

import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from martspark.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    return str(v.normalize()) if isinstance(v, Decimal) else v


def _bag(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in data)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "business_key_hash" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _bag(df.columns, got) == _bag(cols, want)
