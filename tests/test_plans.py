"""Plan-shape checks for the scale rules (skew, shuffles, no pair joins, no Python)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martspark.plans.registry import QUERIES
from martspark.operators import keep_first, latest_per_key, quality
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_joins_or_python(spark, name):
    p = plan_of(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, f"{name}: {bad}"


def test_hot_key_keep_first(spark):
    # one key holds a third of all rows
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"))
    out = latest_per_key(df, ["k"], "ts")
    assert out.count() == 20001
    assert rows(out.where("k = 0"), "ts") == [(dt.datetime(1970, 1, 1, 8, 19, 57),)]
    p = plan_of(out)
    assert p.count("WindowGroupLimit") == 2 and "Partial" in p  # map-side limit before the shuffle


def test_partial_aggregation_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"))
    for d in (quality.duplicate_groups(df, ["k"], "d", "dup"), quality.missing_keys(df, "k", df.limit(3))):
        p = plan_of(d)
        assert "partial_count" in p


def test_lookups_broadcast(spark):
    from martspark.plans.catalog import sales_current
    p = plan_of(sales_current(spark, SF))
    assert p.count("BroadcastHashJoin") >= 2


def test_priority_keep_first_total_order(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y")], "k string, r int, v string")
    assert rows(keep_first(df, ["k"], [F.col("r").asc()], ["r"])) == [("a", 1, "y")]
