"""Keep-first (A6, A7, M7), upsert (M1-M6) and surrogate keys (K3)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martspark.operators import assign_surrogate, keep_first, latest_per_key, upsert
from martspark.plans.dims import conform_status_map
from martspark.sources import seeds
from tests.conftest import rows

T1, T2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)


def test_latest_wins_and_null_time_first(spark):
    data = [("A", T1, "old"), ("A", T2, "new"), ("B", None, "null-ts"), ("B", T2, "later")]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v string")
    got = rows(latest_per_key(df, ["k"], "ts"), "k", "v")
    assert got == [("A", "new"), ("B", "null-ts")]  # D8: NULL time sorts first under DESC


def test_keep_first_is_order_independent(spark):
    data = [(k % 7, random.Random(k).choice([T1, T2]), f"v{k % 3}") for k in range(200)]
    outs = set()
    for seed in range(3):
        shuffled = data[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "k int, ts timestamp_ntz, v string").repartition(5)
        outs.add(tuple(rows(latest_per_key(df, ["k"], "ts"))))
    assert len(outs) == 1


def test_keep_first_plans_partial_limit(spark):
    df = spark.createDataFrame([(1, T1)], "k int, ts timestamp_ntz")
    plan = latest_per_key(df, ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_status_priority(spark):
    lit = spark.createDataFrame([("x", "RETURN"), ("x", "CANCELLED"), ("y", "COMPLETED"), ("y", "NEW"),
                                 ("z", "UNKNOWN"), ("z", "COMPLETED"), ("w ", "FRAUD")],
                                "raw_status string, status_std string")
    got = rows(conform_status_map(lit))
    assert got == [("w", "FRAUD"), ("x", "CANCELLED"), ("y", "NEW"), ("z", "COMPLETED")]


def test_status_map_seed_counts(spark):
    m = conform_status_map(seeds.status_literals(spark))
    assert len(seeds.STATUS_MAP) == 85
    assert m.count() == 80  # D6: trimmed keys, no conflicting codes
    got = dict(rows(m))
    assert got["Zwrot"] == "RETURN" and got["Zamówienie zakończone"] == "COMPLETED"


SCHEMA = "k string, v int, h string, ts timestamp_ntz"


def test_upsert_update_insert_keep(spark):
    t = spark.createDataFrame([("a", 1, "h1", T1), ("b", 2, "h2", T1)], SCHEMA)
    s = spark.createDataFrame([("b", 20, "h2x", None), ("c", 3, "h3", None)], SCHEMA)
    stamp = F.lit(T2).cast("timestamp_ntz")
    got = rows(upsert(t, s, ["k"], ["v", "h"], stamps={"ts": stamp}))
    assert got == [("a", 1, "h1", T1), ("b", 20, "h2x", T2), ("c", 3, "h3", T2)]
    keep = rows(upsert(t, s, ["k"], on_match="keep"))
    assert keep == [("a", 1, "h1", T1), ("b", 2, "h2", T1), ("c", 3, "h3", None)]


def test_upsert_guard_keeps_unchanged_stamp(spark):
    t = spark.createDataFrame([("a", 1, "h1", T1), ("b", 2, "h2", T1)], SCHEMA)
    s = spark.createDataFrame([("a", 99, "h1", None), ("b", 3, "h3", None)], SCHEMA)
    out = upsert(t, s, ["k"], ["v", "h"], guard="h", stamps={"ts": F.lit(T2).cast("timestamp_ntz")},
                 with_action=True)
    assert rows(out) == [("a", 1, "h1", T1, "unchanged"), ("b", 3, "h3", T2, "update")]


def test_upsert_null_keys_use_presence(spark):
    t = spark.createDataFrame([(None, 1, "h", T1)], SCHEMA)
    s = spark.createDataFrame([(None, 2, "h2", T1)], SCHEMA)
    assert rows(upsert(t, s, ["k"], ["v", "h"])) == [(None, 2, "h2", T1)]


def test_upsert_idempotent(spark):
    t = spark.createDataFrame([("a", 1, "h1", T1), ("b", 2, "h2", T1)], SCHEMA)
    s = spark.createDataFrame([("b", 5, "h5", None), ("c", 3, "h3", None)], SCHEMA)
    st = {"ts": F.lit(T2).cast("timestamp_ntz")}
    once = upsert(t, s, ["k"], ["v", "h"], guard="h", stamps=st)
    twice = upsert(once, s, ["k"], ["v", "h"], guard="h", stamps=st)
    assert rows(once) == rows(twice)  # M6


def test_surrogate_keys_stable_and_dense(spark):
    first = spark.createDataFrame([("B",), ("A",)], "nk string")
    d1 = assign_surrogate(first, "nk", "sk", num_partitions=3)
    assert rows(d1) == [("A", 1), ("B", 2)]
    second = spark.createDataFrame([(x,) for x in ["C", "A", "E", "B", "D"]], "nk string")
    d2 = assign_surrogate(second, "nk", "sk", existing=d1, num_partitions=4)
    assert rows(d2) == [("A", 1), ("B", 2), ("C", 3), ("D", 4), ("E", 5)]
    d3 = assign_surrogate(second, "nk", "sk", existing=d2, num_partitions=2)
    assert rows(d3) == rows(d2)


@pytest.mark.parametrize("n", [1, 7])
def test_surrogate_keys_many(spark, n):
    df = spark.range(1000).select(F.format_string("k%05d", "id").alias("nk"))
    out = assign_surrogate(df, "nk", "sk", num_partitions=n)
    got = rows(out)
    assert [sk for _, sk in got] == list(range(1, 1001))


def test_upsert_partitions_matches_plain_and_prunes(spark, tmp_dir):
    from martspark.operators.merge import upsert_partitions
    data = [(f"{c}{i}", c, i, f"h{i}", T1) for c in "ABC" for i in range(3)]
    path = f"{tmp_dir}/t"
    spark.createDataFrame(data, "k string, p string, v int, h string, ts timestamp_ntz") \
        .write.partitionBy("p").parquet(path)
    t = spark.read.parquet(path).select("k", "p", "v", "h", "ts")
    s = spark.createDataFrame([("A1", "A", 10, "x", None), ("A9", "A", 9, "h9", None)],
                              "k string, p string, v int, h string, ts timestamp_ntz")
    kw = dict(update_cols=["v", "h"], guard="h", stamps={"ts": F.lit(T2).cast("timestamp_ntz")})
    a = upsert_partitions(t, s, ["k"], "p", **kw)
    b = upsert(t, s, ["k"], **kw)
    assert rows(a) == rows(b) and a.count() == 10


def test_upsert_partitions_locates_moved_keys(spark, tmp_dir):
    from martspark.operators.merge import upsert_partitions
    path = f"{tmp_dir}/m"
    spark.createDataFrame([("a", "2025-11", 1), ("b", "2025-12", 2), ("c", "2025-10", 3)],
                          "k string, m string, v int").write.partitionBy("m").parquet(path)
    t = spark.read.parquet(path).select("k", "m", "v")
    s = spark.createDataFrame([("a", "2025-12", 10), ("d", "2025-12", 4)], "k string, m string, v int")
    out = upsert_partitions(t, s, ["k"], "m", locate=True, update_cols=["m", "v"])
    assert rows(out) == [("a", "2025-12", 10), ("b", "2025-12", 2), ("c", "2025-10", 3), ("d", "2025-12", 4)]


def test_insert_only_joins_keys_only(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (None, "n", 2.0)], "k int, v string, w double")
    source = spark.createDataFrame([(1, "x"), (2, "b"), (None, "y")], "k int, v string")
    out = upsert(target, source, ["k"], on_match="keep", stamps={"w": F.lit(9.0)})
    assert rows(out) == [(1, "a", 1.0), (2, "b", 9.0), (None, "n", 2.0)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "FullOuter" not in plan
