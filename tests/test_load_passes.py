"""Passes that a load does not make: what they gave comes with the others."""

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from martspark.functions.clean import parse_timestamp
from martspark.operators import merge, profile
from martspark.plans import dims, facts
from martspark.session import materialize, release
from martspark.sources import seeds
from tests.conftest import rows
from tests.test_facts import order_raw
from tests.test_stream_audit import BATCHES


def test_lines_are_counted_as_the_rejects_are_found(spark):
    countries = spark.createDataFrame([("Sweden", "SE", "EUR")],
                                      "country_name string, country_code string, currency_code string")
    raw = order_raw(spark, BATCHES[0]).withColumn("created_ts", parse_timestamp("created_at"))
    args = (raw, dims.conform_status_map(seeds.status_literals(spark)), countries,
            dims.empty(spark, "fx_rates_monthly"), dt.date(2026, 1, 20))
    lines = Observation()
    batch, rejects = facts.prepare_sales(*args, once=True, lines=lines)
    got = rows(rejects)
    assert facts.line_counts(lines) == {"lines": 10, "service": 1, "outside": 1, "rejected": 3, "kept": 5}
    assert got == rows(facts.prepare_sales(*args)[1])
    release(batch)


def test_keys_that_no_partition_holds_are_not_compared(spark, monkeypatch):
    schema = "k string, m string, h string, v int"
    target = spark.createDataFrame([("a", "01", "h0", 1), ("b", "02", "h0", 2)], schema)
    batch = materialize(spark.createDataFrame([("c", "02", "h1", 3), ("d", None, "h1", 4), ("e", None, "h1", 5)], schema))
    args = dict(update_cols=["m", "h", "v"], guard="h")
    want = merge.upsert(target, batch, ["k"], with_action=True, **args)

    def refused(df):
        raise AssertionError("nothing needs to be written to tell inserted rows")

    monkeypatch.setattr(merge, "materialize", refused)
    c = merge.upsert_changed(target, batch, ["k"], "m", candidates=[], stored=True, **args)
    assert c.counts == {"insert": 3, "update": 0, "unchanged": 0} and set(c.values) == {"02", None}
    assert rows(c.merged) == rows(want.where(F.col("k") != "a"))
    release(c.changed)  # deletes nothing of the batch
    assert batch.count() == 3
    none = merge.upsert_changed(target, batch.limit(0), ["k"], "m", candidates=[], stored=True, **args)
    assert none.values == [] and none.counts["insert"] == 0 and none.merged.count() == 0
    release(batch)


def test_wide_key_positions_are_not_shuffled(spark):
    table = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2"), ("b", None)], "k string, m string")
    got = profile.key_positions(table, "m", ["k"])
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(got.select("m").distinct().collect(), key=str) == sorted(table.select("m").distinct().collect(), key=str)
    batch = spark.createDataFrame([("a",)], "k string")
    assert profile.may_hold(got, "m", batch, ["k"]) == ["1"]
