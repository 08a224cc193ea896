"""Catalog tables: DDL, defaults, NOT NULL, bucketed upserts without a shuffle of the table."""

import datetime as dt
import random
import re
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martspark import schemas
from martspark.operators.merge import upsert, upsert_changed
from martspark.plans import facts
from martspark.sources import tables
from tests.conftest import rows

T1 = dt.datetime(2026, 1, 10, 8)


@pytest.fixture()
def database(spark, tmp_dir):
    name = f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION 'file://{tmp_dir}/{name}'")
    return name


def test_create_tables(spark, database):
    names = tables.create_tables(spark, database, database, buckets=4)
    assert tables.create_tables(spark, database, database, buckets=4) == names  # existing ones stay
    assert len(names) == len(schemas.STAGING) + len(schemas.WAREHOUSE)
    for name in names:
        table = name.partition(".")[2]
        assert [(f.name, f.dataType) for f in spark.table(name).schema] == [
            (f.name, f.dataType) for f in tables.table_schema(table)]
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {database}.sales_current").collect()}
    assert info["Num Buckets"] == "4" and info["Bucket Columns"] == "[`business_key_hash`]"


def test_insert_takes_defaults_and_refuses_nulls(spark, database):
    tables.create_tables(spark, database, database, buckets=2)
    stock = f"{database}.stock_raw"
    tables.insert(spark, "stock_raw", stock, spark.createDataFrame([("SE", "A")], "country string, product_number string"))
    got = spark.table(stock).collect()
    assert [(r.country, r.sellable_stock) for r in got] == [("SE", None)]
    assert abs(got[0].ingested_at - spark.sql("SELECT localtimestamp()").first()[0]) < dt.timedelta(hours=1)
    tables.insert(spark, "stock_raw", stock, spark.createDataFrame([("SE", "B", T1)], "country string, product_number string, ingested_at timestamp_ntz"))
    assert rows(spark.table(stock).where("product_number = 'B'"), "ingested_at") == [(T1,)]
    with pytest.raises(Exception, match="ingested_at, which is NOT NULL"):  # an explicit NULL is no default
        tables.insert(spark, "stock_raw", stock, spark.createDataFrame(
            [("SE", "C", None)], "country string, product_number string, ingested_at timestamp_ntz"))
    rates = f"{database}.fx_rates_monthly"
    one = [(dt.date(2026, 1, 1), "SEK", Decimal("0.1"), 3)]
    sch = "month_sk date, currency_code string, avg_rate_to_eur decimal(18,8), obs_count int"
    tables.insert(spark, "fx_rates_monthly", rates, spark.createDataFrame(one, sch))
    assert spark.table(rates).first().source == "frankfurter/ecb"
    with pytest.raises(Exception, match="currency_code, which is NOT NULL"):
        tables.insert(spark, "fx_rates_monthly", rates, spark.createDataFrame([(one[0][0], None, *one[0][2:])] + one, sch))
    assert spark.table(rates).count() == 1 and spark.table(stock).count() == 2  # refused writes add nothing
    # the plain SQL form knows the defaults too
    spark.sql(f"INSERT INTO {stock} (country, product_number) VALUES ('DK', 'Z')")
    assert spark.table(stock).where("country = 'DK' AND ingested_at IS NOT NULL").count() == 1


def sales(spark, data):
    full = [dict(business_key_hash=k, change_hash=h, country_code="SE", order_id=k, product_number="A",
                 created_at=dt.datetime(2026, m, 3), last_ingested_at=T1, raw_status=s) for k, h, m, s in data]
    df = spark.createDataFrame([tuple(r.get(f.name) for f in schemas.SALES_CURRENT.fields) for r in full],
                               schemas.SALES_CURRENT)
    return facts.with_created_month(df)


def test_bucketed_upsert_equals_upsert(spark, database):
    rng = random.Random(4)
    name = f"{database}.sales_current"
    tables.create_tables(spark, database, database, buckets=4)
    first = sales(spark, [(f"k{i}", f"h{i % 4}", 1 + i % 5, "old") for i in range(60)])
    tables.insert(spark, "sales_current", name, first)
    # months change, stay, and the last row of May leaves it
    batch = sales(spark, [(f"k{i}", f"h{rng.randrange(4)}", 1 + rng.randrange(4), "new") for i in range(40, 80)]
                  + [(f"k{i}", "moved", 1, "new") for i in range(4, 40, 5)])
    cols = tables.table_schema("sales_current").fieldNames()
    args = dict(update_cols=facts.SALES_UPDATE_COLS + ["created_month"],
                stamps={"last_ingested_at": F.lit(dt.datetime(2026, 2, 2)).cast("timestamp_ntz")})
    want = rows(upsert(first, batch, ["business_key_hash"], guard="change_hash", **args), *cols)
    got = tables.upsert_table(spark, "sales_current", name, batch, "change_hash", **args)
    assert rows(spark.table(name), *cols) == want
    assert sum(got.counts.values()) == batch.count() and got.counts["unchanged"] > 0
    again = tables.upsert_table(spark, "sales_current", name, batch, "change_hash", **args)
    assert (again.values, again.counts["unchanged"]) == ([], batch.count())
    assert rows(spark.table(name), *cols) == want


def test_an_upsert_counts_no_aggregate_per_partition(spark, database, monkeypatch):
    name = f"{database}.sales_current"
    tables.create_tables(spark, database, database, buckets=2)
    tables.insert(spark, "sales_current", name, sales(spark, [(f"k{i}", "h", i, "old") for i in range(1, 13)]))
    batch = sales(spark, [(f"k{i}", "x", i // 2 + 1, "new") for i in range(1, 13)])  # months 8 to 12 are left
    frame, metrics = type(batch), []
    observe = frame.observe
    monkeypatch.setattr(frame, "observe", lambda self, o, *e: metrics.append(len(e)) or observe(self, o, *e))
    got = tables.upsert_table(spark, "sales_current", name, batch, "change_hash",
                              update_cols=facts.SALES_UPDATE_COLS + ["created_month"])
    assert len(got.values) == 12 and max(metrics) <= 3
    assert rows(spark.table(name), "created_month") == sorted((dt.date(2026, i // 2 + 1, 1),) for i in range(1, 13))
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 7


def test_the_stored_side_is_not_shuffled(spark, database):
    name = f"{database}.sales_current"
    tables.create_tables(spark, database, database, buckets=8)
    tables.insert(spark, "sales_current", name, sales(spark, [(f"k{i}", "h", 1 + i % 3, "old") for i in range(50)]))
    batch = sales(spark, [("k1", "x", 2, "new"), ("k99", "y", 2, "new")])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a batch too large to broadcast
    try:
        changes = upsert_changed(spark.table(name), batch, ["business_key_hash"], "created_month", "change_hash",
                                 null_safe=False, update_cols=["change_hash", "created_month"])
        plan = changes.merged._jdf.queryExecution().executedPlan().toString()
        merged = changes.merged.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert merged > 2 and "Bucketed: true" in plan
    # the one exchange stands over the batch: no scan of the table lies below it
    lines = plan.splitlines()
    depth = lambda s: len(re.match(r"[\s:+\-|]*", s).group())
    exchanges = [i for i, s in enumerate(lines) if "Exchange" in s]
    assert len(exchanges) == 1
    for i in exchanges:
        below = []
        for s in lines[i + 1:]:
            if depth(s) <= depth(lines[i]):
                break
            below.append(s)
        assert not any("FileScan" in s for s in below)
    # the comparison of keys and guards reads the buckets in place as well
    held = spark.table(name).groupBy("business_key_hash").agg(F.min("change_hash"))
    assert "Exchange" not in held._jdf.queryExecution().executedPlan().toString()
