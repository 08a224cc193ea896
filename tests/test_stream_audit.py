"""Every line of every micro-batch is accounted for."""

import datetime as dt

from martspark.plans import dims
from martspark.sources import seeds
from martspark.sources.store import TableStore
from martspark.streaming.load import AUDIT, start_sales_load
from tests.conftest import rows
from tests.test_facts import order_raw

T1, T2 = dt.datetime(2026, 1, 10, 8), dt.datetime(2026, 1, 11, 8)


def line(order, status="Packas", qty="2", price="100", name="Chair", created="2025-12-05T10:00:00", at=T1):
    return ("SE", order, "A", name, status, qty, price, None, created, at)


BATCHES = [
    [line("1"), line("1", "Zwrot", at=T2), line("1", at=T1), line("2"), line("3", name="Delivery Fee"),
     line("4", name=None), line("5", created="N/A"), line("6", qty="1,5"), line("7", created="2024-01-01"),
     line("8", qty="99999999999", price="99999999999")],
    [line("1", "Zwrot", at=T2), line("2", "Zwrot", at=T2), line("9"), line("9")],
    [line("3", name="Delivery Fee")],
]


def test_lines_of_every_batch_are_accounted_for(spark, tmp_dir):
    staging = f"{tmp_dir}/staging"
    store = TableStore(spark, f"file://{tmp_dir}/wh")
    countries = spark.createDataFrame([("Sweden", "SE", "EUR")],
                                      "country_name string, country_code string, currency_code string")
    got = []
    for i, batch in enumerate(BATCHES):
        from pyspark.sql import functions as F
        from martspark.functions.clean import parse_timestamp
        df = order_raw(spark, batch).withColumn("created_ts", parse_timestamp("created_at"))
        df.coalesce(1).write.mode("append").parquet(staging)
        start_sales_load(spark, staging, store, dims.conform_status_map(seeds.status_literals(spark)), countries,
                         dims.empty(spark, "fx_rates_monthly"), f"{tmp_dir}/ck",
                         as_of=dt.date(2026, 1, 20)).awaitTermination(300)
        audit = spark.read.parquet(f"{tmp_dir}/wh/stream_audit").where(F.col("load_batch") == i)
        got.append(rows(audit, *AUDIT)[0])
    #              lines service outside rejected superseded inserted updated unchanged
    assert got == [(10, 1, 1, 4, 2, 2, 0, 0), (4, 0, 0, 0, 1, 1, 1, 1), (1, 1, 0, 0, 0, 0, 0, 0)]
    for row in got:
        assert row[0] == sum(row[1:])
    bad = spark.read.parquet(f"{tmp_dir}/wh/stream_rejects")
    assert rows(bad.where("load_batch = 0"), "order_id", "_reject") == [
        ("4", "product_name NULL"), ("5", "created_at N/A"), ("6", "quantity not numeric"), ("8", "amount out of range")]
    assert bad.where("load_batch > 0").count() == 0
    assert store.version("sales_current") == 2  # the third batch changed nothing
    assert rows(store.read("sales_current"), "order_id", "status_std") == [
        ("1", "RETURN"), ("2", "RETURN"), ("9", "PROCESSING")]
