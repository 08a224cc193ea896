"""Feed readers, load context, store versions and streaming ingest."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martspark import schemas
from martspark.sources import feeds
from martspark.sources.store import TableStore
from martspark.streaming.ingest import start_feed_ingest
from tests.conftest import rows

T1 = dt.datetime(2026, 1, 20, 6)
HEADER = "ID,OrderNumber,OverallStatusName,ChannelName,ProductNumber,ProductName,Quantity,UnitPrice," \
         "PromisedDeliveryAt,Manufacturer,CreatedAt\n"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_sales_csv_edge_cases(spark, tmp_dir):
    p = write(f"{tmp_dir}/in/sales_se.csv", HEADER +
              '1,SO1,Packas,web,A,,2,100,,M,2025-12-05T10:00:00\n'
              '2,SO2,"Say ""hi""",web,B,"",1,5,,M,2025-12-05\n')
    df = feeds.stage_sales(spark, p, "SE", T1)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.ORDER_RAW_TYPED]
    got = {r.order_id: r for r in df.collect()}
    assert got["1"].product_name is None and got["2"].product_name is None  # D31: both NULL
    assert got["2"].overall_status_name == 'Say "hi"'
    assert got["1"].country == "SE" and got["1"].source_file == "sales_se.csv"
    assert got["1"].ingested_at == T1


def test_short_row_fails_in_strict_mode(spark, tmp_dir):
    p = write(f"{tmp_dir}/in/bad.csv", HEADER + "1,SO1,Packas\n")
    with pytest.raises(Exception):
        feeds.stage_sales(spark, p, "SE", T1).collect()
    lenient = feeds.stage_sales(spark, p, "SE", T1, mode="PERMISSIVE").collect()
    assert lenient[0].product_number is None


def test_multiline_quoted_value(spark, tmp_dir):
    p = write(f"{tmp_dir}/in/ml.csv", "productnumber,stocksellablestock\n\"A\nB\",5\n")
    df = feeds.read_text_csv(spark, p, schemas.STOCK_FEED, multiline=True)
    assert rows(df) == [("A\nB", "5")]


def test_skip_loaded_files_and_audit(spark, tmp_dir):
    p = write(f"{tmp_dir}/in/sales_dk.csv", HEADER + "1,SO1,Packas,web,A,x,2,100,,M,2025-12-05\n")
    ledger, staging = f"{tmp_dir}/ledger", f"{tmp_dir}/staging/order_raw"
    files = feeds.new_files(spark, ledger, "order_raw", "DK", f"{tmp_dir}/in")
    assert [f[0].rpartition("/")[2] for f in files] == ["sales_dk.csv"]
    feeds.append_staging(feeds.stage_sales(spark, [f[0] for f in files], "DK", T1), staging)
    feeds.record_files(spark, ledger, "order_raw", "DK", files)
    assert feeds.new_files(spark, ledger, "order_raw", "DK", p) == []  # D24
    assert len(feeds.new_files(spark, ledger, "order_raw", "SE", p)) == 1
    os.utime(p, (1, 1))  # delivered again under the same name
    assert len(feeds.new_files(spark, ledger, "order_raw", "DK", p)) == 1
    assert rows(feeds.load_audit(spark.read.parquet(staging))) == [("sales_dk.csv", 1)]


def test_store_versions(spark, tmp_dir):
    store = TableStore(spark, f"file://{tmp_dir}/wh")
    assert store.read("t") is None
    v1 = store.publish("t", spark.createDataFrame([(1, "a")], "k int, v string"))
    cur = store.read("t")
    v2 = store.publish("t", cur.withColumn("v", F.upper("v")).unionByName(
        spark.createDataFrame([(2, "b")], "k int, v string")), partition_by=["k"])
    assert (v1, v2, store.version("t")) == (1, 2, 2)
    assert rows(store.read("t"), "k", "v") == [(1, "A"), (2, "b")]
    assert rows(store.read("t", version=1)) == [(1, "a")]


def test_streaming_ingest_available_now(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    write(f"{landing}/a.csv", HEADER + "1,SO1,Packas,web,A,x,2,100,,M,2025-12-05\n")
    staging = f"{tmp_dir}/staging"
    q = start_feed_ingest(spark, "sales", landing, staging, "SE", f"{tmp_dir}/ckpt")
    q.awaitTermination(120)
    write(f"{landing}/b.csv", HEADER + "2,SO2,Packas,web,B,y,1,5,,M,2025-12-06\n")
    q = start_feed_ingest(spark, "sales", landing, staging, "SE", f"{tmp_dir}/ckpt")
    q.awaitTermination(120)
    got = spark.read.parquet(staging)
    assert rows(got, "order_id", "source_file") == [("1", "a.csv"), ("2", "b.csv")]


def test_lookback_filter_reaches_parquet_scan(spark, tmp_dir):
    from martspark.plans import dims, facts
    from martspark.sources import seeds
    p = write(f"{tmp_dir}/in/sales_se.csv", HEADER +
              "1,SO1,Packas,web,A,x,2,100,,M,2025-12-05T10:00:00\n"
              "2,SO2,Packas,web,B,y,1,5,,M,2025-10-01T00:00:00\n")
    staging = f"{tmp_dir}/staging/order_raw"
    feeds.append_staging(feeds.stage_sales(spark, p, "SE", T1), staging, sort_by=["created_ts"])
    raw = spark.read.parquet(staging)
    countries = spark.createDataFrame([("Sweden", "SE", "EUR")], "country_name string, country_code string, currency_code string")
    rates = dims.empty(spark, "fx_rates_monthly")
    batch, _ = facts.prepare_sales(raw, dims.conform_status_map(seeds.status_literals(spark)), countries, rates,
                                   as_of=dt.date(2026, 1, 20), run_ts=F.lit(T1).cast("timestamp_ntz"))
    assert rows(batch, "order_id") == [("1",)]
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = batch._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert "GreaterThanOrEqual(created_ts" in plan


def test_store_partition_reuse(spark, tmp_dir):
    from martspark.operators.merge import upsert_touched
    store = TableStore(spark, f"file://{tmp_dir}/wh")
    sch = "k string, m string, v int"
    first = spark.createDataFrame([("a", "2025-11", 1), ("b", "2025-12", 2), ("c", "2025-10", 3)], sch)
    store.publish_partitions("t", first, "m", ["2025-10", "2025-11", "2025-12"])
    batch = spark.createDataFrame([("a", "2025-12", 10), ("d", "2026-01", 4)], sch)
    merged, touched = upsert_touched(store.read("t"), batch, ["k"], "m", locate=True, update_cols=["m", "v"])
    assert sorted(touched) == ["2025-11", "2025-12", "2026-01"]
    store.publish_partitions("t", merged, "m", touched)
    assert rows(store.read("t")) == [("a", "2025-12", 10), ("b", "2025-12", 2), ("c", "2025-10", 3),
                                     ("d", "2026-01", 4)]
    import json
    man = json.loads(store._read_text(store._manifest_path("t", 2)))
    assert "/store_version=1-" in man["leaves"]["m=2025-10"]  # untouched: reused, not rewritten
    assert "m=2025-11" not in man["leaves"]  # emptied by the move
    assert rows(store.read("t", version=1)) == rows(first)


def test_streaming_sales_load(spark, tmp_dir):
    from martspark.plans import dims
    from martspark.sources import seeds
    from martspark.streaming.load import start_sales_load
    landing, staging = f"{tmp_dir}/landing", f"{tmp_dir}/staging"
    write(f"{landing}/a.csv", HEADER + "1,SO1,Packas,web,A,x,2,100,,M,2025-12-05T10:00:00\n"
                                       "2,SO2,Packas,web,B,y,1,5,,M,2025-12-06T00:00:00\n")
    start_feed_ingest(spark, "sales", landing, staging, "SE", f"{tmp_dir}/ck1").awaitTermination(120)
    store = TableStore(spark, f"file://{tmp_dir}/wh")
    countries = spark.createDataFrame([("Sweden", "SE", "EUR")],
                                      "country_name string, country_code string, currency_code string")
    args = (spark, staging, store, dims.conform_status_map(seeds.status_literals(spark)), countries,
            dims.empty(spark, "fx_rates_monthly"), f"{tmp_dir}/ck2")
    start_sales_load(*args).awaitTermination(180)
    assert rows(store.read("sales_current"), "order_id", "status_std") == [("1", "PROCESSING"), ("2", "PROCESSING")]
    v = store.version("sales_current")
    write(f"{landing}/b.csv", HEADER + "1,SO1,Beställning slutförd,web,A,x,2,100,,M,2025-12-05T10:00:00\n")
    start_feed_ingest(spark, "sales", landing, staging, "SE", f"{tmp_dir}/ck1").awaitTermination(120)
    start_sales_load(*args).awaitTermination(180)
    assert store.version("sales_current") == v + 1
    assert rows(store.read("sales_current"), "order_id", "status_std") == [("1", "COMPLETED"), ("2", "PROCESSING")]


def test_stock_and_product_feeds(spark, tmp_dir):
    ps = write(f"{tmp_dir}/in/stock_bg.csv", "productnumber,stocksellablestock\nA,5\n,3\n")
    st = feeds.stage_stock(spark, ps, "BG", T1)
    assert [(f.name, f.dataType) for f in st.schema] == [(f.name, f.dataType) for f in schemas.STOCK_RAW]
    assert rows(st, "country", "product_number", "sellable_stock", "source_file") == [
        ("BG", "A", "5", "stock_bg.csv"), ("BG", None, "3", "stock_bg.csv")]
    pp = write(f"{tmp_dir}/in/products.csv",
               "product_number,product_name,classification1,classification2,classification3,season,"
               "discontinued,bestseller_abas,kf,uvp_de,uvp_eu,franchise_price\n"
               'A,Chair,c1,c2,c3,SS,@,Ja,nein,"€1,234.50",9,-\n')
    pr = feeds.stage_products(spark, pp, T1)
    got = pr.first()
    assert (got.product_number, got.uvp_de, got.source_file, got.load_run_ts) == ("A", "€1,234.50", "products.csv", T1)


def test_store_vacuum_keeps_referenced_data(spark, tmp_dir):
    from martspark.operators.merge import upsert_touched
    store = TableStore(spark, f"file://{tmp_dir}/wh")
    sch = "k string, m string, v int"
    store.publish_partitions("t", spark.createDataFrame([("a", "2025-10", 1), ("b", "2025-11", 2)], sch),
                             "m", ["2025-10", "2025-11"])
    for i in range(3):  # three more versions touching only 2025-11
        batch = spark.createDataFrame([("b", "2025-11", 10 + i)], sch)
        merged, touched = upsert_touched(store.read("t"), batch, ["k"], "m", update_cols=["v"])
        store.publish_partitions("t", merged, "m", touched)
    before = rows(store.read("t"))
    deleted = store.vacuum("t", keep=1)
    assert rows(store.read("t")) == before == [("a", "2025-10", 1), ("b", "2025-11", 12)]
    assert any("store_version=3-" in d for d in deleted) and not any("m=2025-10" in d for d in deleted)
    store.publish("d", spark.createDataFrame([(1,)], "x int"))
    store.publish("d", spark.createDataFrame([(2,)], "x int"))
    gone = store.vacuum("d", keep=1)
    assert rows(store.read("d")) == [(2,)] and any("/d/v=1-" in d for d in gone)


def test_publish_partitions_retry_after_failed_attempt(spark, tmp_dir):
    store = TableStore(spark, f"file://{tmp_dir}/wh")
    sch = "k string, m string, v int"
    store.publish_partitions("t", spark.createDataFrame([("a", "2025-10", 1)], sch), "m", ["2025-10"])
    # a failed attempt at version 2 left files behind; the pointer still says 1
    spark.createDataFrame([("zombie", 99)], "k string, v int").write.parquet(
        f"{tmp_dir}/wh/t/parts/m=2025-10/store_version=2-dead")
    assert rows(store.read("t")) == [("a", "2025-10", 1)]
    store.publish_partitions("t", spark.createDataFrame([("a", "2025-10", 2)], sch), "m", ["2025-10"])
    assert rows(store.read("t")) == [("a", "2025-10", 2)]


def test_same_file_name_in_two_countries(spark, tmp_dir):
    from martspark.plans import pipeline
    for c in ("bg", "se"):
        write(f"{tmp_dir}/{c}/jan.csv", HEADER + f"1,SO{c},Packas,web,A,x,2,100,,M,2025-12-05T10:00:00\n")
    n = pipeline.stage_feeds(spark, f"{tmp_dir}/staging", T1,
                             sales={"BG": f"{tmp_dir}/bg", "SE": f"{tmp_dir}/se"})
    assert n == {"order_raw": 2}
    got = spark.read.parquet(f"{tmp_dir}/staging/order_raw")
    assert rows(got, "country", "order_number", "source_file") == [
        ("BG", "SObg", "jan.csv"), ("SE", "SOse", "jan.csv")]


def test_streams_of_two_countries_and_a_doubled_quote(spark, tmp_dir):
    staging = f"{tmp_dir}/staging"
    for c in ("BG", "SE"):
        write(f"{tmp_dir}/{c}/jan.csv", HEADER
              + f'1,SO{c},Packas,web,A,"Sofa ""Big"", blue",2,100,,M,2025-12-05T10:00:00\n')
        start_feed_ingest(spark, "sales", f"{tmp_dir}/{c}", staging, c,
                          f"{tmp_dir}/ck{c}").awaitTermination(120)
    start_feed_ingest(spark, "sales", f"{tmp_dir}/SE", staging, "SE", f"{tmp_dir}/ck_new").awaitTermination(120)
    got = spark.read.parquet(staging)
    assert rows(got, "country", "product_name") == [("BG", 'Sofa "Big", blue'), ("SE", 'Sofa "Big", blue'),
                                                    ("SE", 'Sofa "Big", blue')]


def test_store_survives_a_stop_between_the_steps(spark, tmp_dir, monkeypatch):
    store = TableStore(spark, f"file://{tmp_dir}/wh")
    one = lambda n: spark.createDataFrame([(n,)], "x int")
    store.publish("t", one(1))

    def stop(at):
        def write_text(self, path, text, overwrite, real=TableStore._write_text):
            if at in path:
                raise OSError("stopped")
            return real(self, path, text, overwrite)
        monkeypatch.setattr(TableStore, "_write_text", write_text)

    stop("_manifest")
    with pytest.raises(OSError):
        store.publish("t", one(2))
    assert (store.version("t"), rows(store.read("t"))) == (1, [(1,)])  # not committed
    monkeypatch.undo()
    stop("_CURRENT")
    with pytest.raises(OSError):
        store.publish("t", one(3))
    assert (store.version("t"), rows(store.read("t"))) == (2, [(3,)])  # committed, pointer behind
    monkeypatch.undo()
    os.remove(f"{tmp_dir}/wh/t/_CURRENT")
    assert (store.version("t"), rows(store.read("t"))) == (2, [(3,)])  # pointer lost
    assert store.publish("t", one(4)) == 3


def test_two_writers_of_a_version(spark, tmp_dir, monkeypatch):
    from martspark.sources.store import ConcurrentPublish
    store = TableStore(spark, f"file://{tmp_dir}/wh")
    store.publish("t", spark.createDataFrame([(1,)], "x int"))
    monkeypatch.setattr(TableStore, "version", lambda self, table: None)  # read before the other's commit
    with pytest.raises(ConcurrentPublish):
        store.publish("t", spark.createDataFrame([(2,)], "x int"))
    monkeypatch.undo()
    assert rows(store.read("t")) == [(1,)]


def test_partition_values_are_escaped(spark, tmp_dir):
    from martspark.operators.merge import upsert_touched
    store = TableStore(spark, f"file://{tmp_dir}/wh")
    sch = "k string, m string, v int"
    store.publish_partitions("t", spark.createDataFrame([("a", "B:G/1", 1), ("b", None, 2)], sch), "m",
                             ["B:G/1", None])
    assert rows(store.read("t")) == [("a", "B:G/1", 1), ("b", None, 2)]
    batch = spark.createDataFrame([("a", "x%y", 5)], sch)
    merged, touched = upsert_touched(store.read("t"), batch, ["k"], "m", locate=True, update_cols=["m", "v"])
    store.publish_partitions("t", merged, "m", touched)
    assert rows(store.read("t")) == [("a", "x%y", 5), ("b", None, 2)]


def test_partitioned_write_is_rebalanced(spark, tmp_dir):
    store = TableStore(spark, f"file://{tmp_dir}/wh")
    df = spark.range(4000).selectExpr("id", "CAST(id % 5 AS STRING) AS m").repartition(8)
    store.publish_partitions("t", df, "m", [])
    files = [f for _, _, names in os.walk(f"{tmp_dir}/wh/t/parts") for f in names if f.endswith(".parquet")]
    assert len(files) <= 10


def test_layers(spark, tmp_dir):
    TableStore(spark, f"file://{tmp_dir}/root").create_layers("staging", "warehouse")
    assert os.path.isdir(f"{tmp_dir}/root/staging") and os.path.isdir(f"{tmp_dir}/root/warehouse")
