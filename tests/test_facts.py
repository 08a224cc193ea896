"""Sales, stock and product loads on the FIXTURES.md sample rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martspark import schemas
from martspark.plans import dims, facts
from martspark.sources import seeds
from tests.conftest import rows

T1, T2 = dt.datetime(2026, 1, 10, 8), dt.datetime(2026, 1, 11, 8)
RUN_TS = dt.datetime(2026, 1, 20, 6)


def run_col():
    return F.lit(RUN_TS).cast("timestamp_ntz")


AS_OF = dt.date(2026, 1, 20)

ORDER_ROWS = [
    # country, order, product, name, status, qty, price, promised, created_at, ingested_at
    ("SE", "1", "A", "Chair", "Packas", "2", "100", "2026-01-10", "2025-12-05T10:00:00", T1),
    ("SE", "1", "A", "Chair", "Beställning slutförd", "2", "100", "2026-01-10", "2025-12-05T10:00:00", T2),
    ("SE", "2", "A", "Delivery Fee", "Packas", "1", "49", None, "2025-12-05", T1),
    ("SE", "3", "A", None, "Packas", "1", "49", None, "2025-12-05", T1),
    ("SE", "4", "B", "Lamp", "Packas", "1", "50", "N/A", "2025-11-30T23:59:59", T1),
    ("SE", "5", "B", "Lamp", "Packas", "1", "50", "N/A", "2025-12-01T00:00:00", T1),
    ("SE", "6", "B", "Lamp", "Packas", "1", "50", None, "N/A", T1),
    ("DK", "7", "B", "Lamp", "Zwrot  ", "1", "50", None, "2026-01-02", T1),
    ("FI", "8", "C", "Rug", "something new", "1.005", "3", None, "2026-01-02", T1),
    ("FI", "9", "C", "Rug", "Packas", "1,5", "3", None, "2026-01-02", T1),
    ("FI", "10", "C", "Rug", "Zamówienie zakończone", "1", "3", None, "2026-01-02", T1),
    (None, "11", "C", "Rug", "Packas", "1", "3", None, "2026-01-02", T1),
]


def order_raw(spark, data=ORDER_ROWS):
    full = [(c, o, "SO" + o, st, "web", p, n, q, pr, prom, "M", cr, "f.csv", ts)
            for c, o, p, n, st, q, pr, prom, cr, ts in data]
    return spark.createDataFrame(full, schemas.ORDER_RAW)


def lookups(spark):
    countries = spark.createDataFrame([("Sweden", "SE", "SEK"), ("Denmark", "DK", "DKK"), ("Finland", "FI", "EUR")],
                                      "country_name string, country_code string, currency_code string")
    rates = spark.createDataFrame([(dt.date(2025, 12, 1), "SEK", Decimal("0.09"), 20, "x"),
                                   (dt.date(2026, 1, 1), "EUR", Decimal("1"), 1, "x")],
                                  schemas.FX_RATES_MONTHLY)
    return dims.conform_status_map(seeds.status_literals(spark)), countries, rates


def load(spark, raw):
    m, c, r = lookups(spark)
    batch, rejects = facts.prepare_sales(raw, m, c, r, as_of=AS_OF, run_ts=run_col())
    return facts.upsert_sales(facts.empty_sales(spark), batch, run_col()), rejects


def test_sales_fixture(spark):
    cur, rejects = load(spark, order_raw(spark))
    got = {r.order_id: r for r in cur.collect()}
    assert sorted(got) == ["1", "10", "11", "5", "7", "8"]  # a blank key is loaded for Q4.2
    assert got["11"].country_code is None
    r1 = got["1"]
    assert (r1.unit_price, r1.order_value, r1.status_std) == (Decimal("9.0000"), Decimal("18.0000"), "COMPLETED")
    assert got["5"].promised_delivery_at is None  # C2: 'N/A' -> NULL
    assert got["7"].fx_missing and got["7"].unit_price == Decimal("50.0000") and got["7"].status_std == "RETURN"
    assert got["8"].status_std is None and got["8"].quantity == Decimal("1.0050")
    assert got["10"].status_std == "COMPLETED"  # D6
    assert got["10"].fx_missing is False  # FI -> EUR rate 1
    reasons = dict(rows(rejects.groupBy("_reject").count()))
    assert reasons == {"created_at N/A": 1, "quantity not numeric": 1, "product_name NULL": 1}


def test_second_load_guard(spark):
    cur, _ = load(spark, order_raw(spark))
    m, c, r = lookups(spark)
    second = [
        ("SE", "1", "A", "Chair", "Beställning slutförd", "2", "100", "2026-01-10", "2025-12-05T10:00:00", T2),  # a
        ("SE", "5", "B", "Lamp", "Packas", "3", "50", "N/A", "2025-12-01T00:00:00", T2),  # b: qty 2->3 style change
        ("FI", "10", "C", "Rug", "Zamówienie zakończone", "1", "3", None, "2026-01-02", T2),  # c-like: same hash
        ("FI", "10", "D", "Rug", "Packas", "1", "3", None, "2026-01-02", T2),  # e: new product same order
    ]
    raw2 = order_raw(spark, second).withColumn("channel_name", F.lit("shop"))  # c: channel only
    run2 = F.lit(dt.datetime(2026, 1, 21)).cast("timestamp_ntz")
    b2, _ = facts.prepare_sales(raw2, m, c, r, as_of=AS_OF, run_ts=run2)
    after = facts.upsert_sales(cur, b2, run2, with_action=True)
    act = {(x.order_id, x.product_number): (x._action, x.last_ingested_at, x.channel_name)
           for x in after.collect()}
    assert act[("1", "A")][0] == "unchanged" and act[("1", "A")][2] == "web"
    assert act[("5", "B")][0] == "update" and act[("5", "B")][1] == dt.datetime(2026, 1, 21)
    assert act[("10", "C")][0] == "unchanged"
    assert act[("10", "D")][0] == "insert"
    again = facts.upsert_sales(after.drop("_action"), b2, run2)
    assert rows(again) == rows(after.drop("_action"))  # f: run twice, nothing changes


def test_stock_fixture(spark):
    data = [("BG", "A", "5", "s.csv", T1), ("BG", "A", "-2", "s.csv", T2), ("BG", " ", "1", "s.csv", T1),
            ("BG", "", "1", "s.csv", T1), (None, "B", "1", "s.csv", T1), ("BG", "C", "", "s.csv", T1)]
    raw = spark.createDataFrame(data, schemas.STOCK_RAW)
    batch, rejects = facts.prepare_stock(raw, AS_OF)
    snap = facts.upsert_stock(dims.empty(spark, "stock_snapshot"), batch, run_col())
    got = rows(snap, "snapshot_month", "country_code", "product_number", "sellable_stock")
    m = dt.date(2026, 1, 1)
    assert got == [(m, "BG", " ", Decimal("1.0000")), (m, "BG", "A", Decimal("-2.0000")), (m, "BG", "C", None)]
    assert rejects.count() == 1  # D14


def test_product_fixture_and_stable_keys(spark):
    t1, t2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    cols = ["product_number", "discontinued", "bestseller_abas", "kf", "uvp_de", "load_run_ts"]
    data = [("A", "@", "Ja", "nein", "€1,234.50", t1), (" A", "Active", "no", "x", "-", t2),
            ("B", None, " ", None, "1.005", t1), ("C", "yes", "1", "0", "", t1), ("C", "no", "1", "0", "9", None),
            ("  ", "yes", "1", "0", "9", t1)]
    full = [(pn, "name", "c1", "c2", "c3", "s", d, b, k, u, "1", "2", "p.csv", ts) for pn, d, b, k, u, ts in data]
    raw = spark.createDataFrame(full, schemas.PRODUCT_RAW)
    d1 = dims.load_dim_product(raw, dims.empty(spark, "dim_product"), run_col())
    got = {r.product_number: r for r in d1.collect()}
    assert sorted(got) == ["A", "B", "C"]
    assert (got["A"].discontinued, got["A"].bestseller_abas, got["A"].kf, got["A"].uvp_de) == (False, False, None, None)
    assert (got["B"].discontinued, got["B"].bestseller_abas, got["B"].uvp_de) == (None, None, Decimal("1.01"))
    assert (got["C"].discontinued, got["C"].uvp_de) == (False, Decimal("9.00"))  # D8: NULL time wins
    more = spark.createDataFrame([("D", "name", "c1", "c2", "c3", "s", "y", "y", "y", "1", "1", "1", "p.csv", t2)],
                                 schemas.PRODUCT_RAW)
    d2 = dims.load_dim_product(raw.unionByName(more), d1, run_col())
    sk1 = dict(rows(d1, "product_number", "product_sk"))
    sk2 = dict(rows(d2, "product_number", "product_sk"))
    assert all(sk2[k] == v for k, v in sk1.items()) and sk2["D"] == 4
    assert d2.count() == 4


def test_dim_country_and_date(spark):
    c = dims.load_dim_country(seeds.countries(spark), dims.empty(spark, "dim_country"))
    assert c.count() == 14 and c.select("country_sk").distinct().count() == 14
    again = dims.load_dim_country(seeds.countries(spark), c)
    assert rows(again) == rows(c)
    d = dims.load_dim_date(spark, dt.date(2023, 1, 1), dt.date(2026, 12, 31), dims.empty(spark, "dim_date"))
    assert d.count() == 1461
    assert rows(d.where("date_sk = date'2024-02-29'"), "year", "quarter", "month_number", "year_month") == [
        (2024, 1, 2, "2024-02")]


def test_duplicate_country_code_does_not_fan_out(spark):
    m, c, r = lookups(spark)
    c2 = c.unionByName(spark.createDataFrame([("Sverige", "SE", "SEK")], c.schema))
    batch, _ = facts.prepare_sales(order_raw(spark), m, c2, r, as_of=AS_OF, run_ts=run_col())
    assert batch.count() == 6  # D5: one row per key despite two SE rows
    assert rows(facts.dim_country_code_check(c2), "value", "passed") == [(1, False)]


def test_change_columns_are_an_argument(spark):
    m, c, r = lookups(spark)
    raw = order_raw(spark)
    a, _ = facts.prepare_sales(raw, m, c, r, as_of=AS_OF, run_ts=run_col())
    b, _ = facts.prepare_sales(raw.withColumn("channel_name", F.lit("shop")), m, c, r, as_of=AS_OF,
                               run_ts=run_col(), change_cols=facts.CHANGE_COLS + ["channel_name"])
    ha = dict(rows(a, "order_id", "change_hash"))
    hb = dict(rows(b, "order_id", "change_hash"))
    assert all(ha[k] != hb[k] for k in ha)  # D12: tracking the channel changes the hash


def test_order_value_refreshed_on_update(spark):
    cur, _ = load(spark, order_raw(spark))
    m, c, r = lookups(spark)
    row5 = [("SE", "5", "B", "Lamp", "Packas", "4", "50", "N/A", "2025-12-01T00:00:00", T2)]
    b2, _ = facts.prepare_sales(order_raw(spark, row5), m, c, r, as_of=AS_OF, run_ts=run_col())
    after = {x.order_id: x for x in facts.upsert_sales(cur, b2, run_col()).collect()}
    assert after["5"].order_value == Decimal("18.0000")  # D2: 4 x 50 x 0.09


def test_hot_business_key_in_sales_batch(spark):
    # one order line re-delivered as a third of the batch; the latest delivery wins
    hot = [("SE", "1", "A", "Chair", "Packas", str(i % 5 + 1), "100", None, "2025-12-05T10:00:00",
            dt.datetime(2026, 1, 1) + dt.timedelta(minutes=i)) for i in range(300)]
    cold = [("SE", str(100 + i), "B", "Lamp", "Packas", "1", "50", None, "2025-12-06T00:00:00", T1)
            for i in range(600)]
    m, c, r = lookups(spark)
    batch, rejects = facts.prepare_sales(order_raw(spark, hot + cold).repartition(7), m, c, r, as_of=AS_OF,
                                         run_ts=run_col())
    got = {x.order_id: x for x in batch.collect()}
    assert len(got) == 601 and rejects.count() == 0
    assert got["1"].quantity == Decimal("5.0000")  # i = 299 -> 299 % 5 + 1
    assert "WindowGroupLimit" in batch._jdf.queryExecution().executedPlan().toString()


def test_stock_window_month_reads_only_run_month(spark):
    data = [("BG", "A", "5", "s.csv", dt.datetime(2025, 12, 30)), ("BG", "B", "7", "s.csv", dt.datetime(2026, 1, 3))]
    raw = spark.createDataFrame(data, schemas.STOCK_RAW)
    all_hist, _ = facts.prepare_stock(raw, AS_OF)
    month, _ = facts.prepare_stock(raw, AS_OF, window="month")
    assert rows(all_hist, "product_number") == [("A",), ("B",)]  # D13 parity: all staging history
    assert rows(month, "product_number") == [("B",)]  # only lines ingested in January 2026


def test_out_of_range_amounts_are_rejected_not_fatal(spark):
    ok = ("SE", "1", "A", "Chair", "Packas", "20000000000", "0.5", None, "2025-12-05T10:00:00", T1)
    cases = [ok,
             ("SE", "2", "A", "Chair", "Packas", "5000000000", "5000000000", None, "2025-12-05T10:00:00", T1),
             ("SE", "3", "A", "Chair", "Packas", "99999999999999999999", "1", None, "2025-12-05T10:00:00", T1),
             ("SE", "4", "A", "Chair", "Packas", "1", "1", "32.13.2026", "2025-12-05T10:00:00", T1),
             ("NO", "5", "A", "Chair", "Packas", "2", "0.12345678", None, "2025-12-05T10:00:00", T1)]
    m, c, _ = lookups(spark)
    c = c.union(spark.createDataFrame([("Norway", "NO", "NOK")], c.schema))
    rates = spark.createDataFrame([(dt.date(2025, 12, 1), "SEK", Decimal("1"), 20, "x"),
                                   (dt.date(2025, 12, 1), "NOK", Decimal("12000"), 20, "x")],
                                  "month_sk date, currency_code string, avg_rate_to_eur decimal(20,8),"
                                  " obs_count int, source string")
    batch, rejects = facts.prepare_sales(order_raw(spark, cases), m, c, rates, as_of=AS_OF, run_ts=run_col())
    got = {r.order_id: (r.quantity, r.unit_price, r.order_value) for r in batch.collect()}
    assert got == {"1": (Decimal("20000000000.0000"), Decimal("0.5000"), Decimal("10000000000.0000")),
                   "5": (Decimal("2.0000"), Decimal("1481.4814"), Decimal("2962.9627"))}
    assert rows(rejects, "order_id", "_reject") == [
        ("2", "amount out of range"), ("3", "quantity not numeric"), ("4", "promised_delivery_at not a date")]


def test_rejects_outside_the_window_do_not_block(spark):
    old = ("SE", "1", "A", "Chair", "Packas", "x", "1", None, "2020-01-01", dt.datetime(2020, 1, 2))
    new = ("SE", "2", "A", "Chair", "Packas", "x", "1", None, "2025-12-05", T1)
    raw = order_raw(spark, [old, new])
    assert facts.sales_rejects(raw).count() == 2
    assert rows(facts.sales_rejects(raw, AS_OF), "order_id") == [("2",)]


def test_large_lookups_are_not_broadcast(spark, monkeypatch):
    m, c, r = lookups(spark)
    args = dict(as_of=AS_OF, run_ts=run_col())
    want = rows(facts.prepare_sales(order_raw(spark), m, c, r, **args)[0])
    monkeypatch.setattr(facts, "MAX_LOOKUP", 1)  # every lookup is too large
    batch, rejects = facts.prepare_sales(order_raw(spark), m, c, r, once=True, **args)
    assert rows(batch) == want and rejects.count() == 3
