"""Driver queries of the load operators (the check queries are in ``checks``).

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from
the library's operators over whole driver tables.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.functions.amounts import exact_product
from martspark.functions.clean import (BESTSELLER_FLAGS, DISCONTINUED_FLAGS, KF_FLAGS,
                                       blank_to_null, empty_to_null, normalize_code, parse_flag,
                                       parse_money, sentinel_to_null)
from martspark.functions.dates import first_day_of_month, last_day_of_month, months_back
from martspark.functions.keys import hash_key
from martspark.operators import fx
from martspark.operators.dedup import keep_first, latest_per_key, priority_rank
from martspark.operators.merge import upsert
from martspark.operators.series import calendar as calendar_attrs
from martspark.operators.series import date_series_between, last_n_months, month_series_between
from martspark.operators.surrogate import assign_surrogate
from martspark import schemas
from martspark.plans import dims, driver, facts, pipeline
from martspark.plans.driver import AS_OF, RUN_TS, lazy_plan, read, ts
from martspark.sources import feeds, seeds

# Run parameters used by individual queries (fixed, never the clock).
FX_CHECK_AS_OF = dt.date(2001, 10, 15)
FX_CHECK_MONTHS = 6
LOAD1_CUTOFF = dt.datetime(2000, 1, 1)
LOAD2_CREATED_FROM = "1999-07-01"
RUN1_TS = dt.datetime(2026, 1, 13, 6, 0, 0)
SUPPORTED_PRIMARY = ["AFR", "AME", "ASI"]


# --------------------------------------------------------------- shared parts
def status_map(spark: SparkSession) -> DataFrame:
    return dims.conform_status_map(seeds.status_literals(spark))


@lazy_plan
def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates, _ = fx.monthly_rates(driver.quotes_from_orders(spark, sf_dir),
                                driver.dim_country(spark, sf_dir))
    return rates


def sales_batch(spark, sf_dir, raw=None, as_of=None, run_ts=RUN_TS, once=False):
    raw = raw if raw is not None else driver.order_raw(spark, sf_dir)
    rows, rejects = facts.prepare_sales(raw, status_map(spark), driver.dim_country(spark, sf_dir),
                                        fx_rates(spark, sf_dir), as_of=as_of, run_ts=ts(run_ts),
                                        once=once)
    return rows, rejects


@lazy_plan
def sales_current(spark, sf_dir) -> DataFrame:
    rows, _ = sales_batch(spark, sf_dir)
    return facts.upsert_sales(facts.empty_sales(spark), rows, ts(RUN_TS))


@lazy_plan
def stock_current(spark, sf_dir) -> DataFrame:
    batch, _ = facts.prepare_stock(driver.stock_raw(spark, sf_dir), AS_OF)
    return facts.upsert_stock(dims.empty(spark, "stock_snapshot"), batch, ts(RUN_TS))


def dim_product_run1(spark, sf_dir) -> DataFrame:
    return dims.load_dim_product(driver.product_raw(spark, sf_dir, load=1),
                                 dims.empty(spark, "dim_product"), ts(driver.PRODUCT_LOAD_1))


def dim_product_run2(spark, sf_dir) -> DataFrame:
    return dims.load_dim_product(driver.product_raw(spark, sf_dir),
                                 dim_product_run1(spark, sf_dir), ts(RUN_TS))


@lazy_plan
def order_dates(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("lo"),
                                             F.max("o_orderdate").alias("hi"))


# ------------------------------------------------------------------ queries
def stage_orders(spark, sf_dir):
    """The staging projection of the sales feed."""
    return driver.order_raw(spark, sf_dir)


def staged_feed(spark, sf_dir) -> DataFrame:
    """The sales feed as CSV text, parsed and staged like a delivered file."""
    raw = driver.order_raw(spark, sf_dir)

    def quoted(c):
        return F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')),
                        F.lit('"'))
    line = F.concat_ws(",", *[quoted(c) for c in schemas.SALES_RENAMES.values()])
    parsed = raw.select(F.from_csv(line, schemas.SALES_FEED.simpleString()[len("struct<"):-1]
                                   .replace(":", " "), {"quote": '"', "escape": '"', "mode": "FAILFAST"})
                        .alias("r"), F.col("source_file").alias("_file"), F.col("ingested_at").alias("_at"))
    renamed = feeds.rename_columns(parsed.select("r.*", "_file", "_at"),
                                   {**schemas.SALES_RENAMES, "_file": "_file", "_at": "_at"})
    return feeds.with_load_context(renamed, F.col("_at"), source_file=F.col("_file")).drop("_file", "_at")


def stage_feed_text(spark, sf_dir):
    """Feed text through the CSV parser, renamed and stamped."""
    return staged_feed(spark, sf_dir)


def load_audit_by_source(spark, sf_dir):
    """Rows per source file of the staged feed."""
    return feeds.load_audit(staged_feed(spark, sf_dir))


def rate_payloads(spark, sf_dir) -> DataFrame:
    """Daily quotes as landed JSON payloads, one per month; of a day's quotes the highest counts."""
    q = (driver.quotes_from_orders(spark, sf_dir).groupBy("rate_date", "currency_code")
         .agg(F.max("rate").cast("double").alias("rate")))
    day = q.groupBy("rate_date").agg(F.map_from_entries(F.collect_list(
        F.struct("currency_code", "rate"))).alias("quotes"))
    month = day.groupBy(F.trunc("rate_date", "month").alias("m")).agg(F.map_from_entries(F.collect_list(
        F.struct(F.col("rate_date").cast("string").alias("d"), "quotes"))).alias("rates"))
    return month.select(F.to_json(F.struct(F.lit("EUR").alias("base"), "rates")).alias("payload")).select(
        F.from_json("payload", schemas.RATE_PAYLOAD, {"mode": "FAILFAST"}).alias("p")).select("p.*")


def fx_payload_coverage(spark, sf_dir):
    """Landed payloads to monthly rates, and the months they cover."""
    quotes = fx.explode_rate_payload(rate_payloads(spark, sf_dir))
    rates, _ = fx.monthly_rates(quotes, driver.dim_country(spark, sf_dir))
    return fx.coverage_report(last_n_months(spark, FX_CHECK_AS_OF, 12), rates)


def conformed_statuses(spark, sf_dir):
    """The conformance map, for every raw status the feed delivers."""
    raw = driver.order_raw(spark, sf_dir).select(F.trim("overall_status_name").alias("raw_status")).distinct()
    return raw.join(dims.conform_status_map(seeds.status_literals(spark)), "raw_status", "left")


def code_hygiene(spark, sf_dir):
    """Country codes cleaned, with the edges of each order's month."""
    o = read(spark, sf_dir, "orders").join(
        read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    code = F.when(F.col("c_nationkey") % 5 == 0, F.lit(" po ")).when(F.col("c_nationkey") % 5 == 1, F.lit(" "))
    code = code.otherwise(F.concat(F.lit(" n"), F.col("c_nationkey").cast("string")))
    day = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", normalize_code(code, seeds.COUNTRY_ALIASES).alias("code"),
                    first_day_of_month(day).alias("first_day"), last_day_of_month(day).alias("last_day"),
                    months_back(day, 3).alias("three_months_before"))


def clean_text_nulls(spark, sf_dir):
    """Blank / sentinel / empty text to NULL."""
    p = read(spark, sf_dir, "part")
    raw = (F.when(F.col("p_size") <= 3, F.lit("   ")).when(F.col("p_size") >= 48, F.lit(" N/A "))
            .otherwise(F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))))
    brand = F.when(F.col("p_size") == 2, F.lit("")).otherwise(F.col("p_brand"))
    t = p.select("p_partkey", raw.alias("raw_name"), brand.alias("raw_brand"))
    return t.select("p_partkey", "raw_name",
                    blank_to_null("raw_name").alias("name_blank_null"),
                    sentinel_to_null("raw_name", ("", "N/A")).alias("name_sentinel_null"),
                    empty_to_null("raw_brand").alias("brand_empty_null"))


def parse_flags(spark, sf_dir):
    """C4, C4a-c: multilingual flags to booleans."""
    lab = read(spark, sf_dir, "labels")
    txt = (F.when((F.col("quality") == 1) & (F.col("toxic") == 1), F.lit("@"))
            .when(F.col("quality") == 1, F.lit(" YES"))
            .when(F.col("toxic") == 1, F.lit("Active"))
            .otherwise(F.lit("nein")))
    t = lab.select("doc_id", txt.alias("flag_text"))
    return t.select("doc_id", "flag_text",
                     parse_flag("flag_text", *DISCONTINUED_FLAGS).alias("discontinued"),
                     parse_flag("flag_text", *BESTSELLER_FLAGS).alias("bestseller_abas"),
                     parse_flag("flag_text", *KF_FLAGS).alias("kf"))


def parse_money_q(spark, sf_dir):
    """Money text with symbol and thousands marks to decimal."""
    p = read(spark, sf_dir, "part")
    fmt = F.format_number(F.col("p_retailprice") * 10, 2)
    txt = F.when(F.col("p_size") >= 49, F.lit("-")).otherwise(F.concat(F.lit("€"), fmt))
    eu = F.translate(fmt, ",.", ".,")
    t = p.select("p_partkey", txt.alias("price_text"), eu.alias("eu_text"))
    return t.select("p_partkey", "price_text",
                    parse_money("price_text").alias("price"),
                    "eu_text",
                    parse_money("eu_text").alias("eu_as_thousands"),
                    parse_money("eu_text", decimal_comma=True).alias("eu_price"))


def calendar_q(spark, sf_dir):
    """Calendar over the order-date range."""
    days = date_series_between(order_dates(spark, sf_dir), F.col("lo"), F.col("hi"))
    return calendar_attrs(days)


def month_series_rates(spark, sf_dir):
    """Manual rates for every order month."""
    months = month_series_between(order_dates(spark, sf_dir), F.col("lo"), F.col("hi"))
    return fx.manual_rates(months)


def latest_product(spark, sf_dir):
    """Latest line per part (DESC NULLS FIRST, total tie-break)."""
    return latest_per_key(read(spark, sf_dir, "lineitem"), ["l_partkey"], "l_shipdate")


EVENT_STATUS = {"purchase": "COMPLETED", "signup": "NEW", "click": "PROCESSING",
                "view": "CONFIRMED", "error": "CANCELLED"}


def status_map_priority(spark, sf_dir):
    """One status per (user, day) by business priority."""
    e = read(spark, sf_dir, "events")
    st = None
    for k, v in EVENT_STATUS.items():
        st = F.when(F.col("event_type") == k, F.lit(v)) if st is None else st.when(F.col("event_type") == k, F.lit(v))
    st = st.otherwise(F.lit("UNKNOWN"))
    t = e.select("user_id", F.col("ts").cast("date").alias("event_date"), st.alias("status_std"))
    t = t.withColumn("_rank", priority_rank("status_std", seeds.STATUS_PRIORITY, seeds.STATUS_FALLBACK_RANK))
    return keep_first(t, ["user_id", "event_date"], [F.col("_rank").asc(), F.col("status_std").asc()],
                      ["_rank", "status_std"]).drop("_rank")


def hash_keys(spark, sf_dir):
    """K1, K2: business key and change hashes."""
    r = driver.order_raw(spark, sf_dir)
    return r.select(hash_key(*facts.KEY_COLS).alias("business_key_hash"),
                    hash_key(*facts.CHANGE_COLS).alias("change_hash"),
                    "country", "order_id", "product_number", "ingested_at")


def dim_product_scd1(spark, sf_dir):
    """SCD-1 product dimension after two product loads."""
    return dim_product_run2(spark, sf_dir)


def upsert_insert_only(spark, sf_dir):
    """M2: insert-only upsert; existing customers are never changed."""
    c = read(spark, sf_dir, "customer")
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    target = c.where(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE", "MACHINERY")).select(*cols)
    source = c.select(
        "c_custkey", F.lower("c_name").alias("c_name"), "c_nationkey", "c_acctbal", "c_mktsegment")
    return upsert(target, source, ["c_custkey"], on_match="keep")


def guarded_loads(spark, sf_dir):
    raw = driver.order_lines(spark, sf_dir)
    load1 = raw.where(F.col("ingested_at") < ts(LOAD1_CUTOFF))
    load2 = raw.where((F.col("created_at") >= F.lit(LOAD2_CREATED_FROM))
                      | (F.col("ingested_at") >= ts(LOAD1_CUTOFF))).withColumn(
        "overall_status_name",
        F.when(F.col("overall_status_name") == "Packas", F.lit("Beställning slutförd"))
         .otherwise(F.col("overall_status_name")))
    return driver.delivered(load1, "load_1"), driver.delivered(load2, "load_2")


def upsert_guarded(spark, sf_dir):
    """M3, M4, M5: second load updates only lines whose change hash moved."""
    load1, load2 = guarded_loads(spark, sf_dir)
    b1, _ = sales_batch(spark, sf_dir, raw=load1, run_ts=RUN1_TS)
    current = facts.upsert_sales(facts.empty_sales(spark), b1, ts(RUN1_TS))
    b2, _ = sales_batch(spark, sf_dir, raw=load2, run_ts=RUN_TS)
    return facts.upsert_sales(current, b2, ts(RUN_TS))


def sales_lookback(spark, sf_dir):
    """Current and previous month only (as_of 2001-08-01)."""
    rows, _ = sales_batch(spark, sf_dir, as_of=AS_OF)
    return facts.upsert_sales(facts.empty_sales(spark), rows, ts(RUN_TS))


def sales_current_eur(spark, sf_dir):
    """E5 (flagship): full history into sales_current, converted to EUR."""
    return sales_current(spark, sf_dir)


def sales_rejects(spark, sf_dir):
    """Rows routed to rejects, counted by reason."""
    _, rejects = sales_batch(spark, sf_dir)
    return rejects.groupBy(F.col("_reject").alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


def exact_amounts(spark, sf_dir):
    """Products of wide amounts, exact and rounded once; NULL beyond numeric(18,4)."""
    # Any bigint key fits its amount (28 digits): a wide one counts last decimals of 0.01, not of 0.00000001,
    # as the product with 1000000 does.
    li = read(spark, sf_dir, "lineitem")
    long = lambda c: F.col(c).cast("decimal(19,0)")
    last = F.lit(Decimal("0.00000001"))
    unit = F.when(F.col("l_linenumber") == 7, F.lit(Decimal("0.01000000"))).otherwise(last).cast("decimal(8,8)")
    parts = {"qty": (long("l_orderkey") * 1000000007 + F.col("l_linenumber"), unit),
             "price": (long("l_partkey") * 1000003 + 7, last), "rate": (long("l_suppkey") * 100003 + 1, last)}
    amounts = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[
        (n.cast("decimal(28,0)") * u).cast("decimal(37,8)").alias(k) for k, (n, u) in parts.items()])
    return amounts.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                          exact_product(F.col("price"), F.col("rate")).alias("unit_price"),
                          exact_product(F.col("qty"), F.col("price"), F.col("rate")).alias("order_value"))


def stock_snapshot(spark, sf_dir):
    """Monthly stock snapshot, latest line per (country, product)."""
    return stock_current(spark, sf_dir)


def fx_monthly_avg(spark, sf_dir):
    """Inverse monthly mean per event type, base row added."""
    e = read(spark, sf_dir, "events")
    q = e.select(F.col("ts").cast("date").alias("rate_date"), F.col("event_type").alias("currency_code"),
                 F.col("value").cast("decimal(18,2)").cast("decimal(18,8)").alias("rate"))
    rates, _ = fx.monthly_inverse_mean(q)
    return fx.with_base_rows(rates)


def fx_source_fallback(spark, sf_dir):
    """Primary quotes with per-(month, currency) fallback."""
    supported = spark.createDataFrame([(c,) for c in SUPPORTED_PRIMARY], "currency_code string")
    rates, _ = fx.monthly_rates(driver.quotes_from_orders(spark, sf_dir),
                                driver.dim_country(spark, sf_dir),
                                secondary=driver.quotes_from_lineitem(spark, sf_dir),
                                supported=supported)
    return rates


def needed_pairs(spark, sf_dir, as_of: dt.date, n: int) -> DataFrame:
    """(month, currency) pairs required for the last ``n`` months."""
    return pipeline.needed_pairs(driver.dim_country(spark, sf_dir), as_of, n)


def fx_missing_months(spark, sf_dir):
    """Q6.1l, F6: required (month, currency) pairs without a rate."""
    need = needed_pairs(spark, sf_dir, FX_CHECK_AS_OF, FX_CHECK_MONTHS)
    have = fx_rates(spark, sf_dir).select("month_sk", "currency_code")
    missing = need.join(have, ["month_sk", "currency_code"], "left_anti").select("month_sk", "currency_code")
    return missing.orderBy(F.col("month_sk").desc(), F.col("currency_code").asc())  # O2: listing order


def surrogate_keys(spark, sf_dir):
    """K3: stable keys; existing customers keep theirs, new ones follow."""
    c = read(spark, sf_dir, "customer")
    first = assign_surrogate(c.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name"),
                             "c_name", "customer_sk")
    return assign_surrogate(c.select("c_custkey", "c_name"), "c_name", "customer_sk",
                            existing=first.select("c_name", "customer_sk"))


def dim_country_scd1(spark, sf_dir):
    """Country dimension re-loaded over an older version.

    The older version knew the countries of three regions under old
    (lower-case) currency codes; the load overwrites codes and appends the
    other countries with the next surrogate keys.
    """
    derived = driver.dim_country(spark, sf_dir)
    old = derived.where(F.col("currency_code").isin("AFR", "AME", "ASI")).withColumn(
        "currency_code", F.lower("currency_code"))
    first = dims.load_dim_country(old, dims.empty(spark, "dim_country"))
    return dims.load_dim_country(derived, first)


def dim_date_insert_only(spark, sf_dir):
    """Calendar rows inserted once; existing rows are never changed.

    The existing dimension covers the first 365 days of the order range and
    spells ``year_month`` as ``yyyy/MM``; the reload keeps those rows.
    """
    b = order_dates(spark, sf_dir)
    first_year = calendar_attrs(date_series_between(b, F.col("lo"), F.date_add(F.col("lo").cast("date"), 364)))
    existing = first_year.withColumn("year_month", F.date_format("date_sk", "yyyy/MM"))
    full = calendar_attrs(date_series_between(b, F.col("lo"), F.col("hi")))
    return upsert(existing, full, ["date_sk"], on_match="keep")


def fx_rates_table(spark, sf_dir):
    """Keyed upsert of computed rates, then manual rates (last wins)."""
    keys, cols = ["month_sk", "currency_code"], ["avg_rate_to_eur", "obs_count", "source"]
    t = upsert(dims.empty(spark, "fx_rates_monthly"), fx_rates(spark, sf_dir), keys, cols)
    months = month_series_between(order_dates(spark, sf_dir), F.col("lo"), F.col("hi"))
    return upsert(t, fx.manual_rates(months), keys, cols)


def fx_currency_listing(spark, sf_dir):
    """The rate rows of one currency after the rate load (RSD)."""
    return fx_rates_table(spark, sf_dir).where(F.col("currency_code") == F.lit("RSD"))
