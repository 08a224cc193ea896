"""Driver queries of the quality-check catalogue (Q0-Q8).

Check lists are plain ``Check`` specs so the same predicates serve the
driver queries, ``pipeline.report`` and any stored-table run.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from martspark.functions.clean import blank_to_null, is_numeric_text, parse_timestamp
from martspark.operators import quality
from martspark.operators.quality import Check
from martspark.plans import driver, facts
from martspark.plans.catalog import (AS_OF, calendar_q, dim_product_run1, dim_product_run2,
                                     fx_missing_months, fx_rates, sales_current, stock_current)
from martspark.plans.driver import read


def order_raw_checks() -> list[Check]:
    c = F.col
    # A text without the pattern's T would cost the parser an exception to refuse.
    iso = F.when(c("created_at").rlike("[Tt]"), parse_timestamp("created_at", ("yyyy-MM-dd'T'HH:mm:ss",), ("",)))
    return [
        Check("Q1.1", "staging.order_raw: missing keys",
              blank_to_null("country").isNull() | blank_to_null("order_id").isNull()
              | blank_to_null("product_number").isNull()),
        Check("Q1.2", "staging.order_raw: delivery fee rows",
              c("product_name") == F.lit(facts.SERVICE_PRODUCT), metric="rows", informational=True),
        Check("Q1.3", "staging.order_raw: invalid created_at timestamp",
              blank_to_null("created_at").isNotNull() & iso.isNull()),
        Check("Q1.3b", "staging.order_raw: created_at not castable to timestamp",
              blank_to_null("created_at").isNotNull()
              & blank_to_null("created_at").try_cast("timestamp_ntz").isNull()),
        Check("Q1.4a", "staging.order_raw: quantity not numeric",
              blank_to_null("quantity").isNotNull() & ~is_numeric_text("quantity")),
        Check("Q1.4b", "staging.order_raw: unit_price not numeric",
              blank_to_null("unit_price").isNotNull() & ~is_numeric_text("unit_price")),
    ]


def sales_checks() -> list[Check]:
    c = F.col
    return [
        Check("Q4.2", "warehouse.sales_current: missing required fields",
              blank_to_null("country_code").isNull() | blank_to_null("order_id").isNull()
              | blank_to_null("product_number").isNull()),
        Check("Q4.3", "warehouse.sales_current: created_at is NULL", c("created_at").isNull()),
        Check("Q4.4", "warehouse.sales_current: quantity <= 0",
              c("quantity").isNotNull() & (c("quantity") <= 0)),
        Check("Q4.5", "warehouse.sales_current: unit_price < 0",
              c("unit_price").isNotNull() & (c("unit_price") < 0)),
        Check("Q4.6", "warehouse.sales_current: raw_status not mapped",
              blank_to_null("raw_status").isNotNull()
              & (c("status_std").isNull() | (F.trim(c("status_std")) == F.lit("")))),
    ]


def stock_checks() -> list[Check]:
    c = F.col
    return [
        Check("Q5.2", "warehouse.stock_snapshot: missing product_number",
              blank_to_null("product_number").isNull()),
        Check("Q5.3", "warehouse.stock_snapshot: negative stock",
              c("sellable_stock").isNotNull() & (c("sellable_stock") < 0)),
    ]


def _pick(checks: list[Check], ids: set[str]) -> list[Check]:
    return [ch for ch in checks if ch.check_id in ids]


def dq_row_counts(spark, sf_dir):
    """Row count of every driver table, stacked."""
    return quality.row_counts({t: read(spark, sf_dir, t) for t in driver.TABLES})


def dq_missing_keys(spark, sf_dir):
    """Q1.1, Q2.1, Q4.2, Q4.3, Q5.2: blank keys per table (fused per table)."""
    pr = driver.product_raw(spark, sf_dir)
    return quality.union_checks(
        quality.count_checks(driver.order_raw(spark, sf_dir), _pick(order_raw_checks(), {"Q1.1"})),
        quality.count_checks(pr, [Check("Q2.1", "staging.product_raw: missing product_number",
                                        blank_to_null("product_number").isNull())]),
        quality.count_checks(sales_current(spark, sf_dir), _pick(sales_checks(), {"Q4.2", "Q4.3"})),
        quality.count_checks(stock_current(spark, sf_dir), _pick(stock_checks(), {"Q5.2"})),
    )


def dq_service_rows(spark, sf_dir):
    """Q1.2, P5: service (delivery fee) lines still in staging."""
    return quality.count_checks(driver.order_raw(spark, sf_dir), _pick(order_raw_checks(), {"Q1.2"}))


def dq_not_castable(spark, sf_dir):
    """Q1.3 (fixed format and direct cast), Q1.4a, Q1.4b, P12, C18: text that will not type."""
    return quality.count_checks(driver.order_raw(spark, sf_dir),
                                _pick(order_raw_checks(), {"Q1.3", "Q1.3b", "Q1.4a", "Q1.4b"}))


def dq_duplicates(spark, sf_dir):
    """Q1.5, Q2.2, Q3.1, Q4.1, Q5.1: duplicate key groups."""
    raw = driver.order_raw(spark, sf_dir)
    nb = lambda *cs: [blank_to_null(c).isNotNull() for c in cs]
    w1 = nb("country", "order_id", "product_number")
    return quality.union_checks(
        quality.duplicate_groups(raw, ["country", "order_id", "product_number"], "Q1.5",
                                 "staging.order_raw: duplicate (country, order_id, product_number)",
                                 where=w1[0] & w1[1] & w1[2], informational=True),
        quality.duplicate_groups(driver.product_raw(spark, sf_dir), ["product_number"], "Q2.2",
                                 "staging.product_raw: product_number duplicate groups",
                                 where=nb("product_number")[0], informational=True),
        quality.duplicate_groups(dim_product_run2(spark, sf_dir), ["product_number"], "Q3.1",
                                 "warehouse.dim_product: duplicate product_number (should be 0)"),
        quality.duplicate_groups(sales_current(spark, sf_dir), ["business_key_hash"], "Q4.1",
                                 "warehouse.sales_current: duplicate business_key_hash (should be 0)"),
        quality.duplicate_groups(stock_current(spark, sf_dir),
                                 ["snapshot_month", "country_code", "product_number"], "Q5.1",
                                 "warehouse.stock_snapshot: duplicate (snapshot_month, country_code, product_number)"),
    )


def dq_value_ranges(spark, sf_dir):
    """Q4.4, Q4.5, Q5.3 and a balance range check on customer."""
    return quality.union_checks(
        quality.count_checks(sales_current(spark, sf_dir), _pick(sales_checks(), {"Q4.4", "Q4.5"})),
        quality.count_checks(stock_current(spark, sf_dir), _pick(stock_checks(), {"Q5.3"})),
        quality.count_checks(read(spark, sf_dir, "customer"),
                             [Check("R.1", "customer: negative account balance",
                                    F.col("c_acctbal") < 0, informational=True)]),
    )


def dq_unmapped_top(spark, sf_dir):
    """Q4.6t, O1: top-20 raw statuses without a standard code."""
    s = sales_current(spark, sf_dir)
    bad = s.where(_pick(sales_checks(), {"Q4.6"})[0].predicate)
    return quality.top_counts(quality.key_counts(bad, "raw_status"), "raw_status", 20,
                              section="TOP unmapped statuses")


def dq_coverage(spark, sf_dir):
    """Q3.2, Q4.7, Q5.4, J4: references missing in a dimension."""
    s = sales_current(spark, sf_dir)
    dp = dim_product_run1(spark, sf_dir)
    return quality.union_checks(
        quality.missing_key_check(s, "country_code", driver.dim_country(spark, sf_dir), "Q3.2",
                                  "warehouse.sales_current: country_code not in dim_country"),
        quality.missing_key_check(s, "product_number", dp, "Q4.7",
                                  "warehouse.sales_current: product_number not in dim_product"),
        quality.missing_key_check(stock_current(spark, sf_dir), "product_number", dp, "Q5.4",
                                  "warehouse.stock_snapshot: product_number not in dim_product"),
    )


def dq_coverage_top(spark, sf_dir):
    """Q4.7t, O1: top-20 sold products missing in the (first-load) dimension."""
    m = quality.missing_keys(sales_current(spark, sf_dir), "product_number",
                             dim_product_run1(spark, sf_dir))
    return quality.top_counts(m, "product_number", 20, section="TOP missing product_numbers")


def dq_fx_coverage(spark, sf_dir):
    """Q6.1: count of required (month, currency) pairs without a rate."""
    m = fx_missing_months(spark, sf_dir).agg(F.count(F.lit(1)).alias("_v"))
    return m.select(F.lit("Q6.1").alias("check_id"),
                    F.lit("warehouse.fx_rates_monthly: missing rates (last 6 months)").alias("check_name"),
                    F.lit("missing_pairs").alias("metric"), F.col("_v").alias("value"),
                    (F.col("_v") == 0).alias("passed"))


def dq_constraints(spark, sf_dir):
    """Q7, Q8: declared keys and not-null columns as pass/fail rows."""
    o = read(spark, sf_dir, "orders")
    li = read(spark, sf_dir, "lineitem")
    return quality.union_checks(
        quality.assert_unique(o, ["o_orderkey"], "orders"),
        quality.assert_not_null(o, ["o_custkey", "o_orderdate"], "orders"),
        quality.assert_unique(li, ["l_orderkey", "l_linenumber"], "lineitem"),
        quality.assert_not_null(li, ["l_partkey", "l_shipdate"], "lineitem"),
    )


def dq_report(spark, sf_dir):
    """Q0-Q8: the whole check catalogue over the warehouse derived from the
    driver tables, as one plan (run date ``AS_OF``)."""
    from martspark.plans.pipeline import report_frames
    tables = {
        "dim_product": dim_product_run2(spark, sf_dir),
        "dim_country": driver.dim_country(spark, sf_dir),
        "dim_date": calendar_q(spark, sf_dir),
        "sales_current": sales_current(spark, sf_dir),
        "stock_snapshot": stock_current(spark, sf_dir),
        "fx_rates_monthly": fx_rates(spark, sf_dir),
    }
    return report_frames(driver.order_raw(spark, sf_dir), driver.product_raw(spark, sf_dir), tables, AS_OF,
                         driver.stock_raw(spark, sf_dir))
