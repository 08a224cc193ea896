"""DuckDB SQL of the queries in ``stored``; see ``oracle``."""

from __future__ import annotations

from martspark.plans import oracle as o
from martspark.plans.oracle import W, _q

FEED_COLS = ["order_id", "order_number", "overall_status_name", "channel_name", "product_number", "product_name",
             "quantity", "unit_price", "promised_delivery_at", "manufacturer", "created_at"]
LOAD1 = "load_1 AS (SELECT * FROM order_raw WHERE ingested_at < TIMESTAMP '2000-01-01 00:00:00')"
LOAD2 = ("load_2 AS (SELECT * REPLACE (CASE WHEN overall_status_name = 'Packas' THEN 'Beställning slutförd' "
         "ELSE overall_status_name END AS overall_status_name) FROM order_raw WHERE created_at >= '1999-07-01' "
         "OR ingested_at >= TIMESTAMP '2000-01-01 00:00:00')")
BATCHES = [LOAD1, LOAD2, f"b1 AS {o.sales_from('load_1', o.RUN1_TS)}", f"b2 AS {o.sales_from('load_2', o.RUN_TS)}"]
# the good lines of the feed files
STAGED = ("staged AS (SELECT * REPLACE ('XX' AS country) FROM order_raw "
          "WHERE order_number NOT LIKE '%77' AND order_number NOT LIKE '%88')")


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '' ELSE '\"' || replace({c}, '\"', '\"\"') || '\"' END"


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    cols = ", ".join(FEED_COLS)
    q["feed_files_staged"] = W(STAGED) + f"""SELECT country, {cols}, TIMESTAMP '2026-01-20 05:00:00' AS ingested_at,
      {o.PARSED_TS} AS created_ts FROM staged"""
    line = lambda names: " || ',' || ".join(_field(c) for c in names)
    q["feed_bad_lines"] = W() + f"""SELECT 'order_raw' AS feed, 'XX' AS country,
      CASE WHEN order_number LIKE '%77' THEN {line(FEED_COLS[:3])} ELSE {line(FEED_COLS)} || ',x' END AS line
      FROM order_raw WHERE order_number LIKE '%77' OR order_number LIKE '%88'"""
    nn = lambda c: f"NULLIF(trim({c}), '') IS NOT NULL"
    none = [f"SELECT {_q('Q0 staging.' + t)} AS check_id, {_q('staging.' + t)} AS check_name, 'row_count' AS metric, "
            f"CAST(0 AS BIGINT) AS value, CAST(NULL AS BOOLEAN) AS passed" for t in ("stock_raw", "product_raw")]
    q["staging_state_report"] = W(STAGED) + " UNION ALL ".join([
        "SELECT 'Q0 staging.order_raw' AS check_id, 'staging.order_raw' AS check_name, 'row_count' AS metric, "
        "count(*) AS value, CAST(NULL AS BOOLEAN) AS passed FROM staged",
        o.checks_on("staged", o.Q_ORDER_RAW, ["Q1.1", "Q1.2", "Q1.3", "Q1.3b", "Q1.4a", "Q1.4b"]),
        o.dup_check("Q1.5", "staging.order_raw: duplicate (country, order_id, product_number)", "staged",
                    "country, order_id, product_number",
                    f"{nn('country')} AND {nn('order_id')} AND {nn('product_number')}", True),
        *none, o.check_row("Q2.1", "staging.product_raw: missing product_number", "bad_rows", "0")])
    q["fx_payload_files"] = W() + "SELECT * FROM " + o.fx_from("""
      SELECT CAST(date_trunc('month', rate_date) AS DATE) AS month_sk, currency_code, rate FROM (
        SELECT rate_date, currency_code, max(rate) AS rate FROM quotes_o
        WHERE currency_code IN (SELECT currency_code FROM needed) GROUP BY rate_date, currency_code)""")
    key = "md5(coalesce(country, '') || '|' || coalesce(order_id, '') || '|' || coalesce(product_number, ''))"
    q["constraint_violations"] = W(f"""lines AS (
        SELECT {key} AS business_key_hash, NULLIF(trim(country), '') AS country_code,
               NULLIF(order_id, '') AS order_id, NULLIF(trim(product_number), '') AS product_number FROM order_raw),
      counted AS (
        SELECT 'Q8.sales_current.unique' AS constraint_id, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows
        FROM (SELECT count(*) AS n FROM lines GROUP BY business_key_hash HAVING count(*) > 1)""" + "".join(
        f" UNION ALL SELECT 'Q8.sales_current.{c}', count(*) FROM lines WHERE {c} IS NULL"
        for c in ("country_code", "order_id", "product_number")) + ")") + "SELECT * FROM counted WHERE rows > 0"
    merged = o.guarded_upsert("b1", "b2", o.RUN_TS)
    q["upsert_stored"] = q["upsert_bucketed"] = W(*BATCHES) + merged
    q["changed_months"] = W(*BATCHES) + """
      SELECT CAST(date_trunc('month', CAST(b2.created_at AS DATE)) AS DATE) AS created_month,
             CASE WHEN b1.business_key_hash IS NULL THEN 'insert' ELSE 'update' END AS action, count(*) AS rows
      FROM b2 LEFT JOIN b1 USING (business_key_hash)
      WHERE b1.business_key_hash IS NULL OR b1.change_hash IS DISTINCT FROM b2.change_hash
      GROUP BY 1, 2"""
    q["reload_actions"] = W(o.SALES_CURRENT) + """
      SELECT CAST(run AS INTEGER) AS run, action,
             CASE WHEN (run = 1) = (action = 'insert') AND action <> 'update' THEN (SELECT count(*) FROM sales_current)
                  ELSE 0 END AS rows
      FROM (VALUES (1), (2)) r(run) CROSS JOIN (VALUES ('insert'), ('update'), ('unchanged')) a(action)"""
    q["checks_from_state"] = W(*BATCHES, f"sales AS ({merged})", o.DIM_PRODUCT) + " UNION ALL ".join([
        "SELECT 'Q0 warehouse.sales_current' AS check_id, 'warehouse.sales_current' AS check_name, "
        "'row_count' AS metric, count(*) AS value, CAST(NULL AS BOOLEAN) AS passed FROM sales",
        o.dup_check("Q4.1", "warehouse.sales_current: duplicate business_key_hash (should be 0)", "sales",
                    "business_key_hash"),
        o.checks_on("sales", o.Q_SALES, ["Q4.2", "Q4.3", "Q4.4", "Q4.5", "Q4.6"]),
        o.missing_check("Q3.2", "warehouse.sales_current: country_code not in dim_country", "sales",
                        "country_code", "dim_country", "country_code"),
        o.missing_check("Q4.7", "warehouse.sales_current: product_number not in dim_product", "sales",
                        "product_number", "dim_product_1", "product_number")])
    q["sql_over_views"] = W(LOAD1, LOAD2) + """
      SELECT overall_status_name, count(*) AS lines, count(DISTINCT order_id) AS orders
      FROM (SELECT * FROM load_1 UNION ALL SELECT * FROM load_2) GROUP BY overall_status_name"""
    q["fx_merged_quotes"] = o.ORACLE_SQL["fx_source_fallback"]
    q["fx_rates_listing"] = f"""SELECT * FROM ({o.ORACLE_SQL['fx_rates_table']})
      WHERE month_sk > DATE '2000-10-01' AND month_sk <= DATE '2001-10-01'"""
    q["stream_load_audit"] = W(f"""s AS (WITH {o.sales_parts('order_raw')} SELECT * FROM s1),
      kept AS (SELECT {key} AS k FROM s WHERE _reject IS NULL AND _created IS NOT NULL)""") + """
      SELECT (SELECT count(*) FROM order_raw) AS lines,
             (SELECT count(*) FROM order_raw WHERE product_name = 'Delivery Fee') AS service,
             (SELECT count(*) FROM s WHERE _reject IS NULL AND _created IS NULL) AS outside,
             (SELECT count(*) FROM s WHERE _reject IS NOT NULL) AS rejected,
             (SELECT count(*) - count(DISTINCT k) FROM kept) AS superseded,
             (SELECT count(DISTINCT k) FROM kept) AS inserted,
             CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS unchanged"""
    return q


ORACLE_SQL = sql()
