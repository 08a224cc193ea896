"""Independent DuckDB SQL for every driver query (the correctness oracle).

Written from the operator semantics, not from the Spark code: DISTINCT ON
for keep-first, FULL OUTER JOIN for upserts, FILTER aggregates for checks.
Widths are cast explicitly (DuckDB narrows decimal products and turns
decimal division into DOUBLE).
"""

from __future__ import annotations

# Fixed values, stated here again so that a wrong seed does not check itself:
# the statuses the feed delivers (trimmed, as in the conformance map; the
# German one is not in it), the priorities and the manual rates.
STATUS_MAP = [("Beställning slutförd", "COMPLETED"), ("Zwrot", "RETURN"), ("Packas", "PROCESSING"),
              ("ordine spedito parzialmente", "SHIPPED")]
STATUS_PRIORITY = ["FRAUD", "CANCELLED", "COMPLAINT", "RETURN", "SHIPPED",
                   "READY_TO_SHIP", "PROCESSING", "CONFIRMED", "NEW"]
MANUAL_RATES = [("COP", "0.00023"), ("RSD", "0.00855")]

RUN_TS = "TIMESTAMP '2026-01-20 06:00:00'"
RUN1_TS = "TIMESTAMP '2026-01-13 06:00:00'"
LOAD1_TS = "TIMESTAMP '2026-01-05 00:00:00'"
LOAD2_TS = "TIMESTAMP '2026-01-12 00:00:00'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _cc(col: str) -> str:
    return f"('N' || lpad(CAST({col} AS VARCHAR), 2, '0'))"


def _cur(col: str) -> str:
    return f"(CASE WHEN {col} = 'EUROPE' THEN 'EUR' ELSE upper(substr({col}, 1, 3)) END)"


STATUS_RANK = ("CASE status_std " + " ".join(f"WHEN {_q(s)} THEN {i}" for i, s in
                                              enumerate(STATUS_PRIORITY, 1)) + " ELSE 99 END")

BASE = f"""
dim_country AS (
  SELECT n_name AS country_name, {_cc('n_nationkey')} AS country_code, {_cur('r_name')} AS currency_code
  FROM nation JOIN region ON n_regionkey = r_regionkey),
nation_cur AS (
  SELECT n_nationkey AS nk, {_cur('r_name')} AS currency_code
  FROM nation JOIN region ON n_regionkey = r_regionkey),
order_raw AS (
  SELECT CASE rule WHEN 0 THEN '  ' WHEN 1 THEN 'XX' ELSE {_cc('c_nationkey')} END AS country,
    CASE rule WHEN 2 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
    'SO-' || CAST(o_orderkey AS VARCHAR) AS order_number,
    CASE WHEN o_orderstatus = 'F' THEN 'Beställning slutförd'
         WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'Zwrot  '
         WHEN o_orderstatus = 'O' THEN 'Packas'
         WHEN o_orderpriority = '5-LOW' THEN 'Teilweise versendet'
         ELSE 'ordine spedito parzialmente' END AS overall_status_name,
    c_mktsegment AS channel_name,
    CASE rule WHEN 3 THEN ' ' ELSE CAST(l_partkey AS VARCHAR) END AS product_number,
    CASE WHEN rule = 4 THEN NULL WHEN p_size = 1 THEN 'Delivery Fee' ELSE p_name END AS product_name,
    CASE WHEN rule = 5 THEN '0' WHEN rule = 6 THEN '-3' WHEN rule = 7 THEN '99999999999999999999'
         WHEN rule = 8 THEN '3.14159265'
         WHEN l_quantity = 50 THEN replace(CAST(CAST(l_quantity AS DECIMAL(14,4)) AS VARCHAR), '.', ',')
         ELSE CAST(CAST(l_quantity AS DECIMAL(14,4)) AS VARCHAR) END AS quantity,
    CASE rule WHEN 8 THEN '0.12345678' WHEN 9 THEN 'n/a' WHEN 10 THEN '-1.5'
         ELSE CAST(CAST(p_retailprice AS DECIMAL(14,4)) AS VARCHAR) END AS unit_price,
    CASE rule WHEN 11 THEN '32.13.2026' WHEN 12 THEN 'N/A'
         ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS promised_delivery_at,
    p_brand AS manufacturer,
    CASE WHEN rule = 13 THEN 'N/A' WHEN rule = 14 THEN '2001/99/99'
         WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS created_at,
    'sales_' || {_cc('c_nationkey')} || '.csv' AS source_file,
    CAST(l_shipdate AS TIMESTAMP) AS ingested_at
  FROM (SELECT *, (l_orderkey * 7 + l_partkey) % 499 AS rule FROM lineitem)
       JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey),
stock_raw AS (
  SELECT {_cc('s_nationkey')} AS country, CAST(l_partkey AS VARCHAR) AS product_number,
    CAST(CAST(l_quantity - 10 AS DECIMAL(14,4)) AS VARCHAR) AS sellable_stock,
    'stock_' || {_cc('s_nationkey')} || '.csv' AS source_file,
    CAST(l_shipdate AS TIMESTAMP) AS ingested_at
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
status_lit(raw_status, status_std) AS (VALUES
  {", ".join(f"({_q(a)}, {_q(b)})" for a, b in STATUS_MAP)}),
status_map AS (
  SELECT DISTINCT ON (raw_status) raw_status, status_std
  FROM (SELECT trim(raw_status) AS raw_status, status_std FROM status_lit)
  ORDER BY raw_status, {STATUS_RANK}, status_std),
quotes_o AS (
  SELECT CAST(o_orderdate AS DATE) AS rate_date, nc.currency_code,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.00001 AS DECIMAL(5,5)) AS DECIMAL(18,8)) AS rate
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation_cur nc ON c_nationkey = nc.nk),
quotes_l AS (
  SELECT CAST(l_shipdate AS DATE) AS rate_date, nc.currency_code,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.0001 AS DECIMAL(4,4)) AS DECIMAL(18,8)) AS rate
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation_cur nc ON s_nationkey = nc.nk),
needed AS (SELECT DISTINCT currency_code FROM dim_country WHERE currency_code <> 'EUR')"""


def fx_from(quotes_sql: str) -> str:
    """Inverse monthly mean + base rows over a (month_sk, currency_code, rate) query."""
    return f"""(WITH q AS ({quotes_sql}),
  a AS (SELECT month_sk, currency_code, CAST(sum(rate) AS DECIMAL(28,8)) AS s, count(rate) AS n
        FROM q WHERE currency_code <> 'EUR' GROUP BY month_sk, currency_code),
  r AS (SELECT month_sk, currency_code,
               CAST(CAST(n AS DECIMAL(10,0)) / NULLIF(s, 0) AS DECIMAL(18,8)) AS avg_rate_to_eur,
               CAST(n AS INTEGER) AS obs_count, 'monthly_avg' AS source FROM a),
  ok AS (SELECT * FROM r WHERE avg_rate_to_eur IS NOT NULL)
  SELECT * FROM ok
  UNION ALL
  SELECT DISTINCT month_sk, 'EUR', CAST(1 AS DECIMAL(18,8)), 1, 'monthly_avg' FROM ok)"""


FX_PRIMARY = fx_from("SELECT CAST(date_trunc('month', rate_date) AS DATE) AS month_sk, currency_code, rate "
                     "FROM quotes_o WHERE currency_code IN (SELECT currency_code FROM needed)")

PARSED_TS = "TRY_CAST(NULLIF(NULLIF(trim(created_at), ''), 'N/A') AS TIMESTAMP)"

RAW_COLS = ["country", "order_id", "order_number", "overall_status_name", "channel_name",
            "product_number", "product_name", "quantity", "unit_price", "promised_delivery_at",
            "manufacturer", "created_at", "source_file"]


def sales_parts(raw: str) -> str:
    """CTE bodies s0 (parsed) and s1 (with reject reason) over relation ``raw``."""
    return f"""s0 AS (
    SELECT *, {PARSED_TS} AS _created,
      TRY_CAST(NULLIF(quantity, '') AS DECIMAL(22,8)) AS _qty,
      TRY_CAST(NULLIF(unit_price, '') AS DECIMAL(22,8)) AS _price
    FROM {raw} WHERE product_name IS DISTINCT FROM 'Delivery Fee'),
  s1 AS (
    SELECT *, CASE
      WHEN product_name IS NULL THEN 'product_name NULL'
      WHEN NULLIF(trim(created_at), '') = 'N/A' THEN 'created_at N/A'
      WHEN NULLIF(trim(created_at), '') IS NOT NULL AND _created IS NULL THEN 'created_at not a timestamp'
      WHEN NULLIF(trim(quantity), '') IS NOT NULL AND _qty IS NULL THEN 'quantity not numeric'
      WHEN NULLIF(trim(unit_price), '') IS NOT NULL AND _price IS NULL THEN 'unit_price not numeric'
      WHEN NULLIF(NULLIF(trim(promised_delivery_at), ''), 'N/A') IS NOT NULL
           AND TRY_CAST(NULLIF(NULLIF(trim(promised_delivery_at), ''), 'N/A') AS DATE) IS NULL
        THEN 'promised_delivery_at not a date' END AS _reject
    FROM s0)"""


def sales_from(raw: str, run_ts: str = RUN_TS, window_start: str | None = None,
               fx: str = FX_PRIMARY) -> str:
    """Typed, EUR-converted, latest-per-key sales rows over relation ``raw``."""
    window = f"_created >= {window_start}" if window_start else "_created IS NOT NULL"
    tie = ", ".join(f"{c} NULLS FIRST" for c in RAW_COLS + ["_created", "_qty", "_price"])
    return f"""(WITH {sales_parts(raw)},
  s2 AS (
    SELECT *, md5(coalesce(country, '') || '|' || coalesce(order_id, '') || '|' || coalesce(product_number, ''))
              AS business_key_hash
    FROM s1 WHERE _reject IS NULL AND {window}),
  s3 AS (
    SELECT DISTINCT ON (business_key_hash) * FROM s2
    ORDER BY business_key_hash, ingested_at DESC NULLS FIRST, {tie}),
  fx AS {fx},
  s4 AS (
    SELECT s3.*, m.status_std, c.currency_code AS cur, f.avg_rate_to_eur
    FROM s3
    LEFT JOIN status_map m ON trim(s3.overall_status_name) = m.raw_status
    LEFT JOIN dim_country c ON s3.country = c.country_code
    LEFT JOIN fx f ON c.currency_code = f.currency_code
                  AND CAST(date_trunc('month', CAST(s3._created AS DATE)) AS DATE) = f.month_sk)
  SELECT business_key_hash,
    md5(coalesce(overall_status_name, '') || '|' || coalesce(quantity, '') || '|' ||
        coalesce(unit_price, '') || '|' || coalesce(promised_delivery_at, '')) AS change_hash,
    country AS country_code, order_id, product_number, order_number,
    overall_status_name AS raw_status, status_std, channel_name, product_name, manufacturer,
    _created AS created_at,
    TRY_CAST(NULLIF(NULLIF(trim(promised_delivery_at), ''), 'N/A') AS DATE) AS promised_delivery_at,
    CAST(_qty AS DECIMAL(18,4)) AS quantity,
    CAST(CAST(_price AS DECIMAL(20,8)) * CAST(COALESCE(avg_rate_to_eur, 1) AS DECIMAL(12,8))
         AS DECIMAL(18,4)) AS unit_price,
    CAST(CAST(CAST(_qty AS DECIMAL(19,8)) * CAST(_price AS DECIMAL(19,8)) AS DECIMAL(26,16))
         * CAST(COALESCE(avg_rate_to_eur, 1) AS DECIMAL(12,8)) AS DECIMAL(18,4)) AS order_value,
    avg_rate_to_eur IS NULL AS fx_missing,
    source_file,
    {run_ts} AS last_ingested_at
  FROM s4)"""


SALES_COLS = ["business_key_hash", "change_hash", "country_code", "order_id", "product_number",
              "order_number", "raw_status", "status_std", "channel_name", "product_name",
              "manufacturer", "created_at", "promised_delivery_at", "quantity", "unit_price",
              "order_value", "fx_missing", "source_file", "last_ingested_at"]
SALES_IDENTITY = {"country_code", "order_id", "product_number"}


def guarded_upsert(t: str, s: str, run_ts: str) -> str:
    on_s = "s.business_key_hash IS NOT NULL"
    on_t = "t.business_key_hash IS NOT NULL"
    ins = f"({on_s} AND NOT {on_t})"
    upd = f"({on_s} AND {on_t} AND t.change_hash IS DISTINCT FROM s.change_hash)"
    cols = []
    for c in SALES_COLS:
        if c == "business_key_hash":
            cols.append(f"CASE WHEN {on_t} THEN t.{c} ELSE s.{c} END AS {c}")
        elif c == "last_ingested_at":
            cols.append(f"CASE WHEN {ins} OR {upd} THEN {run_ts} ELSE t.{c} END AS {c}")
        elif c in SALES_IDENTITY:
            cols.append(f"CASE WHEN {ins} THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            cols.append(f"CASE WHEN {ins} OR {upd} THEN s.{c} ELSE t.{c} END AS {c}")
    return (f"SELECT {', '.join(cols)} FROM {t} t FULL OUTER JOIN {s} s "
            f"ON t.business_key_hash = s.business_key_hash")


SALES_CURRENT = f"sales_current AS {sales_from('order_raw')}"

STOCK = f"""stock_snapshot AS (WITH
  st1 AS (SELECT *, TRY_CAST(NULLIF(sellable_stock, '') AS DECIMAL(18,4)) AS _stock
          FROM stock_raw WHERE NULLIF(product_number, '') IS NOT NULL),
  st2 AS (SELECT * FROM st1 WHERE NOT (country IS NULL OR (sellable_stock IS NOT NULL
          AND sellable_stock <> '' AND _stock IS NULL))),
  st3 AS (SELECT DISTINCT ON (country, product_number) * FROM st2
          ORDER BY country, product_number, ingested_at DESC NULLS FIRST,
                   sellable_stock NULLS FIRST, source_file NULLS FIRST, _stock NULLS FIRST)
  SELECT DATE '2001-08-01' AS snapshot_month, country AS country_code, product_number,
         _stock AS sellable_stock, source_file, {RUN_TS} AS ingested_at FROM st3)"""

# ---------------------------------------------------------------- products
PRODUCT_COMMON = """p_brand AS classification1, p_type AS classification2,
    CAST(p_size AS VARCHAR) AS classification3,
    CASE WHEN p_size <= 25 THEN 'SS26' ELSE 'AW26' END AS season,
    CASE WHEN p_type = 'PROMO' THEN '@' WHEN p_type = 'ECONOMY' THEN 'Active'
         WHEN p_type = 'SMALL' THEN ' Ja ' ELSE 'nein' END AS discontinued,
    CASE WHEN p_size > 40 THEN 'yes' WHEN p_size < 5 THEN ' ' ELSE 'N' END AS bestseller_abas,
    CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'x' WHEN p_size > 25 THEN 'true' ELSE '0' END AS kf"""

PRODUCT_RAW = f"""product_raw_1 AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_number, p_name AS product_name, {PRODUCT_COMMON},
    format('€{{:,.2f}}', p_retailprice * 10) AS uvp_de,
    CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS uvp_eu,
    CASE WHEN p_size > 48 THEN '-' ELSE CAST(CAST(p_retailprice * 0.55 AS DECIMAL(18,3)) AS VARCHAR) END
      AS franchise_price,
    'product_load_1.csv' AS source_file, {LOAD1_TS} AS load_run_ts
  FROM part WHERE p_size <= 45),
product_raw_2 AS (
  SELECT ' ' || CAST(p_partkey AS VARCHAR) AS product_number, upper(p_name) AS product_name, {PRODUCT_COMMON},
    format('€{{:,.2f}}', p_retailprice * 11) AS uvp_de,
    CAST(CAST(p_retailprice + 1 AS DECIMAL(18,2)) AS VARCHAR) AS uvp_eu,
    CASE WHEN p_size > 48 THEN '-' ELSE CAST(CAST(p_retailprice * 0.65 AS DECIMAL(18,3)) AS VARCHAR) END
      AS franchise_price,
    'product_load_2.csv' AS source_file, {LOAD2_TS} AS load_run_ts
  FROM part WHERE p_type = 'PROMO' OR p_size > 45),
product_raw AS (SELECT * FROM product_raw_1 UNION ALL SELECT * FROM product_raw_2)"""

# The flag vocabularies (true set, false set) of the product feed.
FLAG_SETS = {
    "discontinued": (["@", "ja", "yes", "y", "true", "1"], ["active", "nein", "no", "n", "false", "0"]),
    "bestseller_abas": (["yes", "ja", "y", "true", "1"], ["no", "nein", "n", "false", "0", " "]),
    "kf": (["ja", "yes", "y", "true", "1"], ["nein", "no", "n", "false", "0"]),
}


def flag_sql(col: str, which: str) -> str:
    t, f = FLAG_SETS[which]
    return (f"CASE WHEN lower(trim({col})) IN ({', '.join(map(_q, t))}) THEN true "
            f"WHEN lower(trim({col})) IN ({', '.join(map(_q, f))}) THEN false ELSE NULL END")


def money_sql(col: str, decimal_comma: bool = False) -> str:
    if decimal_comma:
        inner = f"replace(replace(replace({col}, '€', ''), '.', ''), ',', '.')"
    else:
        inner = f"replace(replace({col}, '€', ''), ',', '')"
    return f"TRY_CAST(NULLIF(NULLIF(trim({inner}), '-'), '') AS DECIMAL(18,2))"


PRODUCT_RAW_COLS = ["product_number", "product_name", "classification1", "classification2",
                    "classification3", "season", "discontinued", "bestseller_abas", "kf", "uvp_de",
                    "uvp_eu", "franchise_price", "source_file"]


def clean_products_sql(src: str) -> str:
    tie = ", ".join(f"{c} NULLS FIRST" for c in PRODUCT_RAW_COLS)
    return f"""(WITH k AS (SELECT NULLIF(trim(product_number), '') AS _pn, * FROM {src}),
  l AS (SELECT DISTINCT ON (_pn) * FROM k WHERE _pn IS NOT NULL
        ORDER BY _pn, load_run_ts DESC NULLS FIRST, {tie})
  SELECT _pn AS product_number,
    NULLIF(trim(product_name), '') AS product_name,
    NULLIF(trim(classification1), '') AS category1,
    NULLIF(trim(classification2), '') AS category2,
    NULLIF(trim(classification3), '') AS category3,
    NULLIF(trim(season), '') AS season,
    {flag_sql('discontinued', 'discontinued')} AS discontinued,
    {flag_sql('bestseller_abas', 'bestseller_abas')} AS bestseller_abas,
    {flag_sql('kf', 'kf')} AS kf,
    {money_sql('uvp_de')} AS uvp_de, {money_sql('uvp_eu')} AS uvp_eu,
    {money_sql('franchise_price')} AS franchise_price
  FROM l)"""


PRODUCT_ATTRS = ["product_name", "category1", "category2", "category3", "season", "discontinued",
                 "bestseller_abas", "kf", "uvp_de", "uvp_eu", "franchise_price"]

DIM_PRODUCT = f"""{PRODUCT_RAW},
clean_1 AS {clean_products_sql('product_raw_1')},
dim_product_1 AS (
  SELECT row_number() OVER (ORDER BY product_number) AS product_sk, product_number,
    {', '.join(PRODUCT_ATTRS)}, {LOAD1_TS} AS last_updated_at FROM clean_1),
clean_2 AS {clean_products_sql('product_raw')},
merged_2 AS (
  SELECT t.product_sk, COALESCE(t.product_number, s.product_number) AS product_number,
    {', '.join(f"CASE WHEN s.product_number IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in PRODUCT_ATTRS)},
    CASE WHEN s.product_number IS NOT NULL THEN {RUN_TS} ELSE t.last_updated_at END AS last_updated_at
  FROM dim_product_1 t FULL OUTER JOIN clean_2 s ON t.product_number = s.product_number),
new_sk AS (
  SELECT product_number,
    (SELECT COALESCE(max(product_sk), 0) FROM dim_product_1) + row_number() OVER (ORDER BY product_number) AS sk
  FROM merged_2 WHERE product_sk IS NULL),
dim_product_2 AS (
  SELECT COALESCE(m.product_sk, n.sk) AS product_sk, m.product_number,
    {', '.join('m.' + c for c in PRODUCT_ATTRS)}, m.last_updated_at
  FROM merged_2 m LEFT JOIN new_sk n ON m.product_number = n.product_number)"""


def check_row(check_id, name, metric, value_sql, informational=False, source=""):
    passed = "CAST(NULL AS BOOLEAN)" if informational else f"(COALESCE({value_sql}, 0) = 0)"
    return (f"SELECT {_q(check_id)} AS check_id, {_q(name)} AS check_name, {_q(metric)} AS metric, "
            f"CAST(COALESCE({value_sql}, 0) AS BIGINT) AS value, {passed} AS passed {source}")


def count_if(pred: str) -> str:
    return f"count(*) FILTER (WHERE {pred})"


NB = lambda c: f"NULLIF(trim({c}), '') IS NULL"
NUMERIC_RE = r"'^-?\d+(\.\d+)?\z'"

Q_ORDER_RAW = {
    "Q1.1": ("staging.order_raw: missing keys", "bad_rows",
             f"{NB('country')} OR {NB('order_id')} OR {NB('product_number')}", False),
    "Q1.2": ("staging.order_raw: delivery fee rows", "rows", "product_name = 'Delivery Fee'", True),
    "Q1.3": ("staging.order_raw: invalid created_at timestamp", "bad_rows",
             "NULLIF(trim(created_at), '') IS NOT NULL AND "
             "try_strptime(NULLIF(trim(created_at), ''), '%Y-%m-%dT%H:%M:%S') IS NULL", False),
    "Q1.3b": ("staging.order_raw: created_at not castable to timestamp", "bad_rows",
              "NULLIF(trim(created_at), '') IS NOT NULL AND "
              "TRY_CAST(NULLIF(trim(created_at), '') AS TIMESTAMP) IS NULL", False),
    "Q1.4a": ("staging.order_raw: quantity not numeric", "bad_rows",
              f"NULLIF(trim(quantity), '') IS NOT NULL AND NOT regexp_full_match(trim(quantity), {NUMERIC_RE})",
              False),
    "Q1.4b": ("staging.order_raw: unit_price not numeric", "bad_rows",
              f"NULLIF(trim(unit_price), '') IS NOT NULL AND NOT regexp_full_match(trim(unit_price), {NUMERIC_RE})",
              False),
}
Q_SALES = {
    "Q4.2": ("warehouse.sales_current: missing required fields", "bad_rows",
             f"{NB('country_code')} OR {NB('order_id')} OR {NB('product_number')}", False),
    "Q4.3": ("warehouse.sales_current: created_at is NULL", "bad_rows", "created_at IS NULL", False),
    "Q4.4": ("warehouse.sales_current: quantity <= 0", "bad_rows",
             "quantity IS NOT NULL AND quantity <= 0", False),
    "Q4.5": ("warehouse.sales_current: unit_price < 0", "bad_rows",
             "unit_price IS NOT NULL AND unit_price < 0", False),
    "Q4.6": ("warehouse.sales_current: raw_status not mapped", "bad_rows",
             "NULLIF(trim(raw_status), '') IS NOT NULL AND (status_std IS NULL OR trim(status_std) = '')",
             False),
}
Q_STOCK = {
    "Q5.2": ("warehouse.stock_snapshot: missing product_number", "bad_rows", NB("product_number"), False),
    "Q5.3": ("warehouse.stock_snapshot: negative stock", "bad_rows",
             "sellable_stock IS NOT NULL AND sellable_stock < 0", False),
}


def checks_on(table: str, spec: dict, ids: list[str]) -> str:
    parts = []
    for i in ids:
        name, metric, pred, info = spec[i]
        parts.append(check_row(i, name, metric, count_if(pred), info, f"FROM {table}"))
    return " UNION ALL ".join(parts)


def dup_check(check_id, name, table, keys, where=None, informational=False):
    w = f"WHERE {where}" if where else ""
    v = f"(SELECT count(*) FROM (SELECT 1 FROM {table} {w} GROUP BY {keys} HAVING count(*) > 1))"
    return check_row(check_id, name, "duplicate_groups", v, informational)


def missing_check(check_id, name, table, key, ref, ref_key):
    v = (f"(SELECT count(*) FROM {table} x LEFT JOIN (SELECT DISTINCT {ref_key} AS k FROM {ref}) r "
         f"ON x.{key} = r.k WHERE r.k IS NULL)")
    return check_row(check_id, name, "bad_rows", v)


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

FX_CHECK_MONTHS = ("SELECT CAST(date_trunc('month', DATE '2001-10-15' - to_months(CAST(n AS INTEGER))) AS DATE) "
                   "AS month_sk FROM range(0, 6) t(n)")
FX_MISSING = f"""fx_missing AS (
  WITH fx AS {FX_PRIMARY},
  need AS (SELECT m.month_sk, c.currency_code FROM ({FX_CHECK_MONTHS}) m
           CROSS JOIN (SELECT DISTINCT currency_code FROM dim_country) c)
  SELECT n.month_sk, n.currency_code FROM need n
  LEFT JOIN fx ON fx.month_sk = n.month_sk AND fx.currency_code = n.currency_code
  WHERE fx.currency_code IS NULL)"""


def W(*ctes: str) -> str:
    return "WITH " + BASE + "".join(",\n" + c for c in ctes) + "\n"


def _sql() -> dict[str, str]:
    raw_cols = ", ".join(RAW_COLS + ["ingested_at"])
    q: dict[str, str] = {}
    q["stage_orders"] = W() + f"SELECT {raw_cols} FROM order_raw"
    q["load_audit_by_source"] = W() + "SELECT source_file, count(*) AS row_count FROM order_raw GROUP BY source_file"
    text_cols = ", ".join(f"NULLIF({c}, '') AS {c}" for c in RAW_COLS if c not in ("country", "source_file"))
    q["stage_feed_text"] = W() + f"SELECT {text_cols}, source_file, ingested_at FROM order_raw"
    q["fx_payload_coverage"] = W(f"""fxp AS (SELECT CAST(date_trunc('month', rate_date) AS DATE) AS month_sk,
        count(DISTINCT currency_code) + 1 AS n FROM quotes_o
      WHERE currency_code IN (SELECT currency_code FROM needed) GROUP BY 1),
      mon AS (SELECT CAST(date_trunc('month', DATE '2001-10-15' - to_months(CAST(k AS INTEGER))) AS DATE)
        AS month_sk FROM range(12) t(k))""") + """
      SELECT month_sk, CASE WHEN n IS NULL THEN 'missing' ELSE 'loaded' END AS status,
        coalesce(n, 0) AS rate_rows FROM mon LEFT JOIN fxp USING (month_sk)"""
    q["conformed_statuses"] = W() + f"""
      SELECT raw_status, status_std FROM (SELECT DISTINCT trim(overall_status_name) AS raw_status FROM order_raw)
      LEFT JOIN status_map USING (raw_status)"""
    q["code_hygiene"] = """
      SELECT o_orderkey, CASE c_nationkey % 5 WHEN 0 THEN 'PL' WHEN 1 THEN NULL
          ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS code,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS first_day, last_day(CAST(o_orderdate AS DATE)) AS last_day,
        CAST(CAST(o_orderdate AS DATE) - INTERVAL 3 MONTH AS DATE) AS three_months_before
      FROM orders JOIN customer ON o_custkey = c_custkey"""
    q["clean_text_nulls"] = """
      WITH t AS (SELECT p_partkey,
        CASE WHEN p_size <= 3 THEN '   ' WHEN p_size >= 48 THEN ' N/A ' ELSE '  ' || p_name || ' ' END AS raw_name,
        CASE WHEN p_size = 2 THEN '' ELSE p_brand END AS raw_brand FROM part)
      SELECT p_partkey, raw_name, NULLIF(trim(raw_name), '') AS name_blank_null,
             NULLIF(NULLIF(trim(raw_name), ''), 'N/A') AS name_sentinel_null,
             NULLIF(raw_brand, '') AS brand_empty_null FROM t"""
    q["parse_flags"] = f"""
      WITH t AS (SELECT doc_id, CASE WHEN quality = 1 AND toxic = 1 THEN '@' WHEN quality = 1 THEN ' YES'
                   WHEN toxic = 1 THEN 'Active' ELSE 'nein' END AS flag_text FROM labels)
      SELECT doc_id, flag_text, {flag_sql('flag_text', 'discontinued')} AS discontinued,
             {flag_sql('flag_text', 'bestseller_abas')} AS bestseller_abas,
             {flag_sql('flag_text', 'kf')} AS kf FROM t"""
    q["parse_money"] = f"""
      WITH f AS (SELECT p_partkey, p_size, format('{{:,.2f}}', p_retailprice * 10) AS fmt FROM part),
      t AS (SELECT p_partkey, CASE WHEN p_size >= 49 THEN '-' ELSE '€' || fmt END AS price_text,
                   translate(fmt, ',.', '.,') AS eu_text FROM f)
      SELECT p_partkey, price_text, {money_sql('price_text')} AS price, eu_text,
             {money_sql('eu_text')} AS eu_as_thousands, {money_sql('eu_text', True)} AS eu_price FROM t"""
    q["calendar"] = """
      WITH d AS (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE),
                                                    INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
      SELECT d AS date_sk, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
             CAST(month(d) AS INTEGER) AS month_number, strftime(d, '%Y-%m') AS year_month FROM d"""
    rates = ", ".join(f"({_q(c)}, {_q(r)})" for c, r in MANUAL_RATES)
    q["month_series_rates"] = f"""
      WITH b AS (SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS lo,
                        CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS hi FROM orders),
      m AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month_sk FROM b)
      SELECT m.month_sk, x.currency_code, CAST(x.rate AS DECIMAL(18,8)) AS avg_rate_to_eur,
             CAST(0 AS INTEGER) AS obs_count, 'manual_fixed' AS source
      FROM m CROSS JOIN (VALUES {rates}) x(currency_code, rate)"""
    q["latest_product"] = """
      SELECT DISTINCT ON (l_partkey) * FROM lineitem
      ORDER BY l_partkey, l_shipdate DESC NULLS FIRST, l_orderkey NULLS FIRST, l_suppkey NULLS FIRST,
        l_linenumber NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
        l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST"""
    q["status_map_priority"] = f"""
      WITH t AS (SELECT user_id, CAST(ts AS DATE) AS event_date,
        CASE event_type WHEN 'purchase' THEN 'COMPLETED' WHEN 'signup' THEN 'NEW' WHEN 'click' THEN 'PROCESSING'
          WHEN 'view' THEN 'CONFIRMED' WHEN 'error' THEN 'CANCELLED' ELSE 'UNKNOWN' END AS status_std FROM events)
      SELECT DISTINCT ON (user_id, event_date) user_id, event_date, status_std FROM t
      ORDER BY user_id, event_date, {STATUS_RANK}, status_std"""
    q["hash_keys"] = W() + """
      SELECT md5(coalesce(country, '') || '|' || coalesce(order_id, '') || '|' || coalesce(product_number, ''))
               AS business_key_hash,
             md5(coalesce(overall_status_name, '') || '|' || coalesce(quantity, '') || '|' ||
                 coalesce(unit_price, '') || '|' || coalesce(promised_delivery_at, '')) AS change_hash,
             country, order_id, product_number, ingested_at FROM order_raw"""
    q["dim_product_scd1"] = W(DIM_PRODUCT) + "SELECT * FROM dim_product_2"
    q["upsert_insert_only"] = """
      WITH t AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
                 WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')),
      s AS (SELECT c_custkey, lower(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer)
      SELECT * FROM t UNION ALL
      SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.c_custkey = s.c_custkey)"""
    load1 = "load_1 AS (SELECT * FROM order_raw WHERE ingested_at < TIMESTAMP '2000-01-01 00:00:00')"
    load2 = ("load_2 AS (SELECT * REPLACE (CASE WHEN overall_status_name = 'Packas' THEN 'Beställning slutförd' "
             "ELSE overall_status_name END AS overall_status_name) FROM order_raw WHERE created_at >= '1999-07-01' "
             "OR ingested_at >= TIMESTAMP '2000-01-01 00:00:00')")
    q["upsert_guarded"] = W(load1, load2, f"b1 AS {sales_from('load_1', RUN1_TS)}",
                            f"b2 AS {sales_from('load_2', RUN_TS)}") + guarded_upsert("b1", "b2", RUN_TS)
    q["sales_lookback"] = W("sl AS " + sales_from("order_raw", RUN_TS,
                                                   window_start="TIMESTAMP '2001-07-01 00:00:00'")) + \
        "SELECT * FROM sl"
    q["sales_current_eur"] = W(SALES_CURRENT) + "SELECT * FROM sales_current"
    q["sales_rejects"] = W(f"rj AS (WITH {sales_parts('order_raw')} SELECT * FROM s1)") + \
        "SELECT _reject AS reason, count(*) AS rows FROM rj WHERE _reject IS NOT NULL GROUP BY _reject"
    q["stock_snapshot"] = W(STOCK) + "SELECT * FROM stock_snapshot"
    q["fx_monthly_avg"] = "SELECT * FROM " + fx_from(
        "SELECT CAST(date_trunc('month', CAST(ts AS DATE)) AS DATE) AS month_sk, event_type AS currency_code, "
        "CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(18,8)) AS rate FROM events")
    fallback_quotes = """
      WITH p AS (SELECT CAST(date_trunc('month', rate_date) AS DATE) AS month_sk, currency_code, rate FROM quotes_o
                 WHERE currency_code IN (SELECT currency_code FROM needed) AND currency_code IN ('AFR', 'AME', 'ASI')),
      s AS (SELECT CAST(date_trunc('month', rate_date) AS DATE) AS month_sk, currency_code, rate FROM quotes_l
            WHERE currency_code IN (SELECT currency_code FROM needed)),
      present AS (SELECT DISTINCT month_sk, currency_code FROM p)
      SELECT * FROM p UNION ALL
      SELECT s.* FROM s LEFT JOIN present x ON s.month_sk = x.month_sk AND s.currency_code = x.currency_code
      WHERE x.currency_code IS NULL"""
    q["fx_source_fallback"] = W() + "SELECT * FROM " + fx_from(fallback_quotes)
    q["fx_missing_months"] = W(FX_MISSING) + "SELECT month_sk, currency_code FROM fx_missing"
    q["surrogate_keys"] = """
      WITH f AS (SELECT c_name, row_number() OVER (ORDER BY c_name) AS customer_sk FROM customer
                 WHERE c_mktsegment = 'BUILDING'),
      mx AS (SELECT COALESCE(max(customer_sk), 0) AS m FROM f),
      nw AS (SELECT c_name, (SELECT m FROM mx) + row_number() OVER (ORDER BY c_name) AS customer_sk
             FROM (SELECT DISTINCT c_name FROM customer WHERE c_name NOT IN (SELECT c_name FROM f)))
      SELECT c.c_name, c.c_custkey, CAST(COALESCE(f.customer_sk, nw.customer_sk) AS BIGINT) AS customer_sk
      FROM customer c LEFT JOIN f ON c.c_name = f.c_name LEFT JOIN nw ON c.c_name = nw.c_name"""
    q["dim_country_scd1"] = W() + """
      , old AS (SELECT row_number() OVER (ORDER BY country_name) AS country_sk, country_name, country_code,
                       lower(currency_code) AS currency_code
                FROM dim_country WHERE currency_code IN ('AFR', 'AME', 'ASI')),
      merged AS (SELECT t.country_sk, COALESCE(t.country_name, s.country_name) AS country_name,
                        CASE WHEN s.country_name IS NOT NULL THEN s.country_code ELSE t.country_code END AS country_code,
                        CASE WHEN s.country_name IS NOT NULL THEN s.currency_code ELSE t.currency_code END AS currency_code
                 FROM old t FULL OUTER JOIN dim_country s ON t.country_name = s.country_name),
      nw AS (SELECT country_name, (SELECT max(country_sk) FROM old) + row_number() OVER (ORDER BY country_name) AS sk
             FROM merged WHERE country_sk IS NULL)
      SELECT CAST(COALESCE(m.country_sk, nw.sk) AS BIGINT) AS country_sk, m.country_name, m.country_code,
             m.currency_code FROM merged m LEFT JOIN nw ON m.country_name = nw.country_name"""
    q["dim_date_insert_only"] = """
      WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
      full_days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
      old_days AS (SELECT CAST(unnest(generate_series(lo, lo + 364, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
      existing AS (SELECT d AS date_sk, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
                          CAST(month(d) AS INTEGER) AS month_number, strftime(d, '%Y/%m') AS year_month FROM old_days),
      fresh AS (SELECT d AS date_sk, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
                       CAST(month(d) AS INTEGER) AS month_number, strftime(d, '%Y-%m') AS year_month FROM full_days)
      SELECT * FROM existing UNION ALL
      SELECT * FROM fresh WHERE date_sk NOT IN (SELECT date_sk FROM existing)"""
    q["fx_rates_table"] = W(f"computed AS {FX_PRIMARY}") + f"""
      , b AS (SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS lo,
                     CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS hi FROM orders),
      m AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month_sk FROM b),
      manual AS (SELECT m.month_sk, x.currency_code, CAST(x.rate AS DECIMAL(18,8)) AS avg_rate_to_eur,
                        CAST(0 AS INTEGER) AS obs_count, 'manual_fixed' AS source
                 FROM m CROSS JOIN (VALUES {rates}) x(currency_code, rate))
      SELECT COALESCE(t.month_sk, s.month_sk) AS month_sk, COALESCE(t.currency_code, s.currency_code) AS currency_code,
             CASE WHEN s.month_sk IS NOT NULL THEN s.avg_rate_to_eur ELSE t.avg_rate_to_eur END AS avg_rate_to_eur,
             CASE WHEN s.month_sk IS NOT NULL THEN s.obs_count ELSE t.obs_count END AS obs_count,
             CASE WHEN s.month_sk IS NOT NULL THEN s.source ELSE t.source END AS source
      FROM computed t FULL OUTER JOIN manual s ON t.month_sk = s.month_sk AND t.currency_code = s.currency_code"""
    q["fx_currency_listing"] = "SELECT * FROM (" + q["fx_rates_table"] + ") WHERE currency_code = 'RSD'"
    q["dq_row_counts"] = " UNION ALL ".join(
        f"SELECT {_q(t)} AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)
    q["dq_missing_keys"] = W(PRODUCT_RAW, SALES_CURRENT, STOCK) + " UNION ALL ".join([
        checks_on("order_raw", Q_ORDER_RAW, ["Q1.1"]),
        check_row("Q2.1", "staging.product_raw: missing product_number", "bad_rows",
                  count_if(NB("product_number")), False, "FROM product_raw"),
        checks_on("sales_current", Q_SALES, ["Q4.2", "Q4.3"]),
        checks_on("stock_snapshot", Q_STOCK, ["Q5.2"]),
    ])
    q["dq_service_rows"] = W() + checks_on("order_raw", Q_ORDER_RAW, ["Q1.2"])
    q["dq_not_castable"] = W() + checks_on("order_raw", Q_ORDER_RAW, ["Q1.3", "Q1.3b", "Q1.4a", "Q1.4b"])
    nn = lambda c: f"NULLIF(trim({c}), '') IS NOT NULL"
    q["dq_duplicates"] = W(DIM_PRODUCT, SALES_CURRENT, STOCK) + " UNION ALL ".join([
        dup_check("Q1.5", "staging.order_raw: duplicate (country, order_id, product_number)", "order_raw",
                  "country, order_id, product_number",
                  f"{nn('country')} AND {nn('order_id')} AND {nn('product_number')}", True),
        dup_check("Q2.2", "staging.product_raw: product_number duplicate groups", "product_raw",
                  "product_number", nn("product_number"), True),
        dup_check("Q3.1", "warehouse.dim_product: duplicate product_number (should be 0)", "dim_product_2",
                  "product_number"),
        dup_check("Q4.1", "warehouse.sales_current: duplicate business_key_hash (should be 0)", "sales_current",
                  "business_key_hash"),
        dup_check("Q5.1", "warehouse.stock_snapshot: duplicate (snapshot_month, country_code, product_number)",
                  "stock_snapshot", "snapshot_month, country_code, product_number"),
    ])
    q["dq_value_ranges"] = W(SALES_CURRENT, STOCK) + " UNION ALL ".join([
        checks_on("sales_current", Q_SALES, ["Q4.4", "Q4.5"]),
        checks_on("stock_snapshot", Q_STOCK, ["Q5.3"]),
        check_row("R.1", "customer: negative account balance", "bad_rows", count_if("c_acctbal < 0"), True,
                  "FROM customer"),
    ])
    q["dq_unmapped_top"] = W(SALES_CURRENT) + f"""
      SELECT 'TOP unmapped statuses' AS section, raw_status, count(*) AS cnt FROM sales_current
      WHERE {Q_SALES['Q4.6'][2]} GROUP BY raw_status ORDER BY cnt DESC, raw_status NULLS FIRST LIMIT 20"""
    q["dq_coverage"] = W(DIM_PRODUCT, SALES_CURRENT, STOCK) + " UNION ALL ".join([
        missing_check("Q3.2", "warehouse.sales_current: country_code not in dim_country", "sales_current",
                      "country_code", "dim_country", "country_code"),
        missing_check("Q4.7", "warehouse.sales_current: product_number not in dim_product", "sales_current",
                      "product_number", "dim_product_1", "product_number"),
        missing_check("Q5.4", "warehouse.stock_snapshot: product_number not in dim_product", "stock_snapshot",
                      "product_number", "dim_product_1", "product_number"),
    ])
    q["dq_coverage_top"] = W(DIM_PRODUCT, SALES_CURRENT) + """
      SELECT 'TOP missing product_numbers' AS section, sc.product_number, count(*) AS cnt
      FROM sales_current sc LEFT JOIN dim_product_1 dp ON sc.product_number = dp.product_number
      WHERE dp.product_number IS NULL GROUP BY sc.product_number
      ORDER BY cnt DESC, sc.product_number NULLS FIRST LIMIT 20"""
    q["dq_fx_coverage"] = W(FX_MISSING) + check_row(
        "Q6.1", "warehouse.fx_rates_monthly: missing rates (last 6 months)", "missing_pairs",
        "(SELECT count(*) FROM fx_missing)")
    q["dq_constraints"] = " UNION ALL ".join([
        dup_check("orders.unique(o_orderkey)", "orders: duplicate (o_orderkey)", "orders", "o_orderkey"),
        check_row("orders.not_null(o_custkey)", "orders: o_custkey is NULL", "bad_rows",
                  count_if("o_custkey IS NULL"), False, "FROM orders"),
        check_row("orders.not_null(o_orderdate)", "orders: o_orderdate is NULL", "bad_rows",
                  count_if("o_orderdate IS NULL"), False, "FROM orders"),
        dup_check("lineitem.unique(l_orderkey,l_linenumber)", "lineitem: duplicate (l_orderkey, l_linenumber)",
                  "lineitem", "l_orderkey, l_linenumber"),
        check_row("lineitem.not_null(l_partkey)", "lineitem: l_partkey is NULL", "bad_rows",
                  count_if("l_partkey IS NULL"), False, "FROM lineitem"),
        check_row("lineitem.not_null(l_shipdate)", "lineitem: l_shipdate is NULL", "bad_rows",
                  count_if("l_shipdate IS NULL"), False, "FROM lineitem"),
    ])

    q["exact_amounts"] = """
WITH p AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    (CAST(l_orderkey AS HUGEINT) * 1000000007 + l_linenumber)
      * CASE WHEN l_linenumber = 7 THEN 1000000 ELSE 1 END AS qi,
    CAST(l_partkey AS HUGEINT) * 1000003 + 7 AS pi, CAST(l_suppkey AS HUGEINT) * 100003 + 1 AS ri
  FROM lineitem),
n AS (
  SELECT *, pi * ri AS n2,
    CASE WHEN CAST(qi AS DOUBLE) * CAST(pi AS DOUBLE) * CAST(ri AS DOUBLE) < 9.99e37
         THEN (CASE WHEN CAST(qi AS DOUBLE) * CAST(pi AS DOUBLE) * CAST(ri AS DOUBLE) < 9.99e37
                    THEN qi ELSE 0 END) * pi * ri END AS n3
  FROM p)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(CAST((n2 + 500000000000) // 1000000000000 AS DECIMAL(18,0)) * 0.0001 AS DECIMAL(18,4)) AS unit_price,
  CAST(CAST((n3 + 50000000000000000000) // CAST('100000000000000000000' AS HUGEINT) AS DECIMAL(18,0)) * 0.0001
       AS DECIMAL(18,4)) AS order_value
FROM n"""

    report_missing = """fx_missing_3 AS (
  WITH fx AS """ + FX_PRIMARY + """,
  need AS (SELECT m.month_sk, c.currency_code
           FROM (SELECT CAST(date_trunc('month', DATE '2001-08-01' - to_months(CAST(n AS INTEGER))) AS DATE)
                 AS month_sk FROM range(0, 3) t(n)) m
           CROSS JOIN (SELECT DISTINCT currency_code FROM dim_country) c)
  SELECT n.month_sk, n.currency_code FROM need n
  LEFT JOIN fx ON fx.month_sk = n.month_sk AND fx.currency_code = n.currency_code
  WHERE fx.currency_code IS NULL)"""
    cal = """dim_date AS (
  SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE),
                                     INTERVAL 1 DAY)) AS DATE) AS date_sk FROM orders)"""
    fx_all = f"fx_all AS {FX_PRIMARY}"
    q0 = []
    for name, rel in [("staging.order_raw", "order_raw"), ("staging.product_raw", "product_raw"),
                      ("staging.stock_raw", "stock_raw"),
                      ("warehouse.dim_product", "dim_product_2"), ("warehouse.dim_country", "dim_country"),
                      ("warehouse.dim_date", "dim_date"), ("warehouse.sales_current", "sales_current"),
                      ("warehouse.stock_snapshot", "stock_snapshot"), ("warehouse.fx_rates_monthly", "fx_all")]:
        q0.append(f"SELECT {_q('Q0 ' + name)} AS check_id, {_q(name)} AS check_name, 'row_count' AS metric, "
                  f"count(*) AS value, CAST(NULL AS BOOLEAN) AS passed FROM {rel}")
    nn = lambda c: f"NULLIF(trim({c}), '') IS NOT NULL"
    q["dq_report"] = W(DIM_PRODUCT, SALES_CURRENT, STOCK, cal, fx_all, report_missing) + " UNION ALL ".join(q0 + [
        checks_on("order_raw", Q_ORDER_RAW, ["Q1.1", "Q1.2", "Q1.3", "Q1.3b", "Q1.4a", "Q1.4b"]),
        dup_check("Q1.5", "staging.order_raw: duplicate (country, order_id, product_number)", "order_raw",
                  "country, order_id, product_number",
                  f"{nn('country')} AND {nn('order_id')} AND {nn('product_number')}", True),
        check_row("Q2.1", "staging.product_raw: missing product_number", "bad_rows",
                  count_if(NB("product_number")), False, "FROM product_raw"),
        dup_check("Q2.2", "staging.product_raw: product_number duplicate groups", "product_raw",
                  "product_number", nn("product_number"), True),
        dup_check("Q3.1", "warehouse.dim_product: duplicate product_number (should be 0)", "dim_product_2",
                  "product_number"),
        dup_check("Q8.country_code", "warehouse.dim_country: duplicate country_code (should be 0)", "dim_country",
                  "country_code"),
        missing_check("Q3.2", "warehouse.sales_current: country_code not in dim_country", "sales_current",
                      "country_code", "dim_country", "country_code"),
        dup_check("Q4.1", "warehouse.sales_current: duplicate business_key_hash (should be 0)", "sales_current",
                  "business_key_hash"),
        checks_on("sales_current", Q_SALES, ["Q4.2", "Q4.3", "Q4.4", "Q4.5", "Q4.6"]),
        missing_check("Q4.7", "warehouse.sales_current: product_number not in dim_product", "sales_current",
                      "product_number", "dim_product_2", "product_number"),
        dup_check("Q5.1", "warehouse.stock_snapshot: duplicate (snapshot_month, country_code, product_number)",
                  "stock_snapshot", "snapshot_month, country_code, product_number"),
        checks_on("stock_snapshot", Q_STOCK, ["Q5.2", "Q5.3"]),
        missing_check("Q5.4", "warehouse.stock_snapshot: product_number not in dim_product", "stock_snapshot",
                      "product_number", "dim_product_2", "product_number"),
        check_row("Q6.1", "warehouse.fx_rates_monthly: missing rates (last 3 months)", "missing_pairs",
                  "(SELECT count(*) FROM fx_missing_3)"),
    ])
    return q


ORACLE_SQL = _sql()
