"""Fact loads: ``sales_current`` (E5) and ``stock_snapshot``.

Both return lazy DataFrames.  A load is ``prepare`` (filter, parse, latest
row per key, enrich) followed by ``upsert`` into the current table state.
Rows that cannot be typed go to a rejects DataFrame instead of aborting the
run (ANSI casts would raise); ``strict=True`` callers check it is empty.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martspark.functions.amounts import exact_product
from martspark.functions.clean import (blank_to_null, empty_to_null, parse_decimal,
                                       parse_timestamp, sentinel_to_null)
from martspark.functions.dates import lookback_start, ntz_lit
from martspark.functions.keys import hash_key
from martspark.operators.dedup import keep_first, latest_per_key
from martspark.operators.quality import duplicate_groups
from martspark.operators.merge import (Changes, upsert, upsert_changed, upsert_partitions,
                                       upsert_touched)
from martspark import schemas
from martspark.session import materialize

SERVICE_PRODUCT = "Delivery Fee"  # fixed value: service lines never enter the fact
KEY_COLS = ["country", "order_id", "product_number"]
MAX_LOOKUP = 1_000_000  # rows of a relation that a load broadcasts
FITS = 9e13  # numeric(18,4) holds every amount below 1e14
CHANGE_COLS = ["overall_status_name", "quantity", "unit_price", "promised_delivery_at"]

# Columns a re-delivered line may change; identity columns never change.
SALES_UPDATE_COLS = ["change_hash", "order_number", "raw_status", "status_std", "channel_name",
                     "product_name", "manufacturer", "created_at", "promised_delivery_at",
                     "quantity", "unit_price", "order_value", "fx_missing", "source_file"]


def _not_blank_text_bad(raw: Column, parsed: Column) -> Column:
    # The parsed value first: most lines parse, and for those the text is not looked at again.
    return parsed.isNull() & raw.isNotNull() & (F.trim(raw) != "")


def _number(col: str) -> Column:
    """Number text with 8 decimals and as many integer digits as ``numeric(18,4)`` has."""
    return parse_decimal(col, 22, 8)


def _parse_sales(order_raw: DataFrame, as_of: dt.date | None, lookback_months: int,
                 lines: Observation | None = None):
    """Service-line filter, parsed columns, keep-condition and rejects."""
    # A NULL name fails the service-line filter too; such lines are reported.
    no_service = F.col("product_name").isNull() | (F.col("product_name") != F.lit(SERVICE_PRODUCT))
    s = order_raw.where(no_service)
    # Staging written by ``stage_sales`` carries the parsed time as a typed
    # sidecar column, so the window filter below is a bare-column range
    # predicate the parquet scan can push down and skip row groups with.
    created = F.col("created_ts") if "created_ts" in order_raw.columns else parse_timestamp("created_at")
    parsed = {"_created": created, "_qty": _number("quantity"), "_price": _number("unit_price")}
    s = s.withColumns(parsed)
    # Row conditions, each never NULL.  The keep-condition is a short
    # AND-chain on them (it is pushed below the staging projection; a CASE
    # over the raw text would be re-expanded there once per branch); the
    # reason text is only computed for the rejects output.
    created_txt = sentinel_to_null("created_at", ("",))
    created_na = F.coalesce(created_txt == F.lit("N/A"), F.lit(False))
    created_bad = created_txt.isNotNull() & F.col("_created").isNull()
    qty_bad = F.coalesce(_not_blank_text_bad(F.col("quantity"), F.col("_qty")), F.lit(False))
    price_bad = F.coalesce(_not_blank_text_bad(F.col("unit_price"), F.col("_price")), F.lit(False))
    promised = F.trim("promised_delivery_at")
    promised_bad = F.coalesce(promised.try_cast("date").isNull() & ~promised.isin("", "N/A"), F.lit(False))
    unnamed = F.col("product_name").isNull()
    reject_reason = (F.when(unnamed, F.lit("product_name NULL"))
                      .when(created_na, F.lit("created_at N/A"))
                      .when(created_bad, F.lit("created_at not a timestamp"))
                      .when(qty_bad, F.lit("quantity not numeric"))
                      .when(price_bad, F.lit("unit_price not numeric"))
                      .when(promised_bad, F.lit("promised_delivery_at not a date")))
    keep = F.col("_created").isNotNull() & ~unnamed & ~qty_bad & ~price_bad & ~promised_bad
    bad = unnamed | created_na | created_bad | qty_bad | price_bad | promised_bad
    if as_of is not None:
        start = ntz_lit(lookback_start(as_of, lookback_months))
        keep = keep & (F.col("_created") >= start)
        # a line delivered before the window was reported by its own run
        bad = bad & (F.col("ingested_at") >= start)
    found = s.where(bad)
    if lines is not None:
        # Spark interprets what it observes, so the conditions are columns, compiled with the scan.
        found = (order_raw.withColumns(parsed)
                 .withColumns({"_product": no_service, "_kept": no_service & keep, "_bad": no_service & bad})
                 .observe(lines, F.count(F.lit(1)).alias("n"), *[
                     F.count_if(F.col(f"_{k}")).alias(k) for k in ("product", "kept", "bad")])
                 .where("_bad").drop("_product", "_kept", "_bad"))
    rejects = (found.withColumn("_reject", reject_reason)
               .drop("_qty", "_price", "_created", *[c for c in ["created_ts"] if c in order_raw.columns]))
    return s, created, keep, rejects


def line_counts(lines: Observation) -> dict[str, int]:
    """Lines of a delivery by what a sales load does with them, counted as its rejects are
    written (``prepare_sales(lines=...)``).

    ``lines`` = ``service`` + ``outside`` (the window) + ``rejected`` + ``kept``; of the kept
    lines one per business key goes on, the others are superseded."""
    c = lines.get
    return {"lines": c["n"], "service": c["n"] - c["product"], "outside": c["product"] - c["kept"] - c["bad"],
            "rejected": c["bad"], "kept": c["kept"]}


def sales_rejects(order_raw: DataFrame, as_of: dt.date | None = None,
                  lookback_months: int = 1) -> DataFrame:
    """Staging lines a sales load rejects, with the reason in ``_reject``.

    With ``as_of`` only lines delivered inside the lookback window."""
    return _parse_sales(order_raw, as_of, lookback_months)[3]


def prepare_sales(order_raw: DataFrame, status_map: DataFrame, dim_country: DataFrame,
                  fx_rates: DataFrame, as_of: dt.date | None = None, lookback_months: int = 1,
                  run_ts: Column | None = None, change_cols: list[str] | None = None,
                  escape_hash: bool = False, once: bool = False,
                  lines: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Staging order lines -> one typed, EUR-converted row per business key.

    Returns ``(rows, rejects)``.
    * service lines are dropped (P4); lines with a NULL name, which that
      filter drops too, and lines with unparseable text or an amount beyond
      ``numeric(18,4)`` go to rejects with a reason (D9, D10, D17); lines with
      blank keys are loaded, for check Q4.2 to report;
    * ``created_at`` is parsed once; lines inside the lookback window are kept
      (``as_of=None`` reprocesses all history).  The window start is a literal
      computed here, so the comparison is on a bare column (P6);
    * the latest ``ingested_at`` per key wins (M7, D4);
    * status map, country and monthly rate are left lookups (J1-J3); a
      missing rate converts at 1 and sets ``fx_missing`` (F7, D11);
    * ``quantity x unit_price x rate`` is exact and rounded once to
      ``decimal(18,4)``, whatever the amounts' digits (D17);
    * ``change_cols`` are the raw columns of the change hash (D12; the
      default tracks status, quantity, unit price and promised date) and
      ``escape_hash`` escapes ``'|'`` inside hashed values (D30);
    * country codes are reduced to one row per code before the lookup, so a
      duplicated code cannot fan lines out (D5); ``dim_country_code_check``
      reports such duplicates;
    * ``once=True`` writes the de-duplicated, enriched batch to the shared folder, so that
      rows and rejects, used apart, do not each prepare it again (``session.release``
      deletes it);
    * ``lines`` counts the lines in the pass that finds the rejects (``line_counts``).
    """
    change_cols = list(change_cols or CHANGE_COLS)
    s, created, keep, rejects = _parse_sales(order_raw, as_of, lookback_months, lines)
    # The parsed columns are functions of the raw text: they are not carried
    # through the de-duplication shuffle but derived again afterwards.
    s = s.where(keep).drop("_created", "_qty", "_price")
    s = s.withColumn("business_key_hash", hash_key(*KEY_COLS, escape=escape_hash))
    s = latest_per_key(s, ["business_key_hash"], "ingested_at")
    s = s.withColumns({"_created": created, "_qty": _number("quantity"), "_price": _number("unit_price")})

    # Lookups, all bounded by their domains and broadcast: the status map
    # (a few hundred literals), countries, and the rate table, one row per
    # (month, currency): a century of months x all ISO currencies is about
    # 240k rows.  Broadcasting up front keeps the batch from being shuffled
    # for a join that AQE would only turn into a broadcast afterwards.  A load
    # that runs jobs anyway counts them; a larger one is joined as Spark sees fit.
    def small(df: DataFrame) -> DataFrame:
        if once and df.limit(MAX_LOOKUP + 1).count() > MAX_LOOKUP:
            return df
        return F.broadcast(df)

    m = small(status_map.select(F.col("raw_status").alias("_map_key"), "status_std"))
    one_per_code = keep_first(dim_country.select("country_code", "country_name", "currency_code"),
                              ["country_code"], [F.col("country_name").asc_nulls_first()], ["country_name"])
    c = small(one_per_code.select(F.col("country_code").alias("_cc"), "currency_code"))
    fx = small(fx_rates.select(F.col("currency_code").alias("_fx_cur"),
                                     F.col("month_sk").alias("_fx_month"), "avg_rate_to_eur"))
    s = s.join(m, F.trim(F.col("overall_status_name")) == F.col("_map_key"), "left")
    s = s.join(c, F.col("country") == F.col("_cc"), "left")
    s = s.withColumn("_month", F.trunc(F.col("_created").cast("date"), "month"))
    s = s.join(fx, (F.col("currency_code") == F.col("_fx_cur")) & (F.col("_month") == F.col("_fx_month")),
               "left")

    rate = F.coalesce(F.col("avg_rate_to_eur"), F.lit(1)).cast("decimal(20,8)")
    s = s.withColumns({"_price_eur": exact_product(F.col("_price"), rate),
                       "_value_eur": exact_product(F.col("_qty"), F.col("_price"), rate)})
    # An amount this far below numeric(18,4) fits whatever the rounding of a double, so the exact
    # products, which a filter would compute again, are only looked at where it is not.
    def beyond(*factors: Column) -> Column:
        size = F.abs(factors[0].cast("double"))
        for f in factors[1:]:
            size = size * F.abs(f.cast("double"))
        return F.coalesce(size >= F.lit(FITS), F.lit(False))

    too_large = ((beyond(F.col("_price"), rate) & F.col("_price_eur").isNull())
                 | (beyond(F.col("_qty"), F.col("_price"), rate) & F.col("_value_eur").isNull()))
    raw = [c for c in order_raw.columns if c != "created_ts"]
    out = s.select(
        "business_key_hash",
        hash_key(*change_cols, escape=escape_hash).alias("change_hash"),
        F.col("country").alias("country_code"),
        "order_id", "product_number", "order_number",
        F.col("overall_status_name").alias("raw_status"),
        "status_std", "channel_name", "product_name", "manufacturer",
        F.col("_created").alias("created_at"),
        F.trim("promised_delivery_at").try_cast("date").alias("promised_delivery_at"),
        F.col("_qty").cast("decimal(18,4)").alias("quantity"),
        F.col("_price_eur").alias("unit_price"),
        F.col("_value_eur").alias("order_value"),
        F.col("avg_rate_to_eur").isNull().alias("fx_missing"),
        "source_file",
        (run_ts if run_ts is not None else F.col("ingested_at")).cast("timestamp_ntz")
        .alias("last_ingested_at"),
        # the raw line, only of rows whose amounts do not fit
        F.when(too_large, F.struct(*raw)).alias("_overflow"),
    )
    if once:
        out = materialize(out)
    overflow = out.where(F.col("_overflow").isNotNull()).select(
        "_overflow.*", F.lit("amount out of range").alias("_reject"))
    return out.where(F.col("_overflow").isNull()).drop("_overflow"), rejects.unionByName(overflow)


def _sales_upsert_args(current: DataFrame, run_ts: Column, with_action: bool = False) -> dict:
    extra = ["created_month"] if "created_month" in current.columns else []
    # The business key is an md5 hex string, never NULL: plain equality lets
    # the join reuse the de-duplication's hash partitioning of the batch.
    return dict(update_cols=SALES_UPDATE_COLS + extra, guard="change_hash",
                stamps={"last_ingested_at": run_ts.cast("timestamp_ntz")}, with_action=with_action,
                null_safe=False)


def with_created_month(batch: DataFrame) -> DataFrame:
    """Partition column of the stored sales table."""
    return batch.withColumn("created_month", F.trunc(F.col("created_at").cast("date"), "month"))


def upsert_sales(current: DataFrame, batch: DataFrame, run_ts: Column,
                 with_action: bool = False, by_partition: str | None = None) -> DataFrame:
    """Guarded upsert (M3): a matched line changes only when its change hash
    differs; otherwise the row and its ``last_ingested_at`` stay.

    ``by_partition`` names the partition column of a stored table:
    ``"country_code"`` (part of the business key, a line never moves) or
    ``"created_month"`` (recent months change most; a corrected creation
    date can move a line, so the partitions holding the batch's keys are
    located first).  Only touched partitions are joined.
    """
    kw = _sales_upsert_args(current, run_ts, with_action)
    if by_partition == "created_month" and "created_month" not in batch.columns:
        batch = with_created_month(batch)
    if by_partition:
        return upsert_partitions(current, batch, ["business_key_hash"], by_partition,
                                 locate=by_partition != "country_code", **kw)
    return upsert(current, batch, ["business_key_hash"], **kw)


def upsert_sales_touched(current: DataFrame, batch: DataFrame, run_ts: Column,
                         with_action: bool = False) -> tuple[DataFrame, list]:
    """Guarded upsert of a table partitioned by ``created_month``; returns
    the new state of the touched months only and their values, for
    ``TableStore.publish_partitions``.  ``with_action`` adds ``_action``
    (insert / update / unchanged / untouched) for a load audit."""
    return upsert_touched(current, with_created_month(batch), ["business_key_hash"], "created_month",
                          locate=True, **_sales_upsert_args(current, run_ts, with_action))


def upsert_sales_changed(current: DataFrame, batch: DataFrame, run_ts: Column,
                         candidates: list | None = None, stored: bool = False) -> Changes:
    """Guarded upsert of only the creation months in which a line changes.

    ``candidates``: the months that may hold the batch's keys (None: all, []: none); ``stored``: the
    batch is read from files (``prepare_sales(once=True)``)."""
    kw = _sales_upsert_args(current, run_ts)
    del kw["with_action"]
    return upsert_changed(current, with_created_month(batch), ["business_key_hash"], "created_month",
                          candidates=candidates, stored=stored, **kw)


def empty_sales(spark) -> DataFrame:
    return schemas.empty_frame(spark, schemas.SALES_CURRENT)


def prepare_stock(stock_raw: DataFrame, as_of: dt.date, window: str = "all"
                  ) -> tuple[DataFrame, DataFrame]:
    """Staging stock lines -> one row per (country, product) for the run month.

    ``window="all"`` reads all staging history (as the source does);
    ``"month"`` keeps only lines ingested in the run month.  Empty product
    numbers are dropped but blank-only ones pass (P8, D15).  NULL country is
    part of the key and goes to rejects (D14).
    """
    month = dt.date(as_of.year, as_of.month, 1)
    s = stock_raw.where(empty_to_null("product_number").isNotNull())
    if window == "month":
        nxt = dt.date(month.year + (month.month == 12), month.month % 12 + 1, 1)
        s = s.where((F.col("ingested_at") >= ntz_lit(month)) & (F.col("ingested_at") < ntz_lit(nxt)))
    stock = parse_decimal("sellable_stock", 18, 4)
    s = s.withColumn("_stock", stock)
    bad = (F.col("country").isNull()
           | (F.col("sellable_stock").isNotNull() & (F.col("sellable_stock") != "") & F.col("_stock").isNull()))
    rejects = s.where(bad).drop("_stock")
    # The sort compares its first key by its leading bytes, in which products differ and countries do not.
    s = latest_per_key(s.where(~bad), ["product_number", "country"], "ingested_at")
    out = s.select(F.lit(month).alias("snapshot_month"),
                   F.col("country").alias("country_code"), "product_number",
                   F.col("_stock").alias("sellable_stock"), "source_file",
                   F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"))
    return out, rejects


def _stock_upsert_args(run_ts: Column) -> dict:
    return dict(update_cols=["sellable_stock", "source_file"],
                stamps={"ingested_at": run_ts.cast("timestamp_ntz")})


STOCK_KEYS = ["snapshot_month", "country_code", "product_number"]


def upsert_stock(current: DataFrame, batch: DataFrame, run_ts: Column,
                 by_partition: bool = False) -> DataFrame:
    """Unconditional overwrite on (snapshot_month, country_code, product_number) (M1).

    ``by_partition=True`` joins only the run month's partition of a stored
    snapshot table partitioned by ``snapshot_month``.
    """
    if by_partition:
        return upsert_partitions(current, batch, STOCK_KEYS, "snapshot_month", **_stock_upsert_args(run_ts))
    return upsert(current, batch, STOCK_KEYS, **_stock_upsert_args(run_ts))


def upsert_stock_touched(current: DataFrame, batch: DataFrame, run_ts: Column
                         ) -> tuple[DataFrame, list]:
    """The run month's new snapshot partition and its value (one month)."""
    return upsert_touched(current, batch, STOCK_KEYS, "snapshot_month", **_stock_upsert_args(run_ts))


def dim_country_code_check(dim_country: DataFrame) -> DataFrame:
    """Q8 for the lookup key of the sales load: duplicated country codes."""
    return duplicate_groups(dim_country, ["country_code"], "Q8.country_code",
                            "warehouse.dim_country: duplicate country_code (should be 0)")
