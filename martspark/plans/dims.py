"""Dimension loads (E1-E4).  Each returns the new dimension state, lazily."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark import schemas
from martspark.functions.clean import (BESTSELLER_FLAGS, DISCONTINUED_FLAGS, KF_FLAGS,
                                       blank_to_null, parse_flag, parse_money)
from martspark.operators.dedup import keep_first, latest_per_key, priority_rank
from martspark.operators.merge import upsert
from martspark.operators.series import calendar, date_series
from martspark.operators.surrogate import assign_surrogate
from martspark.sources.seeds import STATUS_FALLBACK_RANK, STATUS_PRIORITY

PRODUCT_ATTRS = ["product_name", "category1", "category2", "category3", "season",
                 "discontinued", "bestseller_abas", "kf", "uvp_de", "uvp_eu", "franchise_price"]


def empty(spark: SparkSession, name: str) -> DataFrame:
    return schemas.empty_frame(spark, schemas.WAREHOUSE[name])


def clean_products(product_raw: DataFrame, decimal_comma: bool = False) -> DataFrame:
    """Latest staging row per trimmed product number, cleaned (E3 input).

    The key is trimmed *before* keep-first so ``' A'`` and ``'A'`` are one
    product (D7); a NULL ``load_run_ts`` sorts first, i.e. wins (D8).
    """
    p = product_raw.withColumn("_pn", blank_to_null("product_number")).where(F.col("_pn").isNotNull())
    p = latest_per_key(p, ["_pn"], "load_run_ts")
    money = lambda c: parse_money(c, 18, 2, decimal_comma=decimal_comma)
    return p.select(
        F.col("_pn").alias("product_number"),
        blank_to_null("product_name").alias("product_name"),
        blank_to_null("classification1").alias("category1"),
        blank_to_null("classification2").alias("category2"),
        blank_to_null("classification3").alias("category3"),
        blank_to_null("season").alias("season"),
        parse_flag("discontinued", *DISCONTINUED_FLAGS).alias("discontinued"),
        parse_flag("bestseller_abas", *BESTSELLER_FLAGS).alias("bestseller_abas"),
        parse_flag("kf", *KF_FLAGS).alias("kf"),
        money("uvp_de").alias("uvp_de"),
        money("uvp_eu").alias("uvp_eu"),
        money("franchise_price").alias("franchise_price"),
    )


MONEY_COLS = ["uvp_de", "uvp_eu", "franchise_price"]


def product_rejects(product_raw: DataFrame) -> DataFrame:
    """Product rows whose money text is present but does not parse.

    The load itself is permissive (such prices become NULL); a strict run
    refuses to publish while this is non-empty.  ``'-'`` means "no price"
    and is not a reject.
    """
    bad = None
    for c in MONEY_COLS:
        txt = F.nullif(F.trim(F.translate(F.col(c), "€,", "")), F.lit("-"))
        cond = F.coalesce(F.nullif(txt, F.lit("")).isNotNull() & parse_money(c).isNull(), F.lit(False))
        # an empty string is also a reject in strict mode: the source cast fails on it
        cond = cond | F.coalesce(F.trim(F.col(c)) == F.lit(""), F.lit(False))
        bad = cond if bad is None else bad | cond
    return product_raw.where(bad)


def load_dim_product(product_raw: DataFrame, current: DataFrame, run_ts: Column) -> DataFrame:
    """SCD type 1: every product in staging overwrites its attributes (M1);
    new products get the next surrogate keys, existing ones keep theirs (K3)."""
    src = clean_products(product_raw).withColumn("product_sk", F.lit(None).cast("bigint"))
    merged = upsert(current, src, ["product_number"], PRODUCT_ATTRS,
                    stamps={"last_updated_at": run_ts.cast("timestamp_ntz")})
    keyed = assign_surrogate(merged, "product_number", "product_sk",
                             existing=current.select("product_number", "product_sk"))
    return keyed.select(*current.columns)


def load_dim_country(seed: DataFrame, current: DataFrame) -> DataFrame:
    """Upsert on country name; codes are overwritten."""
    src = seed.withColumn("country_sk", F.lit(None).cast("bigint"))
    merged = upsert(current, src, ["country_name"], ["country_code", "currency_code"])
    keyed = assign_surrogate(merged, "country_name", "country_sk",
                             existing=current.select("country_name", "country_sk"))
    return keyed.select(*current.columns)


def load_dim_date(spark: SparkSession, start: dt.date, stop: dt.date, current: DataFrame) -> DataFrame:
    """Calendar rows, inserted once."""
    days = calendar(date_series(spark, start, stop))
    return upsert(current, days, ["date_sk"], on_match="keep")


def conform_status_map(literals: DataFrame) -> DataFrame:
    """Raw literals -> one standard code per (trimmed) raw status.

    When a raw status has several candidate codes the business priority
    decides; codes without a priority share the fallback rank and the
    alphabetically first wins.
    """
    t = literals.select(F.trim("raw_status").alias("raw_status"), "status_std")
    t = t.withColumn("_rank", priority_rank("status_std", STATUS_PRIORITY, STATUS_FALLBACK_RANK))
    return keep_first(t, ["raw_status"], [F.col("_rank").asc(), F.col("status_std").asc()],
                      ["_rank", "status_std"]).drop("_rank")


def load_status_map(literals: DataFrame, current: DataFrame) -> DataFrame:
    return upsert(current, conform_status_map(literals), ["raw_status"], ["status_std"])
