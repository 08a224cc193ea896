"""Monthly rates from a stored, mergeable state of the quotes.

The state holds, per source, day, currency and delivery, the sum and the number of the
quotes (at most days x currencies rows, partitioned by month).  Merging
is associative, commutative and idempotent:

* a *late* day is added;
* a day delivered again is *corrected*: the latest ``delivered_at`` of a (source, day,
  currency) replaces earlier ones;
* parts of one delivery that arrive apart add up, and a part that is merged
  twice (a retry) counts once, by its ``part`` name.

So the quotes may be split and ordered in any way, and the rates equal those of
``fx.monthly_rates`` over the quotes of the latest deliveries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martspark.operators import fx
from martspark.sources.seeds import BASE_CURRENCY

PRIMARY, SECONDARY = "primary", "secondary"
DAY = ["quote_source", "month_sk", "rate_date", "currency_code"]
PART = ["delivered_at", "part"]


def day_state(quotes: DataFrame, source: str, part: str | Column) -> DataFrame:
    """Quotes (rate_date, currency_code, rate, delivered_at) -> state rows.

    One partial aggregate; ``quotes`` counts rows, ``quoted`` rates that are not NULL.
    """
    name = F.lit(part) if isinstance(part, str) else part
    q = fx.with_month(quotes).select(
        F.lit(source).alias("quote_source"), "month_sk", F.col("rate_date").cast("date").alias("rate_date"),
        "currency_code", F.col("delivered_at").cast("timestamp_ntz").alias("delivered_at"),
        name.alias("part"), F.col("rate").cast(fx.QUOTE_TYPE).alias("rate"))
    return q.groupBy(*DAY, *PART).agg(F.sum("rate").cast("decimal(28,8)").alias("total"),
                                      F.count("rate").alias("quoted"), F.count(F.lit(1)).alias("quotes"))


def _same(cols: list[str], a: str, b: str) -> Column:
    out = None
    for c in cols:
        e = F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
        out = e if out is None else out & e
    return out


def merge_days(state: DataFrame, new: DataFrame) -> DataFrame:
    """The state after ``new``.  A (source, day, currency) has as many rows as its
    latest delivery has parts."""
    old = state.alias("o").join(new.select(*DAY, *PART).alias("n"), _same(DAY + PART, "o", "n"), "left_anti")
    both = old.unionByName(new)
    last = F.max("delivered_at").over(Window.partitionBy(*DAY))
    return (both.withColumn("_last", last).where(F.col("delivered_at").eqNullSafe(F.col("_last")))
            .drop("_last"))


def monthly_state(days: DataFrame) -> DataFrame:
    """Rows (quote_source, month_sk, currency_code, _sum, _n, _quotes)."""
    return days.groupBy("quote_source", "month_sk", "currency_code").agg(
        F.sum("total").cast("decimal(28,8)").alias("_sum"), F.sum("quoted").alias("_n"),
        F.sum("quotes").alias("_quotes"))


def rates_from_state(months: DataFrame, dim_country: DataFrame, supported: DataFrame | None = None,
                     source: str = "monthly_avg", base: str = BASE_CURRENCY) -> tuple[DataFrame, DataFrame]:
    """(rates, rejects) as ``fx.monthly_rates`` gives them: needed currencies, the primary source
    unless it has no quote of a (month, currency), inverse mean, base rows."""
    need = fx.restrict_currencies(months, fx.needed_currencies(dim_country, base))
    p = need.where(F.col("quote_source") == PRIMARY)
    if supported is not None:
        p = fx.restrict_currencies(p, supported)
    s = need.where(F.col("quote_source") == SECONDARY)
    fallback = s.join(p.select("month_sk", "currency_code"), ["month_sk", "currency_code"], "left_anti")
    cols = ["month_sk", "currency_code", "_sum", "_n"]
    rates, rejects = fx.inverse_mean(p.select(*cols).unionByName(fallback.select(*cols)), source)
    return fx.with_base_rows(rates, base=base, source=source), rejects
