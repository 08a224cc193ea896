"""Monthly FX rates from daily quotes.

Quotes are ``(rate_date, currency_code, rate)`` with ``rate`` = units of the
currency per 1 EUR.  The monthly rate to EUR is the inverse of the monthly
mean quote (not the mean of inverses), computed in decimal so the result is
the same whatever the partitioning or summation order.

Shuffles: one partial+final aggregate on (month, currency).  The relations
joined here — needed currencies, supported currencies, (month, currency)
pairs present in the primary source — are bounded by #currencies (ISO 4217
has under 200) times #months, so broadcasting them is safe at any data size.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martspark.sources.seeds import BASE_CURRENCY, COUNTRY_ALIASES, MANUAL_RATES, MANUAL_SOURCE

RATE_TYPE = "decimal(18,8)"
QUOTE_TYPE = "decimal(18,8)"


def explode_rate_payload(payload: DataFrame, rates_col: str = "rates") -> DataFrame:
    """Nested ``{date: {currency: quote}}`` -> one row per (date, currency) (F1)."""
    by_day = payload.select(F.explode(F.col(rates_col)).alias("rate_date", "_cur_map"))
    return by_day.select(
        F.col("rate_date").cast("date").alias("rate_date"),
        F.explode("_cur_map").alias("currency_code", "rate"),
    ).select("rate_date", "currency_code", F.col("rate").cast(QUOTE_TYPE).alias("rate"))


def restrict_currencies(quotes: DataFrame, currencies: DataFrame) -> DataFrame:
    """Keep quotes of the listed currencies (semi-join on a bounded list, J7)."""
    cur = currencies.select("currency_code").distinct()
    return quotes.join(F.broadcast(cur), "currency_code", "left_semi")


def needed_currencies(dim_country: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """Distinct currencies the countries need, without the base."""
    return (dim_country.select("currency_code").where(F.col("currency_code") != base)
            .distinct())


def with_month(quotes: DataFrame, date_col: str = "rate_date") -> DataFrame:
    return quotes.withColumn("month_sk", F.trunc(F.col(date_col).cast("date"), "month"))


def prefer_primary(primary: DataFrame, secondary: DataFrame,
                   supported: DataFrame | None = None) -> DataFrame:
    """Source preference per (month, currency).

    Currencies outside ``supported`` are taken from the secondary source
    only.  For the rest the secondary source is used for a (month, currency)
    only when the primary has no quote at all for it in that month.
    """
    p = with_month(primary)
    s = with_month(secondary)
    if supported is not None:
        p = restrict_currencies(p, supported)
    present = p.select("month_sk", "currency_code").distinct()
    fallback = s.join(F.broadcast(present), ["month_sk", "currency_code"], "left_anti")
    cols = ["rate_date", "month_sk", "currency_code", "rate"]
    return p.select(*cols).unionByName(fallback.select(*cols))


def monthly_inverse_mean(quotes: DataFrame, source: str = "monthly_avg",
                         base: str = BASE_CURRENCY) -> tuple[DataFrame, DataFrame]:
    """``1 / mean(quote)`` per (month, currency) with the observation count.

    Returns ``(rates, rejects)``; a zero mean gives no rate and lands in
    ``rejects`` instead of failing the run (D21).  Base-currency quotes are
    dropped: the base row is forced to 1 by ``with_base_rows``.
    """
    q = quotes if "month_sk" in quotes.columns else with_month(quotes)
    q = q.where(F.col("currency_code") != base)
    agg = q.groupBy("month_sk", "currency_code").agg(
        F.sum(F.col("rate").cast(QUOTE_TYPE)).cast("decimal(28,8)").alias("_sum"),
        F.count("rate").alias("_n"))
    return inverse_mean(agg, source)


def inverse_mean(agg: DataFrame, source: str = "monthly_avg") -> tuple[DataFrame, DataFrame]:
    """Rates and rejects from the sum (``_sum``) and number (``_n``) of a month's quotes."""
    inv = F.try_divide(F.col("_n").cast("decimal(10,0)"), F.col("_sum"))
    out = agg.select(
        "month_sk", "currency_code",
        inv.cast(RATE_TYPE).alias("avg_rate_to_eur"),
        F.col("_n").cast("int").alias("obs_count"),
        F.lit(source).alias("source"))
    return (out.where(F.col("avg_rate_to_eur").isNotNull()),
            out.where(F.col("avg_rate_to_eur").isNull()))


def with_base_rows(rates: DataFrame, months: DataFrame | None = None,
                   base: str = BASE_CURRENCY, source: str = "monthly_avg") -> DataFrame:
    """Add the base currency at 1.0 (count 1) for every month.

    ``months`` defaults to the months that have any rate: each rate row also
    emits its month's base row and duplicates collapse in a small aggregate,
    so the quotes are aggregated once, not once per branch.
    """
    def base_row(m):
        return F.struct(m.alias("month_sk"), F.lit(base).alias("currency_code"),
                        F.lit(1).cast(RATE_TYPE).alias("avg_rate_to_eur"),
                        F.lit(1).alias("obs_count"), F.lit(source).alias("source"))
    cols = ["month_sk", "currency_code", "avg_rate_to_eur", "obs_count", "source"]
    non_base = rates.where(F.col("currency_code") != base)
    if months is not None:
        base_rows = months.select("month_sk").distinct().select(base_row(F.col("month_sk")).alias("_r"))
        return non_base.select(*cols).unionByName(base_rows.select("_r.*"))
    both = non_base.select(F.explode(F.array(
        F.struct(*[F.col(c) for c in cols]), base_row(F.col("month_sk")))).alias("_r")).select("_r.*")
    return both.dropDuplicates()


def clean_country_codes(codes: list[str], aliases: dict[str, str] | None = None) -> list[str]:
    """Country-code list parameter: strip, upper-case, drop blanks, apply
    aliases (e.g. PO -> PL), keep first occurrence order (C21)."""
    aliases = COUNTRY_ALIASES if aliases is None else aliases
    out = []
    for c in codes:
        c = c.strip().upper()
        c = aliases.get(c, c)
        if c and c not in out:
            out.append(c)
    return out


def monthly_rates(primary: DataFrame, dim_country: DataFrame, secondary: DataFrame | None = None,
                  supported: DataFrame | None = None, source: str = "monthly_avg",
                  base: str = BASE_CURRENCY, countries: list[str] | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """The whole FX job: needed currencies, source preference, inverse mean,
    base rows.  Returns ``(fx_rates_monthly, rejects)``.

    ``countries`` restricts the needed currencies to those country codes
    (cleaned by ``clean_country_codes``; codes unknown to ``dim_country``
    are ignored, C22)."""
    if countries is not None:
        dim_country = dim_country.where(F.col("country_code").isin(clean_country_codes(countries)))
    need = needed_currencies(dim_country, base)
    p = restrict_currencies(primary, need)
    if secondary is not None:
        quotes = prefer_primary(p, restrict_currencies(secondary, need), supported)
    else:
        quotes = with_month(p if supported is None else restrict_currencies(p, supported))
    rates, rejects = monthly_inverse_mean(quotes, source, base)
    return with_base_rows(rates, base=base, source=source), rejects


def missing_months(requested_months: DataFrame, rates: DataFrame) -> DataFrame:
    """Requested months with no rate at all (F6, M8): skipped and listed."""
    have = rates.select("month_sk").distinct()
    return requested_months.select("month_sk").distinct().join(have, "month_sk", "left_anti")


def coverage_report(requested_months: DataFrame, rates: DataFrame) -> DataFrame:
    """Per requested month: ``loaded`` with its rate rows, or ``missing``."""
    per_month = rates.groupBy("month_sk").agg(F.count(F.lit(1)).alias("rate_rows"))
    out = requested_months.select("month_sk").distinct().join(per_month, "month_sk", "left")
    return out.select("month_sk",
                      F.when(F.col("rate_rows").isNull(), F.lit("missing")).otherwise(F.lit("loaded"))
                      .alias("status"),
                      F.coalesce(F.col("rate_rows"), F.lit(0)).alias("rate_rows"))


def manual_rates(months: DataFrame, rates=MANUAL_RATES, source: str = MANUAL_SOURCE) -> DataFrame:
    """Months x fixed (currency, rate) rows, count 0.

    The handful of literal rates is exploded per month, so no join is
    planned and the output grows linearly with the months.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(r).cast(RATE_TYPE).alias("r"))
                        for c, r in rates])
    return months.select("month_sk", F.explode(entries).alias("_e")).select(
        "month_sk", F.col("_e.c").alias("currency_code"), F.col("_e.r").alias("avg_rate_to_eur"),
        F.lit(0).alias("obs_count"), F.lit(source).alias("source"))


def next_month(day: dt.date) -> dt.date:
    """First day of the following month."""
    return dt.date(day.year + (day.month == 12), day.month % 12 + 1, 1)


def month_range(start: dt.date, stop: dt.date) -> list[dt.date]:
    out, y, m = [], start.year, start.month
    while (y, m) <= (stop.year, stop.month):
        out.append(dt.date(y, m, 1))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out
