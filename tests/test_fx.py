"""Monthly FX rates (F1-F8, A8-A10) on the FIXTURES.md rate cases."""

import datetime as dt
import json
import os
from decimal import Decimal

from martspark.operators import fx
from martspark.sources.feeds import read_rate_payloads
from tests.conftest import rows

D = dt.date
Q = "rate_date date, currency_code string, rate decimal(18,8)"


def quotes(spark, data):
    return spark.createDataFrame([(d, c, Decimal(str(r))) for d, c, r in data], Q)


def test_inverse_of_mean_not_mean_of_inverses(spark):
    r, rej = fx.monthly_inverse_mean(quotes(spark, [(D(2025, 12, 1), "DKK", 7.4), (D(2025, 12, 2), "DKK", 7.6)]))
    assert rows(r, "currency_code", "avg_rate_to_eur", "obs_count") == [("DKK", Decimal("0.13333333"), 2)]
    assert rej.count() == 0


def test_zero_mean_is_rejected_not_failed(spark):
    r, rej = fx.monthly_inverse_mean(quotes(spark, [(D(2025, 12, 1), "XXX", 0.0)]))
    assert r.count() == 0 and rej.count() == 1  # D21


def test_base_rows_for_every_month_with_a_rate(spark):
    r, _ = fx.monthly_inverse_mean(quotes(spark, [(D(2025, 11, 3), "SEK", 11.0), (D(2025, 12, 1), "SEK", 10.0),
                                                  (D(2025, 12, 2), "EUR", 3.0)]))
    got = rows(fx.with_base_rows(r), "month_sk", "currency_code", "avg_rate_to_eur", "obs_count")
    assert (D(2025, 11, 1), "EUR", Decimal("1.00000000"), 1) in got
    assert (D(2025, 12, 1), "EUR", Decimal("1.00000000"), 1) in got
    assert len(got) == 4


def test_fallback_is_per_month_and_currency(spark):
    primary = quotes(spark, [(D(2025, 12, 1), "SEK", 10.0)])
    secondary = quotes(spark, [(D(2025, 12, d), "SEK", 20.0) for d in range(1, 21)]
                       + [(D(2025, 12, 1), "RSD", 117.0)])
    countries = spark.createDataFrame([("Sweden", "SE", "SEK"), ("Serbia", "RS", "RSD"), ("Spain", "ES", "EUR")],
                                      "country_name string, country_code string, currency_code string")
    rates, _ = fx.monthly_rates(primary, countries, secondary=secondary)
    got = {r.currency_code: (r.avg_rate_to_eur, r.obs_count) for r in rates.collect()}
    assert got["SEK"] == (Decimal("0.10000000"), 1)  # the one primary day only
    assert got["RSD"][1] == 1 and got["EUR"] == (Decimal("1.00000000"), 1)
    sup = spark.createDataFrame([("RSD",)], "currency_code string")
    rates2, _ = fx.monthly_rates(primary, countries, secondary=secondary, supported=sup)
    got2 = {r.currency_code: r.obs_count for r in rates2.collect()}
    assert got2["SEK"] == 20  # not supported by the primary -> secondary only


def test_missing_months_listed(spark):
    r, _ = fx.monthly_inverse_mean(quotes(spark, [(D(2025, 12, 1), "SEK", 10.0)]))
    req = spark.createDataFrame([(D(2025, 11, 1),), (D(2025, 12, 1),)], "month_sk date")
    assert rows(fx.missing_months(req, r)) == [(D(2025, 11, 1),)]


def test_manual_rates(spark):
    months = spark.createDataFrame([(m,) for m in fx.month_range(D(2024, 1, 1), D(2025, 12, 1))], "month_sk date")
    m = fx.manual_rates(months)
    assert m.count() == 48
    assert rows(m.where("currency_code = 'COP'"), "avg_rate_to_eur", "obs_count", "source")[0] == (
        Decimal("0.00023000"), 0, "manual_fixed")


def test_rate_payload_json(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rates.json")
    with open(path, "w") as f:
        f.write(json.dumps({"base": "EUR", "rates": {"2025-12-01": {"DKK": 7.4, "SEK": 11.0},
                                                    "2025-12-02": {"DKK": 7.6}}}) + "\n")
    q = fx.explode_rate_payload(read_rate_payloads(spark, path))
    assert q.count() == 3
    r, _ = fx.monthly_inverse_mean(q)
    assert dict(rows(r, "currency_code", "avg_rate_to_eur"))["DKK"] == Decimal("0.13333333")


def test_country_list_parameter(spark):
    assert fx.clean_country_codes([" se", "po", "", "SE", "xx "]) == ["SE", "PL", "XX"]
    countries = spark.createDataFrame([("Sweden", "SE", "SEK"), ("Poland", "PL", "PLN"), ("Norway", "NO", "NOK")],
                                      "country_name string, country_code string, currency_code string")
    q = quotes(spark, [(D(2025, 12, 1), c, 10.0) for c in ["SEK", "PLN", "NOK"]])
    r, _ = fx.monthly_rates(q, countries, countries=["se", "PO", "ZZ"])
    assert sorted(x.currency_code for x in r.collect()) == ["EUR", "PLN", "SEK"]  # ZZ unknown: ignored


def test_coverage_report(spark):
    r, _ = fx.monthly_inverse_mean(quotes(spark, [(D(2025, 12, 1), "SEK", 10.0), (D(2025, 12, 2), "DKK", 7.0)]))
    req = spark.createDataFrame([(D(2025, 11, 1),), (D(2025, 12, 1),)], "month_sk date")
    assert rows(fx.coverage_report(req, fx.with_base_rows(r))) == [
        (D(2025, 11, 1), "missing", 0), (D(2025, 12, 1), "loaded", 3)]
