"""Column functions: cleansing, flags, money, timestamps, hashes."""

import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from martspark.functions import (BESTSELLER_FLAGS, DISCONTINUED_FLAGS, KF_FLAGS, blank_to_null,
                                 empty_to_null, hash_key, is_numeric_text, normalize_code,
                                 parse_decimal, parse_flag, parse_money, parse_timestamp,
                                 sentinel_to_null)
from martspark.functions.dates import lookback_start


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_blank_and_sentinel(spark):
    vals = ["  a ", "   ", "", None, " N/A ", "\tb"]
    assert one_col(spark, vals, blank_to_null) == ["a", None, None, None, "N/A", "\tb"]  # tabs kept
    assert one_col(spark, vals, sentinel_to_null) == ["a", None, None, None, None, "\tb"]
    assert one_col(spark, ["", " ", None], empty_to_null) == [None, " ", None]  # P8 / D15


def test_flags_vocabularies(spark):
    vals = ["@", " Ja ", "ACTIVE", "nein", "x", None, " ", "1", "0"]
    disc = one_col(spark, vals, lambda c: parse_flag(c, *DISCONTINUED_FLAGS))
    best = one_col(spark, vals, lambda c: parse_flag(c, *BESTSELLER_FLAGS))
    kf = one_col(spark, vals, lambda c: parse_flag(c, *KF_FLAGS))
    assert disc == [True, True, False, False, None, None, None, True, False]
    assert best == [None, True, None, False, None, None, None, True, False]  # blank never matches
    assert kf == [None, True, None, False, None, None, None, True, False]


def test_parse_money(spark):
    vals = ["€1,234.50", "-", "1.005", "", None, " €9 ", "-1.005", "abc"]
    got = one_col(spark, vals, parse_money)
    assert got == [Decimal("1234.50"), None, Decimal("1.01"), None, None, Decimal("9.00"),
                   Decimal("-1.01"), None]
    # Commas are thousands marks by default; decimal_comma reads them as decimals.
    assert one_col(spark, ["1.234,56"], parse_money) == [Decimal("1.23")]
    assert one_col(spark, ["1.234,56"], lambda c: parse_money(c, decimal_comma=True)) == [Decimal("1234.56")]


def test_numeric_text_anchor(spark):
    vals = ["12", "-1.5", "1,5", "1.", "12\n", " 7 ", "+3"]
    assert one_col(spark, vals, is_numeric_text) == [True, True, False, False, False, True, False]


def test_parse_decimal_permissive(spark):
    assert one_col(spark, ["1.00005", "", "x", None], lambda c: parse_decimal(c, 18, 4)) == [
        Decimal("1.0001"), None, None, None]


def test_parse_timestamp(spark):
    vals = ["2025-12-05T10:00:00", "2025-12-05 10:00:00", "2025-12-05", "N/A", "", "bad", None]
    got = one_col(spark, vals, parse_timestamp)
    t = dt.datetime(2025, 12, 5, 10)
    assert got == [t, t, dt.datetime(2025, 12, 5), None, None, None, None]
    strict = one_col(spark, vals, lambda c: parse_timestamp(c, ("yyyy-MM-dd'T'HH:mm:ss",)))
    assert strict == [t, None, None, None, None, None, None]  # D20: fixed format


def test_hash_key_positions(spark):
    df = spark.createDataFrame([("a", None, "b")], "x string, y string, z string")
    got = df.select(hash_key("x", "y", "z")).first()[0]
    assert got == hashlib.md5(b"a||b").hexdigest()
    esc = df.select(hash_key("x", "y", "z", escape=True)).first()[0]
    assert esc == hashlib.md5(b"a||b").hexdigest()
    df2 = spark.createDataFrame([("a|", "b"), ("a", "|b")], "x string, y string")
    plain = [r[0] for r in df2.select(hash_key("x", "y")).collect()]
    escaped = [r[0] for r in df2.select(hash_key("x", "y", escape=True)).collect()]
    assert plain[0] == plain[1] and escaped[0] != escaped[1]  # D30


def test_normalize_code(spark):
    assert one_col(spark, [" po", "se ", "  ", None], lambda c: normalize_code(c, {"PO": "PL"})) == [
        "PL", "SE", None, None]


def test_lookback_start():
    assert lookback_start(dt.date(2026, 1, 20), 1) == dt.date(2025, 12, 1)
    assert lookback_start(dt.date(2026, 3, 31), 1) == dt.date(2026, 2, 1)
    assert lookback_start(dt.date(2026, 1, 1), 13) == dt.date(2024, 12, 1)
