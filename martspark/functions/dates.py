"""Calendar helpers (C13-C16, C19, C20).  No clock reads: dates are passed in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def month_start(c: Column | str) -> Column:
    """``date_trunc('month', d)::date`` — ``trunc`` returns a DATE."""
    return F.trunc(_col(c).cast("date"), "month")


def first_day_of_month(c: Column | str) -> Column:
    return month_start(c)


def last_day_of_month(c: Column | str) -> Column:
    return F.last_day(_col(c).cast("date"))


def months_back(c: Column | str, n: int | Column) -> Column:
    """``d - n months`` with the day clamped to the month's end."""
    return F.add_months(_col(c).cast("date"), -n if isinstance(n, int) else -n)


def lookback_start(as_of: dt.date, months: int) -> dt.date:
    """First day of the month ``months`` before ``as_of``'s month.

    Computed on the driver so the filter compares a bare column with a
    literal (the only form the parquet reader can push down).
    """
    y, m = as_of.year, as_of.month - months
    while m <= 0:
        y, m = y - 1, m + 12
    return dt.date(y, m, 1)


def ntz_lit(value: dt.datetime | dt.date | str) -> Column:
    """A ``timestamp_ntz`` literal that does not depend on any time zone.

    Built from the ISO text: a naive Python datetime passed to ``lit`` would
    be shifted through the process and session zones.
    """
    if isinstance(value, dt.datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = value
    return F.lit(text).cast("timestamp_ntz")
