"""Cleansing and typing of raw text columns.

All functions are permissive: text that does not parse becomes NULL via the
``try_*`` family, so an ANSI-mode session never aborts a load on one bad row.
Callers that need strictness compare the parsed value with the raw text and
raise or route the row to a rejects output (see ``plans.facts``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnOrName) -> Column:
    """``NULLIF(trim(c), '')`` — trim strips spaces only, like the source SQL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def empty_to_null(c: ColumnOrName) -> Column:
    """``NULLIF(c, '')`` without trimming: a blank-only value survives."""
    return F.nullif(_col(c), F.lit(""))


def sentinel_to_null(c: ColumnOrName, sentinels: Iterable[str] = ("", "N/A")) -> Column:
    """Trim, then map each sentinel to NULL (nested ``NULLIF``)."""
    out = F.trim(_col(c))
    for s in sentinels:
        out = F.nullif(out, F.lit(s))
    return out


# The flag vocabularies of the product feed (compared after
# lower(trim(x))).  The bestseller false-set holds a single space, which can
# never match a trimmed value; it is kept as written.
DISCONTINUED_FLAGS = (("@", "ja", "yes", "y", "true", "1"),
                      ("active", "nein", "no", "n", "false", "0"))
BESTSELLER_FLAGS = (("yes", "ja", "y", "true", "1"),
                    ("no", "nein", "n", "false", "0", " "))
KF_FLAGS = (("ja", "yes", "y", "true", "1"),
            ("nein", "no", "n", "false", "0"))


def parse_flag(c: ColumnOrName, true_values: Iterable[str], false_values: Iterable[str]) -> Column:
    """Multilingual flag -> boolean; anything else (and NULL) -> NULL."""
    v = F.lower(F.trim(_col(c)))
    return (F.when(v.isin(list(true_values)), F.lit(True))
             .when(v.isin(list(false_values)), F.lit(False))
             .otherwise(F.lit(None).cast("boolean")))


def parse_decimal(c: ColumnOrName, precision: int = 18, scale: int = 4,
                  trim: bool = False) -> Column:
    """``NULLIF(c, '')`` then a permissive cast to ``decimal(p, s)``.

    Rounds half away from zero, as the target store does.  The cast itself makes
    empty text NULL; a ``nullif`` would compute a derived ``c`` twice.
    """
    v = F.trim(_col(c)) if trim else _col(c)
    return v.try_cast(f"decimal({precision},{scale})")


def parse_money(c: ColumnOrName, precision: int = 18, scale: int = 2,
                decimal_comma: bool = False, symbols: str = "€") -> Column:
    """Money text -> decimal: strip currency symbols and thousands marks,
    trim, map ``'-'`` to NULL, cast permissively.

    By default commas are thousands marks (``1.234,56`` becomes ``1.23456``,
    as in the source).  ``decimal_comma=True`` reads ``1.234,56`` as 1234.56.
    """
    v = _col(c)
    if decimal_comma:
        v = F.translate(v, symbols + ".", "")
        v = F.translate(v, ",", ".")
    else:
        v = F.translate(v, symbols + ",", "")
    v = F.nullif(F.trim(v), F.lit("-"))
    return F.nullif(v, F.lit("")).try_cast(f"decimal({precision},{scale})")


# Anchored with \z, not $: Java's $ also accepts a trailing newline.
NUMERIC_TEXT = r"^-?\d+(\.\d+)?\z"


def is_numeric_text(c: ColumnOrName) -> Column:
    """True when the trimmed text is a plain decimal number."""
    return F.trim(_col(c)).rlike(NUMERIC_TEXT)


def parse_timestamp(c: ColumnOrName, formats: Iterable[str] | None = None,
                    sentinels: Iterable[str] = ("", "N/A")) -> Column:
    """Text -> ``timestamp_ntz``; sentinels and bad text -> NULL.

    Without ``formats`` the text is cast like the source's ``::timestamp``:
    ISO dates with a ``T`` or a space before the time, or a bare date.  The
    cast does not throw on a miss, so it is cheap on dirty feeds.  With
    ``formats`` the first pattern that matches the whole text wins.
    """
    sentinels = tuple(sentinels)
    if not formats and sentinels == ("", "N/A"):  # the cast makes them NULL, and reads the text once
        return F.trim(_col(c)).try_cast("timestamp_ntz")
    v = sentinel_to_null(c, sentinels)
    if not formats:
        return v.try_cast("timestamp_ntz")
    parsed = [F.try_to_timestamp(v, F.lit(fmt)) for fmt in formats]
    out = parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)
    return out.cast("timestamp_ntz")


def parse_date(c: ColumnOrName, formats: Iterable[str] | None = None,
               sentinels: Iterable[str] = ("", "N/A")) -> Column:
    return parse_timestamp(c, formats, sentinels).cast("date")


def normalize_code(c: ColumnOrName, aliases: Mapping[str, str] | None = None) -> Column:
    """``upper(trim(c))``, blanks -> NULL, then known aliases (e.g. PO -> PL)."""
    v = F.nullif(F.upper(F.trim(_col(c))), F.lit(""))
    for old, new in (aliases or {}).items():
        v = F.when(v == F.lit(old), F.lit(new)).otherwise(v)
    return v
