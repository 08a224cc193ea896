"""Hash keys (K1, K2): md5 hex of ``'|'``-joined text, NULL read as ''."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*cols: Column | str, sep: str = "|", escape: bool = False) -> Column:
    """``md5(coalesce(a,'') || sep || coalesce(b,'') ...)``.

    ``concat_ws`` skips NULLs, so every part is coalesced first to keep the
    positions.  ``escape=True`` doubles backslashes and escapes the separator
    so that values holding the separator cannot collide.
    """
    parts = []
    for c in cols:
        v = F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
        if escape:
            v = F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit(sep), F.lit("\\" + sep))
        parts.append(v)
    return F.md5(F.concat_ws(sep, *parts))
