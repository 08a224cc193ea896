"""Keep-first per key (A6, A7, M7): ``DISTINCT ON (k) ... ORDER BY k, ...``.

Built as ``row_number() == 1`` over a window.  Catalyst turns this into a
``WindowGroupLimit`` that keeps one row per key *inside each map task before
the shuffle*, so a key holding a third of all rows still ships at most one
row per map task; the final window only sorts those survivors.

Ties are never left open: after the caller's order, every remaining column
breaks ties (ascending, NULLs first), so the choice does not depend on input
order or partitioning.

``latest_per_key`` ships a row's texts as one (``pack``): in Spark's row format every text
takes a word for its place and length and is padded to words, and that hardly compresses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

_RN = "__keep_first_rn"
_PACK = "__packed_"
MIN_PACK = 4  # fewer texts side by side stay as they are
# Bytes of a packed text.  ESC starts every escape and is nothing else, END is nowhere inside a field.
END, ESC = "\x00", "\x01"
EMPTY, NUL, SOH = ESC + "\x01", ESC + "\x02", ESC + "\x03"


def _orderable(df: DataFrame, name: str) -> bool:
    return not isinstance(df.schema[name].dataType, MapType)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (),
               order_names: Sequence[str] = (), tie_break: bool = True) -> DataFrame:
    """One row per ``keys``: the first by ``order``, then by all other columns.

    ``order_names`` lists the columns ``order`` already covers, so they are
    not repeated in the tie-break.
    """
    order = list(order)
    if tie_break:
        used = set(keys) | set(order_names)
        order += [F.col(c).asc_nulls_first() for c in df.columns
                  if c not in used and _orderable(df, c)]
    if not order:
        order = [F.lit(1)]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def pack(cols: Sequence[str]) -> Column:
    """Texts as one text that sorts as they do, one after the other, ascending and NULLs first.

    A field ends with the lowest byte, which is escaped inside it; NULL is written as nothing,
    '' as an escape of its own.  Nothing is lost, whatever bytes the texts hold.  A row that holds END or
    ESC is escaped in hex, where bytes are told apart; functions of functions would not be compiled here."""
    bare = F.concat_ws("", *cols)
    odd = F.contains(bare, F.lit(END)) | F.contains(bare, F.lit(ESC))
    plain = F.concat_ws(END, *[F.when(F.col(c) == "", F.lit(EMPTY)).otherwise(F.coalesce(F.col(c), F.lit("")))
                               for c in cols])
    digits = F.concat_ws("|", *[F.when(F.col(c) == "", F.lit("e")).otherwise(F.coalesce(F.hex(F.col(c)), F.lit("")))
                                for c in cols])
    digits = F.regexp_replace(digits, "([0-9A-F]{2})", "$1,")  # one byte after the other
    for byte, new in (("01,", "01,03,"), ("00,", "01,02,"), ("e", "01,01,"), ("|", "00,"), (",", "")):
        digits = F.replace(digits, F.lit(byte), F.lit(new))
    return F.when(odd, F.unhex(digits).cast("string")).otherwise(plain)


def unpack(df: DataFrame, packed: str, cols: Sequence[str]) -> DataFrame:
    """``df`` with the texts of ``pack(cols)`` in the place of ``packed``.

    ``split`` reads characters, so a text that is no UTF-8 is cut by its bytes, and so is one with escapes, by a
    function Spark does not inline: this projection is compiled by itself and does not make the method around it too
    long for the JIT."""
    p = F.col(packed)

    def cut(i: Column) -> Column:
        head = F.call_function("substring_index", p, F.lit(END), i)
        t = F.call_function("substring_index", head, F.lit(END), F.lit(-1))
        plain = F.replace(F.replace(t, F.lit(NUL), F.lit(END)), F.lit(SOH), F.lit(ESC))
        return F.when(t == EMPTY, t).when(plain != EMPTY, plain)  # NULL: a text that is EMPTY itself
    odd = F.contains(p, F.lit(NUL)) | F.contains(p, F.lit(SOH)) | ~F.is_valid_utf8(p)
    parts = F.when(odd, F.transform(F.sequence(F.lit(1), F.lit(len(cols))), cut)).otherwise(F.split(p, END, -1))

    def text(t: Column) -> Column:
        return F.when(t.isNull(), F.lit(EMPTY)).when(t == "", F.lit(None)).when(t == EMPTY, F.lit("")).otherwise(t)
    return df.select(*[F.col(c) for c in df.columns if c != packed], *[
        text(parts[i]).alias(c) for i, c in enumerate(cols)])


def _text_runs(df: DataFrame, but: set[str]) -> list[list[str]]:
    """Columns outside ``but`` that stand side by side in the tie-break and hold plain texts."""
    runs = [[]]
    for f in df.schema.fields:
        if f.name in but:
            continue
        if f.dataType == StringType():  # not one with a collation, which sorts otherwise
            runs[-1].append(f.name)
        elif not isinstance(f.dataType, MapType):
            runs.append([])
    return [r for r in runs if len(r) >= MIN_PACK]


def latest_per_key(df: DataFrame, keys: Sequence[str], ts_col: str,
                   nulls_first: bool = True, tie_break: bool = True) -> DataFrame:
    """Latest ``ts_col`` wins.  ``DESC`` puts NULL times first by default,
    the source database's rule (Spark's own default is NULLs last)."""
    ts = F.col(ts_col)
    o = ts.desc_nulls_first() if nulls_first else ts.desc_nulls_last()
    columns, packed = df.columns, {}
    for i, run in enumerate(_text_runs(df, {*keys, ts_col})):
        # in the place of the run's first column, so that ties are broken in the same order
        df = df.withColumn(run[0], pack(run)).withColumnRenamed(run[0], f"{_PACK}{i}").drop(*run[1:])
        packed[f"{_PACK}{i}"] = run
    kept = keep_first(df, keys, [o], [ts_col], tie_break)
    for name, run in packed.items():
        kept = unpack(kept, name, run)
    return kept.select(*columns)


def priority_rank(c: Column | str, ranking: Sequence[str], default: int = 99) -> Column:
    """Position (1-based) of ``c`` in ``ranking``; anything else -> ``default``."""
    col = F.col(c) if isinstance(c, str) else c
    out = None
    for i, v in enumerate(ranking, start=1):
        out = (F.when(col == F.lit(v), F.lit(i)) if out is None
               else out.when(col == F.lit(v), F.lit(i)))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)
