"""Exact products of decimal amounts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

FACTOR_SCALE = 8


def exact_product(*factors: Column, precision: int = 18, scale: int = 4) -> Column:
    """Product of decimals as ``decimal(precision, scale)``, rounded once, half away from
    zero; NULL if it does not fit or a factor is NULL.

    Spark cuts the digits of a decimal product to 38 and so rounds before the final
    rounding.  Here every factor (at most ``FACTOR_SCALE`` decimals) is taken as an
    integer number of its last decimals.  The integers' product is exact, and
    38 digits hold it whenever the result fits: with k factors it is the result times
    10**(8k), for three factors and ``decimal(18, 4)`` below 10**38.  As no
    integer factor but zero is below one, no partial product exceeds it.
    """
    if precision - scale + FACTOR_SCALE * len(factors) > 38:
        raise ValueError(f"{len(factors)} factors do not leave room for decimal({precision},{scale})")
    n, zero, known, negative = None, F.lit(False), F.lit(True), F.lit(False)
    for f in factors:
        negative = negative != (f < 0)
        i = (f * F.lit(Decimal(10 ** FACTOR_SCALE))).cast("decimal(38,0)")
        n = i if n is None else F.try_multiply(n, i).cast("decimal(38,0)")
        zero, known = zero | (f == 0), known & f.isNotNull()
    drop = FACTOR_SCALE * len(factors) - scale  # decimals beyond the result's
    # No condition on ``n``, which Spark would then compute once per use; rounded at the result's
    # last decimal, half away from zero, it has at most ``precision`` digits before the zeros.
    n = n.try_cast(f"decimal({precision + drop},0)")
    if precision + drop == 38:  # what would round to 39 digits is NULL
        half = F.when(negative, F.lit(Decimal(-5 * 10 ** (drop - 1)))).otherwise(F.lit(Decimal(5 * 10 ** (drop - 1))))
        n = (F.try_add(n, half) - half).cast("decimal(38,0)")
    n = F.round(n, -drop)
    exact = (n * F.lit(Decimal(1).scaleb(-FACTOR_SCALE * len(factors)))).try_cast(f"decimal({precision},{scale})")
    # a partial product may be too large where a later factor is zero
    return F.coalesce(exact, F.when(known & zero, F.lit(0).cast(f"decimal({precision},{scale})")))
