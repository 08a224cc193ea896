"""Exact decimal products against Python's Decimal."""

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from martspark.functions import exact_product


def want(*factors):
    if any(f is None for f in factors):
        return None
    with localcontext() as ctx:
        ctx.prec = 120
        v = Decimal(1)
        for f in factors:
            v *= f
        v = v.quantize(Decimal("0.0001"), ROUND_HALF_UP)
    return v if abs(v) < 10 ** 14 else None


def amount(rng, digits=18):
    n = rng.randrange(1, digits + 1)
    return Decimal(rng.choice([-1, 1]) * rng.randrange(10 ** n)).scaleb(-rng.randrange(max(0, n - 12), 9))


EDGES = [(Decimal(0), Decimal(10) ** 13, Decimal(1)), (Decimal(10) ** 13, Decimal(10) ** 13, Decimal(0)),
         (None, Decimal(1), Decimal(0)), (Decimal("0.00005"), Decimal(1), Decimal(1)),
         (Decimal("-0.00005"), Decimal(1), Decimal(1)), (Decimal("0.00004999"), Decimal("1.00000001"), Decimal(1)),
         (Decimal("99999999999999.99994999"), Decimal(1), Decimal(1)),
         (Decimal("99999999999999.99995"), Decimal(1), Decimal(1)),
         (Decimal("99999999999999.99999999"), Decimal("99999999999999.99999999"), Decimal("0.00000001")),
         # rounded to twelve decimals first, these would go up
         (Decimal("0.00004999"), Decimal("1.00019999"), Decimal("1.00000003"))]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_python_decimals(spark, seed):
    rng = random.Random(seed)
    data = [(amount(rng), amount(rng), abs(amount(rng, 12))) for _ in range(2000)] + EDGES
    df = spark.createDataFrame(data, "a decimal(22,8), b decimal(22,8), c decimal(20,8)")
    got = df.select("*", exact_product(F.col("a"), F.col("b"), F.col("c")).alias("three"),
                    exact_product(F.col("b"), F.col("c")).alias("two")).collect()
    fits = 0
    for r in got:
        assert (r.three, r.two) == (want(r.a, r.b, r.c), want(r.b, r.c)), r
        fits += r.three is not None
    assert 500 < fits < len(got)


def test_rounding_to_39_digits_is_null(spark):
    d = Decimal
    data = [(d("99999999999999.99995"), None), (d("99999999999999.99994999"), d("99999999999999.9999")),
            (d("-99999999999999.99995"), None)]
    df = spark.createDataFrame(data, "a decimal(22,8), want decimal(18,4)")
    one = F.lit(1).cast("decimal(20,8)")
    for r in df.select("want", exact_product(F.col("a"), one, one).alias("three")).collect():
        assert r.three == r.want


def test_product_is_computed_once(spark):
    df = spark.createDataFrame([(Decimal(1), Decimal(2))], "a decimal(22,8), b decimal(20,8)")
    plan = df.select(exact_product(F.col("a"), F.col("b")).alias("p"))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("as decimal(38,0)") <= 2  # one per factor


def test_too_many_factors():
    with pytest.raises(ValueError):
        exact_product(*[F.lit(Decimal(1))] * 4)
