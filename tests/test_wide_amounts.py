"""``exact_amounts`` on keys of a lineitem table several hundred times sf0.1."""

from decimal import Decimal

from martspark.plans import catalog


def want(*integers):
    """The product of integer numbers of 1e-8, rounded half up to four decimals (all are positive)."""
    n = 1
    for i in integers:
        n *= i
    drop = 10 ** (8 * len(integers) - 4)
    n = (n + drop // 2) // drop
    return Decimal(n).scaleb(-4) if n < 10 ** 18 else None


def test_exact_amounts_of_large_keys(spark, tmp_path):
    keys = [(54_000_000, 7, 0, 0), (54_000_000, 7, 3, 1), (54_000_000, 7, 7_200_000, 360_000),
            (54_000_000, 1, 7_200_000, 360_000), (9_999_999, 7, 1, 12), (12, 7, 5, 999), (10 ** 15, 2, 4, 4),
            (10 ** 15, 7, 0, 0)]
    spark.createDataFrame(keys, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint"
                          ).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = catalog.exact_amounts(spark, str(tmp_path)).collect()
    assert len(got) == len(keys)
    fits = 0
    for r in got:
        q = (r.l_orderkey * 1000000007 + r.l_linenumber) * (1000000 if r.l_linenumber == 7 else 1)
        p, rate = r.l_partkey * 1000003 + 7, r.l_suppkey * 100003 + 1
        assert (r.unit_price, r.order_value) == (want(p, rate), want(q, p, rate)), r
        fits += r.order_value is not None
    assert 0 < fits < len(got)
