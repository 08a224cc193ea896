"""Generated methods stay below the 8,000 bytes of bytecode above which the JVM only interprets them."""

import contextlib
import io
import re

import pytest

from martspark.plans import driver
from martspark.plans.catalog import sales_current

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_sales_load_is_compiled(spark, broadcast):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": broadcast}
    old = {k: spark.conf.get(k) for k in conf}
    text = io.StringIO()
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        driver._PLANS.clear()
        with contextlib.redirect_stdout(text):
            sales_current(spark, SMALL).explain("codegen")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        driver._PLANS.clear()
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000


def test_feed_texts_are_built_once(spark):
    """No filter holds a copy of the expressions that build a line's texts."""
    plan = sales_current(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("l_quantity" in f or "p_retailprice" in f or "_rule" in f for f in filters)
