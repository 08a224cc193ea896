"""End-to-end write-path benchmark on feeds derived from the driver tables.

Run 1 backfills all sales history into an empty store; run 2 is an
incremental load with a one-month lookback.  For each run: seconds, and how
many partitions of ``sales_current`` the publish rewrote versus reused.
Usage: python tools/bench_pipeline.py [sf_dir]   (store in a fresh /tmp folder)
"""

import datetime as dt
import json
import sys
import tempfile
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])
from martspark import get_session  # noqa: E402
from martspark.plans import driver, pipeline  # noqa: E402
from martspark.sources.store import TableStore  # noqa: E402


def leaves(store, table, v):
    return json.loads(store._read_text(store._manifest_path(table, v)))["leaves"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 8)
    root = tempfile.mkdtemp(prefix="martspark-bench-store-")
    store = TableStore(spark, f"file://{root}")
    feeds = dict(order_raw=driver.order_raw(spark, sf), stock_raw=driver.stock_raw(spark, sf),
                 product_raw=driver.product_raw(spark, sf), quotes=driver.quotes_from_orders(spark, sf))
    out = {}
    for name, lookback, run_ts in [("backfill", None, dt.datetime(2026, 1, 20, 6)),
                                   ("incremental", 1, dt.datetime(2026, 1, 21, 6))]:
        t0 = time.perf_counter()
        rep = pipeline.run(spark, store, feeds["order_raw"], feeds["stock_raw"], feeds["product_raw"],
                           driver.AS_OF, run_ts, quotes=feeds["quotes"], lookback_months=lookback,
                           calendar=(dt.date(1995, 1, 1), dt.date(2001, 12, 31)))
        checks = rep.count()
        v = store.version("sales_current")
        cur = leaves(store, "sales_current", v)
        rewritten = sum(1 for p in cur.values() if f"store_version={v}-" in p)
        out[name] = {"seconds": round(time.perf_counter() - t0, 2), "checks": checks,
                     "sales_partitions": len(cur), "sales_partitions_rewritten": rewritten,
                     "sales_rows": store.read("sales_current").count()}
    print(json.dumps({"sf": sf, "runs": out}))


if __name__ == "__main__":
    main()
