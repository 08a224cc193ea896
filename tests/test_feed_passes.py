"""The feed is written without a shuffle and parsed once for its good lines."""

import datetime as dt
import re

from pyspark.sql import functions as F

from martspark import schemas
from martspark.functions.clean import blank_to_null, parse_timestamp
from martspark.plans import driver, pipeline, stored
from martspark.plans.checks import order_raw_checks
from martspark.sources import feeds
from tests.conftest import rows
from tests.test_method_size import SMALL
from tests.test_sources import HEADER, write

T1 = dt.datetime(2026, 1, 20, 6)
LINE = "{0},SO{0},Packas,web,A,x,2,100,,M,2025-12-05T10:00:00\n"


def test_every_feed_file_has_one_header(spark):
    path = stored.write_feed(spark, SMALL)
    files = [f[0] for f in feeds.list_files(spark, path)]
    assert not any(re.search(r"/file=\d+/", f) for f in files)  # lines stay in the task that made them
    header = ",".join(schemas.SALES_FEED.fieldNames())
    texts = [open(f.removeprefix("file:"), encoding="utf-8").read().splitlines() for f in files]
    assert texts and all(not t or (t[0] == header and header not in t[1:]) for t in texts)
    want = rows(driver.order_raw(spark, SMALL).select(stored.feed_line()))
    assert sorted((line,) for t in texts for line in t[1:]) == want


def test_good_lines_are_parsed_once(spark, tmp_dir, monkeypatch):
    write(f"{tmp_dir}/in/a.csv", HEADER + LINE.format(1) * 2 + LINE.format(2) + "short\n")
    schema, staged = feeds.FEEDS["order_raw"]
    calls = []
    monkeypatch.setitem(feeds.FEEDS, "order_raw", (schema, lambda *a: calls.append(a) or staged(*a)))
    got = pipeline.stage_feeds(spark, f"{tmp_dir}/st", T1, sales={"SE": f"{tmp_dir}/in"})
    assert got == {"order_raw": 3, "rejected": 1} and len(calls) == 1
    assert rows(spark.read.parquet(f"{tmp_dir}/st/keys_order_raw"), "order_id", "cnt") == [("1", 2), ("2", 1)]


def test_keys_of_a_load_leave_out_other_loads_of_the_day(spark, tmp_dir):
    write(f"{tmp_dir}/a/a.csv", HEADER + LINE.format(1) + LINE.format(2))
    write(f"{tmp_dir}/b/b.csv", HEADER + LINE.format(1) + LINE.format(3))
    write(f"{tmp_dir}/c/c.csv", HEADER + "short\n")  # no line to stage
    for country, name in (("SE", "a"), ("SE", "b"), ("PL", "b"), ("DE", "c")):
        pipeline.stage_feeds(spark, f"{tmp_dir}/st", T1, sales={country: f"{tmp_dir}/{name}"})
    assert rows(spark.read.parquet(f"{tmp_dir}/st/keys_order_raw"), "country", "order_id", "cnt") == [
        ("PL", "1", 1), ("PL", "3", 1), ("SE", "1", 1), ("SE", "1", 1), ("SE", "2", 1), ("SE", "3", 1)]
    report = {r["check_id"]: r["value"] for r in pipeline.staging_report(spark, f"{tmp_dir}/st").collect()}
    assert report["Q1.5"] == 1 and report["Q0 staging.order_raw"] == 6


def test_texts_without_the_t_of_the_pattern_are_not_parsed(spark):
    texts = ["2025-12-05T10:00:00", " 2025-12-05t10:00:00 ", "2025-12-05 10:00:00", "2025-12-05", "N/A", "T", "", "  ",
             None, "2025-13-05T10:00:00", "2025-1-5T1:0:0", "0000-01-01T00:00:00", "12025-12-05T10:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "created_at string")
    check = next(c for c in order_raw_checks() if c.check_id == "Q1.3")
    plain = blank_to_null("created_at").isNotNull() & parse_timestamp(
        "created_at", ("yyyy-MM-dd'T'HH:mm:ss",), ("",)).isNull()
    assert df.where(~check.predicate.eqNullSafe(plain)).count() == 0
    plan = df.select(check.predicate)._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and "[Tt]" in plan
