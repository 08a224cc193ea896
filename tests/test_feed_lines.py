"""Lines that do not parse, quoted and unquoted empty fields, staging state."""

import datetime as dt

import pytest

from martspark import schemas
from martspark.plans import pipeline
from martspark.sources import feeds
from martspark.streaming.ingest import start_feed_ingest
from tests.conftest import rows
from tests.test_sources import HEADER, write

T1 = dt.datetime(2026, 1, 20, 6)
GOOD = "{0},SO{0},Packas,web,A,x,2,100,,M,2025-12-05T10:00:00\n"
PRODUCTS = ("product_number,product_name,classification1,classification2,classification3,"
            "season,discontinued,bestseller_abas,kf,uvp_de,uvp_eu,franchise_price\n")


def landed(root):
    write(f"{root}/a.csv", HEADER + GOOD.format(1) + "2,SO2,short line\n" + GOOD.format(3)
          + GOOD.format(4).strip() + ",one field too many\n" + "lonely\n" + GOOD.format(5))
    write(f"{root}/b.csv", HEADER + GOOD.format(6) + '7,SO7,"Say ""hi"", you",web,A,x,2,100,,M,2025-12-05\n')
    return root


def test_three_bad_lines_do_not_stop_a_load(spark, tmp_dir):
    src, staging = landed(f"{tmp_dir}/in"), f"{tmp_dir}/staging"
    got = pipeline.stage_feeds(spark, staging, T1, sales={"SE": src})
    assert got == {"order_raw": 5, "rejected": 3}
    raw = spark.read.parquet(f"{staging}/order_raw")
    assert rows(raw, "order_id") == [("1",), ("3",), ("5",), ("6",), ("7",)]
    assert rows(raw.where("order_id = '7'"), "overall_status_name", "product_name") == [('Say "hi", you', "x")]
    bad = spark.read.parquet(f"{staging}/rejects_feed")
    assert rows(bad, "feed", "country", "source_file", "line") == sorted(
        ("order_raw", "SE", "a.csv", line) for line in
        ("2,SO2,short line", GOOD.format(4).strip() + ",one field too many", "lonely"))
    assert rows(feeds.line_audit(feeds.read_feed(spark, src, schemas.SALES_FEED))) == [
        ("a.csv", 6, 3, 3), ("b.csv", 2, 2, 0)]
    with pytest.raises(Exception):  # the strict reader still refuses the file
        feeds.stage_sales(spark, src, "SE", T1).collect()


def test_a_projection_does_not_hide_bad_lines(spark, tmp_dir):
    src = landed(f"{tmp_dir}/in")
    assert feeds.good_lines(feeds.read_feed(spark, src, schemas.SALES_FEED)).select("id").count() == 5


def test_stream_keeps_bad_lines_apart(spark, tmp_dir):
    src = landed(f"{tmp_dir}/in")
    start_feed_ingest(spark, "sales", src, f"{tmp_dir}/staging", "SE", f"{tmp_dir}/ck",
                      rejects_dir=f"{tmp_dir}/rejects").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_dir}/staging").count() == 5
    assert rows(spark.read.parquet(f"{tmp_dir}/rejects"), "source_file", "line")[0] == ("a.csv", "2,SO2,short line")
    assert spark.read.parquet(f"{tmp_dir}/rejects").count() == 3


def test_quoted_and_unquoted_empty_fields(spark, tmp_dir):
    p = write(f"{tmp_dir}/in/stock.csv", 'productnumber,stocksellablestock\n'
              'A,\nB,""\nC," "\n,1\n"",2\nD,x\n')
    read = lambda **k: [tuple(r) for r in feeds.read_text_csv(spark, p, schemas.STOCK_FEED, **k).collect()]
    assert read(empty_text=True) == [("A", None), ("B", ""), ("C", " "), (None, "1"), ("", "2"), ("D", "x")]
    assert read() == [("A", None), ("B", None), ("C", " "), (None, "1"), (None, "2"), ("D", "x")]  # D31


def test_empty_texts_reach_the_rules_that_tell_them_apart(spark, tmp_dir):
    from martspark.plans import dims
    from tests.test_facts import load
    write(f"{tmp_dir}/s/x.csv", HEADER + '1,SO1,Packas,web,A,"",2,100,,M,2025-12-05T10:00:00\n'
                                         '2,SO2,Packas,web,A,,2,100,,M,2025-12-05T10:00:00\n')
    write(f"{tmp_dir}/p/x.csv", PRODUCTS + 'A,n,a,b,c,S,@,Ja,nein,"",9,-\nB,n,a,b,c,S,@,Ja,nein,,9,-\n')
    pipeline.stage_feeds(spark, f"{tmp_dir}/staging", T1, sales={"SE": f"{tmp_dir}/s"}, products=[f"{tmp_dir}/p"])
    read = lambda t: spark.read.parquet(f"{tmp_dir}/staging/{t}")
    # P4: '' is a name other than the service line's, NULL is none
    current, rejects = load(spark, read("order_raw").drop("ingest_date"))
    assert rows(current, "order_id", "product_name") == [("1", "")]
    assert rows(rejects, "order_id", "_reject") == [("2", "product_name NULL")]
    # D16: '' is no price text, NULL is no price
    assert rows(dims.product_rejects(read("product_raw")), "product_number") == [("A",)]


def test_staging_report_equals_a_scan_of_staging(spark, tmp_dir):
    staging = f"{tmp_dir}/staging"
    one = ('1,SO1,Packas,web,A,x,2,100,,M,2025-12-05T10:00:00\n'
           '1,SO1,Packas,web,A,x,3,100,,M,2025-12-05T10:00:00\n'
           ' ,SO2,Packas,web,,x,"1,5",abc,,M,N/A\n'
           '3,SO3,Packas,web,C,Delivery Fee,1,1,,M,2025-13-05\n')
    two = '3,SO3,Packas,web,C,x,1,1,,M,2025-12-05\n4,SO4,Packas,web,D,x,1,1,,M,2025-12-05\n'
    for i, text in enumerate((one, two)):
        write(f"{tmp_dir}/in{i}/s.csv", HEADER + text)
        write(f"{tmp_dir}/st{i}/s.csv", "productnumber,stocksellablestock\nA,5\n")
        write(f"{tmp_dir}/p{i}/s.csv", PRODUCTS + "A,n,a,b,c,S,@,Ja,nein,1,9,-\n  ,n,a,b,c,S,@,Ja,nein,1,9,-\n")
        pipeline.stage_feeds(spark, staging, T1 + dt.timedelta(days=i), sales={"SE": f"{tmp_dir}/in{i}"},
                             stock={"SE": f"{tmp_dir}/st{i}"}, products=[f"{tmp_dir}/p{i}"])
    read = lambda t: spark.read.parquet(f"{staging}/{t}")
    from martspark.operators import quality
    from martspark.operators.quality import Check
    from pyspark.sql import functions as F
    q0 = lambda name: Check(f"Q0 {name}", name, F.lit(True), metric="row_count", informational=True)
    full = quality.union_checks(*pipeline._staging_scan(read("order_raw"), read("product_raw"), q0),
                                quality.count_checks(read("stock_raw"), [q0("staging.stock_raw")]))
    got = rows(pipeline.staging_report(spark, staging))
    assert got == rows(full)
    values = {r[0]: r[3] for r in got}
    assert (values["Q1.1"], values["Q1.2"], values["Q1.5"], values["Q2.2"]) == (1, 1, 2, 1)
