"""Feed readers and staging writers.

CSV feeds are read with a declared all-text schema (no inference), header
skipped by position (header names are not checked, as with the source's
bulk copy), UTF-8, and ``FAILFAST`` by default: a short or malformed row
fails the load instead of being padded with NULLs.  ``read_feed`` keeps such a
line apart instead (``_bad_line``), so that one line does not stop a
load and none is lost: ``good_lines`` are staged, ``bad_lines`` go to a reject table.

An empty unquoted field is NULL.  A quoted ``""`` is NULL too by default (D31); with
``empty_text=True`` it is the empty text, as the source's bulk copy reads it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martspark import schemas
from martspark.session import tidy
from martspark.functions.clean import parse_timestamp
from martspark.functions.dates import ntz_lit


BAD_LINE = "_bad_line"
# What an empty unquoted field is read as, if it is to differ from a quoted one:
# a text that no feed holds, which the reader turns into NULL.
NO_VALUE = "\u0001<no value>\u0001"


def read_text_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
                  mode: str = "FAILFAST", multiline: bool = False, empty_text: bool = False) -> DataFrame:
    """Read a feed as text columns in file order.

    ``multiline=True`` is needed only for feeds with line breaks inside
    quoted values; such files are then read whole by one task each.
    """
    return csv_options(spark.read, schema, mode, empty_text).option("multiLine", multiline).csv(path)


def csv_options(reader, schema: T.StructType, mode: str = "FAILFAST", empty_text: bool = False):
    """The feed format, for batch and streaming readers alike."""
    out = (reader.schema(schema)
           .option("header", True).option("encoding", "UTF-8").option("mode", mode)
           .option("quote", '"').option("escape", '"').option("enforceSchema", True))
    return out.option("nullValue", NO_VALUE).option("emptyValue", "") if empty_text else out


def feed_options(reader, schema: T.StructType, empty_text: bool = True):
    """``csv_options`` with a column for lines that do not parse."""
    full = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    return (csv_options(reader, full, "PERMISSIVE", empty_text)
            .option("columnNameOfCorruptRecord", BAD_LINE)
            # else a projection would parse, and so check, only its own columns
            .option("columnPruning", False))


def read_feed(spark: SparkSession, path: str | list[str], schema: T.StructType, multiline: bool = False,
              empty_text: bool = True) -> DataFrame:
    """A feed with ``_bad_line``: the text of a line with too few or too many
    fields, NULL for every other line; and ``_file``, the file's name."""
    return feed_columns(feed_options(spark.read, schema, empty_text).option("multiLine", multiline).csv(path))


def feed_columns(feed: DataFrame) -> DataFrame:
    """The columns of ``read_feed``, for batch and streaming reads alike.

    Spark refuses queries that need the column of bad lines alone, so it is
    tied to a feed column (of which it takes no character)."""
    first = F.substring(F.coalesce(F.col(feed.columns[0]), F.lit("")), 1, 0)
    return feed.withColumn(BAD_LINE, F.concat(F.col(BAD_LINE), first)).select(
        "*", F.col("_metadata.file_name").alias("_file"))


def good_lines(feed: DataFrame) -> DataFrame:
    return feed.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def bad_lines(feed: DataFrame, name: str, country: str | None, ingested_at: dt.datetime | Column) -> DataFrame:
    """Reject rows (feed, country, source_file, line, ingested_at)."""
    ts = ingested_at if isinstance(ingested_at, Column) else ntz_lit(ingested_at)
    return feed.where(F.col(BAD_LINE).isNotNull()).select(
        F.lit(name).alias("feed"), F.lit(country).cast("string").alias("country"),
        F.col("_file").alias("source_file"), F.col(BAD_LINE).alias("line"),
        ts.cast("timestamp_ntz").alias("ingested_at"))


def line_audit(feed: DataFrame) -> DataFrame:
    """Lines per file: read, staged and rejected."""
    bad = F.count(BAD_LINE)
    return feed.groupBy(F.col("_file").alias("source_file")).agg(
        F.count(F.lit(1)).alias("lines"), (F.count(F.lit(1)) - bad).alias("staged"), bad.alias("rejected"))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Feed names -> staging names, in the mapping's order."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def with_load_context(df: DataFrame, ingested_at: dt.datetime | Column,
                      country: str | None = None, source_file: str | Column | None = None,
                      ts_col: str = "ingested_at") -> DataFrame:
    """Stamp load context (S5): constant country, source file, ingest time.

    ``source_file`` defaults to the name of the file each row came from.
    """
    out = df
    if country is not None:
        out = out.withColumn("country", F.lit(country))
    if source_file is None:
        src = F.col("_metadata.file_name")
    elif isinstance(source_file, str):
        src = F.lit(source_file)
    else:
        src = source_file
    out = out.withColumn("source_file", src)
    ts = ingested_at if isinstance(ingested_at, Column) else ntz_lit(ingested_at)
    return out.withColumn(ts_col, ts.cast("timestamp_ntz"))


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def staged_sales(feed: DataFrame, country: str | None, ingested_at) -> DataFrame:
    """Parsed sales lines (with ``_file``) -> ``order_raw`` rows."""
    df = rename_columns(feed, {**schemas.SALES_RENAMES, "_file": "_file"})
    df = with_load_context(df, ingested_at, country=country, source_file=F.col("_file")).drop("_file")
    df = df.withColumn("created_ts", parse_timestamp("created_at"))
    return _conform(df, schemas.ORDER_RAW_TYPED)


def staged_stock(feed: DataFrame, country: str | None, ingested_at) -> DataFrame:
    df = rename_columns(feed, {**schemas.STOCK_RENAMES, "_file": "_file"})
    df = with_load_context(df, ingested_at, country=country, source_file=F.col("_file")).drop("_file")
    return _conform(df, schemas.STOCK_RAW)


def staged_products(feed: DataFrame, country: str | None, load_run_ts) -> DataFrame:
    df = with_load_context(feed, load_run_ts, source_file=F.col("_file"), ts_col="load_run_ts").drop("_file")
    return _conform(df, schemas.PRODUCT_RAW)


#: Staging table -> feed schema and the staging of its parsed lines.
FEEDS = {"order_raw": (schemas.SALES_FEED, staged_sales), "stock_raw": (schemas.STOCK_FEED, staged_stock),
         "product_raw": (schemas.PRODUCT_FEED, staged_products)}


def _strict_feed(spark: SparkSession, path, schema: T.StructType, mode: str) -> DataFrame:
    return read_text_csv(spark, path, schema, mode).select("*", F.col("_metadata.file_name").alias("_file"))


def stage_sales(spark: SparkSession, path, country: str, ingested_at, mode="FAILFAST") -> DataFrame:
    """Sales CSV -> ``order_raw`` rows."""
    return staged_sales(_strict_feed(spark, path, schemas.SALES_FEED, mode), country, ingested_at)


def stage_stock(spark: SparkSession, path, country: str, ingested_at, mode="FAILFAST") -> DataFrame:
    return staged_stock(_strict_feed(spark, path, schemas.STOCK_FEED, mode), country, ingested_at)


def stage_products(spark: SparkSession, path, load_run_ts, mode="FAILFAST") -> DataFrame:
    return staged_products(_strict_feed(spark, path, schemas.PRODUCT_FEED, mode), None, load_run_ts)


LEDGER = "feed string, country string, path string, bytes bigint, modified bigint"


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time) of the data files under a path or glob."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for top in fs.globStatus(p) or []:
        found = fs.listFiles(top.getPath(), True)
        while found.hasNext():
            st = found.next()
            if not st.getPath().getName().startswith(("_", ".")):
                out.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return sorted(out)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def new_files(spark: SparkSession, ledger: str, feed: str, country: str | None, path: str
              ) -> list[tuple[str, int, int]]:
    """The files of a load that the ledger does not hold.

    A file is known by feed, country, full path, size and modification time,
    so equal names in two countries' folders are two files and a file that
    was replaced is new.  Neither the feed nor staging is read for this; the
    result is bounded by the files listed.
    """
    files = list_files(spark, path)
    if not files or not path_exists(spark, ledger):
        return files
    listed = spark.createDataFrame([(feed, country, *f) for f in files], LEDGER)
    seen = (spark.read.schema(LEDGER).parquet(ledger)
            .where((F.col("feed") == feed) & F.col("country").eqNullSafe(F.lit(country))))
    keys = ["path", "bytes", "modified"]
    return sorted(tuple(r) for r in listed.select(*keys).join(
        seen.select(*keys), keys, "left_anti").collect())


def record_files(spark: SparkSession, ledger: str, feed: str, country: str | None,
                 files: list[tuple[str, int, int]]) -> None:
    """Enter loaded files.  Done after the staging write: a load that fails in
    between is staged again, and latest-per-key absorbs its repeated rows."""
    rows = spark.createDataFrame([(feed, country, *f) for f in files], LEDGER)
    rows.coalesce(1).write.mode("append").parquet(ledger)


def append_staging(df: DataFrame, path: str, partition_by: list[str] | None = None,
                   sort_by: list[str] | None = None) -> None:
    """Append-only staging write (S6): never rewrites existing rows.

    ``sort_by`` (e.g. ``["created_ts"]``) sorts rows within each write task,
    so parquet row groups carry narrow min/max ranges and a pushed range
    filter (the lookback window) skips most of them; it adds no shuffle.
    """
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    w = df.write.mode("append").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with tidy(df.sparkSession):
        w.save(path)


def load_audit(df: DataFrame) -> DataFrame:
    """Rows per source file in a load (S11); the total is their sum."""
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count"))


def read_rate_payloads(spark: SparkSession, path) -> DataFrame:
    """Landed rate payloads ``{"rates": {date: {currency: quote}}}``."""
    return spark.read.schema(schemas.RATE_PAYLOAD).option("mode", "FAILFAST").json(path)
