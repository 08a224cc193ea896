"""Catalog tables: declared columns, NOT NULL, defaults, partitions, buckets.

For users who keep the warehouse in the session catalog instead of a
``TableStore``.  ``create_tables`` issues the DDL of every staging and warehouse
table.  ``insert`` fills columns the rows lack with their defaults and refuses
NULLs in required columns (Spark's file tables declare NOT NULL but do not check it).

Facts are bucketed on their key.  A join or an aggregate on the key reads
the buckets as they lie, so an upsert shuffles the batch and never the stored
table (``upsert_table``).  It replaces the changed partitions in place: writers
must not run at the same time, and a reader may see some partitions before others; use
``TableStore`` where a version has to appear at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martspark import schemas
from martspark.operators.merge import Changes, upsert_changed
from martspark.session import tidy

# The defaults the source declares (time zone free here, as all audit times are).
DEFAULTS = {
    "order_raw": {"ingested_at": "localtimestamp()"}, "stock_raw": {"ingested_at": "localtimestamp()"},
    "product_raw": {"load_run_ts": "localtimestamp()"}, "dim_product": {"last_updated_at": "localtimestamp()"},
    "fx_rates_monthly": {"source": "'frankfurter/ecb'"},
    "sales_current": {"last_ingested_at": "localtimestamp()"},
    "stock_snapshot": {"ingested_at": "localtimestamp()"},
}
MONTH = T.StructField("created_month", T.DateType())
#: Partition column (of the table or added to it) and bucket key of the facts.
LAYOUT = {"sales_current": (MONTH, ["business_key_hash"]),
          "stock_snapshot": (schemas.STOCK_SNAPSHOT["snapshot_month"], ["country_code", "product_number"])}


def table_schema(table: str) -> T.StructType:
    """Columns as the catalog has them: the partition column last."""
    schema = {**schemas.STAGING, **schemas.WAREHOUSE}[table]
    if table not in LAYOUT:
        return schema
    part = LAYOUT[table][0]
    return T.StructType([f for f in schema.fields if f.name != part.name] + [part])


def required(table: str) -> list[str]:
    if table in schemas.WAREHOUSE:
        return schemas.required(table)
    return [f.name for f in schemas.STAGING[table].fields if not f.nullable]


def ddl(table: str, name: str, buckets: int, location: str | None = None) -> str:
    columns = []
    for f in table_schema(table).fields:
        null = " NOT NULL" if f.name in required(table) else ""
        default = DEFAULTS.get(table, {}).get(f.name)
        columns.append(f"`{f.name}` {f.dataType.simpleString()}{null}" + (f" DEFAULT {default}" if default else ""))
    out = f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet"
    if table in LAYOUT:
        part, keys = LAYOUT[table]
        names = ", ".join(f"`{k}`" for k in keys)
        out += f" PARTITIONED BY (`{part.name}`) CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS"
    return out + (f" LOCATION '{location}'" if location else "")


def create_tables(spark: SparkSession, staging: str = "staging", warehouse: str = "warehouse",
                  buckets: int = 200) -> list[str]:
    """Both databases and their tables; existing ones stay.  ``buckets`` of the facts should
    be a multiple of the shuffle partitions a load uses (about 1 GB per bucket and partition)."""
    names = []
    for database, tables in ((staging, schemas.STAGING), (warehouse, schemas.WAREHOUSE)):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for table in tables:
            spark.sql(ddl(table, f"{database}.{table}", buckets))
            names.append(f"{database}.{table}")
    return names


def checked(df: DataFrame, table: str, name: str | None = None) -> DataFrame:
    """``df`` with NULLs in required columns raising an error that names the column."""
    def value(c: str) -> Column:
        if c not in required(table):
            return F.col(c)
        refused = F.raise_error(F.lit(f"NULL in {name or table}.{c}, which is NOT NULL"))
        return F.when(F.col(c).isNull(), refused.cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)
    return df.select(*[value(c) for c in df.columns])


def insert(spark: SparkSession, table: str, name: str, df: DataFrame) -> None:
    """Append rows; columns that ``df`` lacks take their default (else NULL).

    A NULL in a required column fails the write, which then adds nothing."""
    defaults = DEFAULTS.get(table, {})
    missing = [f for f in table_schema(table).fields if f.name not in df.columns]
    for f in missing:
        df = df.withColumn(f.name, F.expr(defaults.get(f.name, "NULL")).cast(f.dataType))
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in table_schema(table).fields])
    checked(rows, table, name).write.insertInto(name)


def upsert_table(spark: SparkSession, table: str, name: str, batch: DataFrame, guard: str,
                 candidates: Sequence | None = None, **kwargs) -> Changes:
    """Guarded upsert (M3) into a bucketed table; only changed partitions are rewritten.

    The batch is shuffled to the buckets; the table is read in place by the key
    comparison and by the join of its changed partitions."""
    part, keys = LAYOUT[table]
    changes = upsert_changed(spark.table(name), batch, keys, part.name, guard, candidates=candidates,
                             null_safe=False, **kwargs)
    if not changes.values:
        return changes
    columns = [f.name for f in table_schema(table).fields]
    seen = Observation()  # partitions with rows left, found during the write; one aggregate, however many there are
    rows = changes.merged.select(*columns).observe(
        seen, F.collect_set(F.struct(F.col(part.name).alias("v"))).alias("left"))
    # rows are dealt to tasks by bucket, so that a bucket gets one file per partition
    rows = checked(rows, table, name)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        with tidy(spark):
            rows.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    left = {r["v"] for r in seen.get["left"]}
    for v in changes.values:
        if v not in left:  # every row moved away: nothing overwrote the partition
            spec = "NULL" if v is None else f"'{v}'"
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{part.name}` = {spec})")
    return changes
