"""Declared schemas of every entity (S2, S3).  No inference anywhere."""

from pyspark.sql import types as T

S, TS, NTZ, D = T.StringType(), T.TimestampType(), T.TimestampNTZType(), T.DateType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


def _text(*names):
    return [_f(n, S) for n in names]


# --- feed files (all text, fixed column order) ---------------------------
SALES_FEED = T.StructType(_text(
    "id", "ordernumber", "overallstatusname", "channelname", "productnumber", "productname",
    "quantity", "unitprice", "promiseddeliveryat", "manufacturer", "createdat"))
STOCK_FEED = T.StructType(_text("productnumber", "stocksellablestock"))
PRODUCT_FEED = T.StructType(_text(
    "product_number", "product_name", "classification1", "classification2", "classification3",
    "season", "discontinued", "bestseller_abas", "kf", "uvp_de", "uvp_eu", "franchise_price"))

# feed column -> staging column
SALES_RENAMES = {"id": "order_id", "ordernumber": "order_number",
                 "overallstatusname": "overall_status_name", "channelname": "channel_name",
                 "productnumber": "product_number", "productname": "product_name",
                 "quantity": "quantity", "unitprice": "unit_price",
                 "promiseddeliveryat": "promised_delivery_at", "manufacturer": "manufacturer",
                 "createdat": "created_at"}
STOCK_RENAMES = {"productnumber": "product_number", "stocksellablestock": "sellable_stock"}

# --- staging (append-only, text payload + audit) ---------------------------
ORDER_RAW = T.StructType(_text(
    "country", "order_id", "order_number", "overall_status_name", "channel_name",
    "product_number", "product_name", "quantity", "unit_price", "promised_delivery_at",
    "manufacturer", "created_at", "source_file") + [_f("ingested_at", NTZ, False)])
# Staging as written by the feed loader: plus the parsed creation time, a
# typed sidecar used for pushdown and row-group skipping.
ORDER_RAW_TYPED = T.StructType(ORDER_RAW.fields + [_f("created_ts", NTZ, True)])
STOCK_RAW = T.StructType(_text("country", "product_number", "sellable_stock", "source_file")
                         + [_f("ingested_at", NTZ, False)])
PRODUCT_RAW = T.StructType(_text(
    "product_number", "product_name", "classification1", "classification2", "classification3",
    "season", "discontinued", "bestseller_abas", "kf", "uvp_de", "uvp_eu", "franchise_price",
    "source_file") + [_f("load_run_ts", NTZ, True)])

# --- warehouse --------------------------------------------------------------
DEC2, DEC4, DEC8 = T.DecimalType(18, 2), T.DecimalType(18, 4), T.DecimalType(18, 8)

DIM_PRODUCT = T.StructType([
    _f("product_sk", T.LongType(), False), _f("product_number", S, False),
    *_text("product_name", "category1", "category2", "category3", "season"),
    _f("discontinued", T.BooleanType()), _f("bestseller_abas", T.BooleanType()),
    _f("kf", T.BooleanType()), _f("uvp_de", DEC2), _f("uvp_eu", DEC2),
    _f("franchise_price", DEC2), _f("last_updated_at", NTZ, False)])
DIM_COUNTRY = T.StructType([
    _f("country_sk", T.LongType(), False), _f("country_name", S, False),
    _f("country_code", S, False), _f("currency_code", S, False)])
DIM_DATE = T.StructType([
    _f("date_sk", D, False), _f("year", T.IntegerType(), False),
    _f("quarter", T.IntegerType(), False), _f("month_number", T.IntegerType(), False),
    _f("year_month", S, False)])
FX_RATES_MONTHLY = T.StructType([
    _f("month_sk", D, False), _f("currency_code", S, False),
    _f("avg_rate_to_eur", DEC8, False), _f("obs_count", T.IntegerType(), False),
    _f("source", S, False)])
MAP_ORDER_STATUS = T.StructType([_f("raw_status", S, False), _f("status_std", S, False)])
SALES_CURRENT = T.StructType([
    _f("business_key_hash", S, False), _f("change_hash", S, False),
    _f("country_code", S, False), _f("order_id", S, False), _f("product_number", S, False),
    *_text("order_number", "raw_status", "status_std", "channel_name", "product_name",
           "manufacturer"),
    _f("created_at", NTZ), _f("promised_delivery_at", D),
    _f("quantity", DEC4), _f("unit_price", DEC4), _f("order_value", DEC4),
    _f("fx_missing", T.BooleanType()), _f("source_file", S),
    _f("last_ingested_at", NTZ, False)])
STOCK_SNAPSHOT = T.StructType([
    _f("snapshot_month", D, False), _f("country_code", S), _f("product_number", S, False),
    _f("sellable_stock", DEC4), _f("source_file", S), _f("ingested_at", NTZ, False)])
CHECK_RESULT = T.StructType([
    _f("check_id", S, False), _f("check_name", S, False), _f("metric", S, False),
    _f("value", T.LongType(), False), _f("passed", T.BooleanType())])
RATE_PAYLOAD = T.StructType([_f("base", S), _f("rates", T.MapType(S, T.MapType(S, T.DoubleType())))])

WAREHOUSE = {
    "dim_product": DIM_PRODUCT, "dim_country": DIM_COUNTRY, "dim_date": DIM_DATE,
    "fx_rates_monthly": FX_RATES_MONTHLY, "map_order_status": MAP_ORDER_STATUS,
    "sales_current": SALES_CURRENT, "stock_snapshot": STOCK_SNAPSHOT,
}
#: Primary and unique keys; NOT NULL columns are the non-nullable fields above.
UNIQUE = {
    "dim_product": ["product_number"], "dim_country": ["country_name"], "dim_date": ["date_sk"],
    "fx_rates_monthly": ["month_sk", "currency_code"], "map_order_status": ["raw_status"],
    "sales_current": ["business_key_hash"],
    "stock_snapshot": ["snapshot_month", "country_code", "product_number"],
}
STAGING = {"order_raw": ORDER_RAW, "stock_raw": STOCK_RAW, "product_raw": PRODUCT_RAW}


def required(table: str) -> list[str]:
    """NOT NULL columns: the declared ones and, as in the source, those of the primary key."""
    return list(dict.fromkeys([f.name for f in WAREHOUSE[table].fields if not f.nullable] + UNIQUE[table]))


def empty_frame(spark, schema: T.StructType):
    """An empty table state the optimizer can see is empty.

    A filtered-out one-row relation folds to an empty ``LocalRelation``, so
    a first load's upsert join against it is removed at planning time.
    """
    from pyspark.sql import functions as F
    return (spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
            .where(F.lit(False)))
