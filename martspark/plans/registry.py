"""Registry of the driver queries: name -> ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martspark.plans import catalog, checks, oracle, oracle_stored, stored

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "stage_orders": catalog.stage_orders,
    "stage_feed_text": catalog.stage_feed_text,
    "fx_payload_coverage": catalog.fx_payload_coverage,
    "conformed_statuses": catalog.conformed_statuses,
    "code_hygiene": catalog.code_hygiene,
    "load_audit_by_source": catalog.load_audit_by_source,
    "clean_text_nulls": catalog.clean_text_nulls,
    "parse_flags": catalog.parse_flags,
    "parse_money": catalog.parse_money_q,
    "calendar": catalog.calendar_q,
    "month_series_rates": catalog.month_series_rates,
    "latest_product": catalog.latest_product,
    "status_map_priority": catalog.status_map_priority,
    "hash_keys": catalog.hash_keys,
    "dim_product_scd1": catalog.dim_product_scd1,
    "upsert_insert_only": catalog.upsert_insert_only,
    "upsert_guarded": catalog.upsert_guarded,
    "sales_lookback": catalog.sales_lookback,
    "sales_current_eur": catalog.sales_current_eur,
    "sales_rejects": catalog.sales_rejects,
    "exact_amounts": catalog.exact_amounts,
    "stock_snapshot": catalog.stock_snapshot,
    "fx_monthly_avg": catalog.fx_monthly_avg,
    "fx_source_fallback": catalog.fx_source_fallback,
    "fx_missing_months": catalog.fx_missing_months,
    "surrogate_keys": catalog.surrogate_keys,
    "dim_country_scd1": catalog.dim_country_scd1,
    "dim_date_insert_only": catalog.dim_date_insert_only,
    "fx_rates_table": catalog.fx_rates_table,
    "fx_currency_listing": catalog.fx_currency_listing,
    "dq_row_counts": checks.dq_row_counts,
    "dq_missing_keys": checks.dq_missing_keys,
    "dq_service_rows": checks.dq_service_rows,
    "dq_not_castable": checks.dq_not_castable,
    "dq_duplicates": checks.dq_duplicates,
    "dq_value_ranges": checks.dq_value_ranges,
    "dq_unmapped_top": checks.dq_unmapped_top,
    "dq_coverage": checks.dq_coverage,
    "dq_coverage_top": checks.dq_coverage_top,
    "dq_fx_coverage": checks.dq_fx_coverage,
    "dq_constraints": checks.dq_constraints,
    "dq_report": checks.dq_report,
    **stored.QUERIES,
}

ORACLE_SQL: dict[str, str] = {**oracle.ORACLE_SQL, **oracle_stored.ORACLE_SQL}
