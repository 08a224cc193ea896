"""Data-quality checks (Q0-Q8).

Every check yields one row ``(check_id, check_name, metric, value, passed)``.
Row-predicate checks on the same table are fused into a single aggregate
(one scan, one ``count_if`` per check) and unpivoted with ``inline``.
Duplicate and coverage checks pre-aggregate per key (map-side partial
aggregation) before any shuffle or join, so a key that holds a third of all
rows costs one row per map task, not a third of the table in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHECK_COLUMNS = ["check_id", "check_name", "metric", "value", "passed"]


@dataclass(frozen=True)
class Check:
    check_id: str
    check_name: str
    predicate: Column
    metric: str = "bad_rows"
    informational: bool = False


def _passed(value: Column, informational: bool) -> Column:
    return F.lit(None).cast("boolean") if informational else (value == 0)


def check_row(check_id, check_name, metric, value: Column, informational) -> Column:
    v = F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))
    return F.struct(F.lit(check_id).alias("check_id"), F.lit(check_name).alias("check_name"),
                    F.lit(metric).alias("metric"), v.alias("value"),
                    _passed(v, informational).alias("passed"))


def count_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Fused row-predicate checks: one pass over ``df``."""
    aggs = [F.count_if(c.predicate).alias(f"_c{i}") for i, c in enumerate(checks)]
    one = df.agg(*aggs)
    rows = F.array(*[check_row(c.check_id, c.check_name, c.metric, F.col(f"_c{i}"), c.informational)
                     for i, c in enumerate(checks)])
    return one.select(F.inline(rows))


def duplicate_groups(df: DataFrame, keys: Sequence[str], check_id: str, check_name: str,
                     where: Column | None = None, informational: bool = False) -> DataFrame:
    """Number of key groups with more than one row (A4)."""
    src = df if where is None else df.where(where)
    groups = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    n = groups.agg(F.count_if(F.col("_n") > 1).alias("_v"))
    return n.select(F.inline(F.array(check_row(check_id, check_name, "duplicate_groups",
                                          F.col("_v"), informational))))


def checks_with_duplicates(df: DataFrame, checks: Sequence[Check], keys: Sequence[str], check_id: str,
                           check_name: str, where: Column | None = None,
                           informational: bool = False) -> DataFrame:
    """``count_checks`` and ``duplicate_groups`` of a table in one pass over it.

    The predicates' counts ride on the per-key pre-aggregate that the
    duplicate check needs anyway; ``where`` may use key columns only.
    """
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[
        F.count_if(c.predicate).alias(f"_c{i}") for i, c in enumerate(checks)])
    twice = F.col("_n") > 1
    one = groups.agg(F.count_if(twice if where is None else twice & where).alias("_v"),
                     *[F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(checks))])
    rows = [check_row(check_id, check_name, "duplicate_groups", F.col("_v"), informational)]
    rows += [check_row(c.check_id, c.check_name, c.metric, F.col(f"_c{i}"), c.informational)
             for i, c in enumerate(checks)]
    return one.select(F.inline(F.array(*rows)))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key value; the partial aggregate runs before the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))


def missing_keys(df: DataFrame, key: str, ref: DataFrame, ref_key: str | None = None) -> DataFrame:
    """Per missing key value: how many rows of ``df`` reference it.

    NULL keys count as missing, as in ``LEFT JOIN ... WHERE right IS NULL``.
    The left side is reduced to one row per key before the anti-join.
    """
    ref_key = ref_key or key
    refs = ref.select(F.col(ref_key).alias(key)).where(F.col(key).isNotNull()).distinct()
    return key_counts(df, key).join(refs, key, "left_anti")


def missing_key_check(df: DataFrame, key: str, ref: DataFrame, check_id: str, check_name: str,
                      ref_key: str | None = None) -> DataFrame:
    m = missing_keys(df, key, ref, ref_key).agg(F.sum("cnt").alias("_v"))
    return m.select(F.inline(F.array(check_row(check_id, check_name, "bad_rows", F.col("_v"), False))))


def top_counts(counts: DataFrame, key: str, n: int = 20, section: str | None = None) -> DataFrame:
    """Top-``n`` keys by count; ties broken by key so the cut is stable (O1)."""
    out = counts.orderBy(F.col("cnt").desc(), F.col(key).asc_nulls_first()).limit(n)
    return out.select(F.lit(section).alias("section"), key, "cnt") if section else out


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, stacked."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def assert_unique(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Declarative uniqueness constraint (Q8) as a check row."""
    return duplicate_groups(df, keys, f"{table}.unique({','.join(keys)})",
                            f"{table}: duplicate ({', '.join(keys)})")


def assert_not_null(df: DataFrame, cols: Sequence[str], table: str) -> DataFrame:
    """Declarative not-null constraints (Q8), fused into one pass."""
    return count_checks(df, [Check(f"{table}.not_null({c})", f"{table}: {c} is NULL",
                                   F.col(c).isNull()) for c in cols])


def union_checks(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [r.select(*CHECK_COLUMNS) for r in reports])


def failed(report: DataFrame) -> DataFrame:
    """Checks that need review (Q7): a non-informational non-zero value."""
    return report.where(F.col("passed") == F.lit(False))


def raise_on_failure(report: DataFrame) -> None:
    """Gate a publish on the report; collects only the failing check rows."""
    bad = failed(report).collect()
    if bad:
        raise AssertionError("quality checks failed: " +
                             ", ".join(f"{r.check_id}={r.value}" for r in bad))
