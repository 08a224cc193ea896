"""Keyed upsert without MERGE (M1-M5).

``upsert(target, source, keys, ...)`` returns the new state of ``target``:

* ``on_match="update"`` (M1): matched rows take ``update_cols`` from source.
* ``on_match="keep"`` (M2): insert-only; matched rows stay as they are (an
  anti-join on the keys and an append).
* ``guard=col`` (M3): a matched row is updated only when ``col`` differs
  (NULL-safe), so unchanged rows keep their audit stamps.
* ``stamps={col: value}`` (M5): set on inserted and updated rows only.

Plan: one ``full_outer`` join on NULL-safe keys with presence markers (a
key test cannot tell "absent" from "NULL key").  Both sides are unique on
the key (the source is de-duplicated first, M7), so hash partitioning by key
has no hot partitions.  The physical plan is a sort-merge join with a hash
exchange per side, except on a side already hash-partitioned by a never-NULL
key (``null_safe=False``; e.g. a batch fresh from latest-per-key).
``upsert_touched`` / ``upsert_partitions`` read only the target partitions a
batch can change; ``TableStore.publish_partitions`` rewrites only those.
``upsert_changed`` goes further: it compares the batch with the stored guard
first and joins and rewrites only partitions in which some row changes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martspark.session import checkpoint_dir, materialize, tidy

_T, _S = "__in_target", "__in_source"


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, on_match: str = "update",
           guard: str | None = None, stamps: Mapping[str, Column] | None = None,
           with_action: bool = False, null_safe: bool = True) -> DataFrame:
    """New state of ``target`` after applying ``source`` (see module doc).

    ``null_safe=False`` is for keys that are never NULL (e.g. a hash): the
    join then uses plain equality on the key columns, so an input already
    hash-partitioned by the key (the de-duplication output) is joined
    without another shuffle.  The NULL-safe form is planned on
    ``coalesce``/``isnull`` key pairs, which hides such partitioning.
    """
    if on_match not in ("update", "keep"):
        raise ValueError("on_match must be 'update' or 'keep'")
    stamps = dict(stamps or {})
    tcols = target.columns
    src_cols = set(source.columns)
    if update_cols is None:
        update_cols = [c for c in tcols if c in src_cols and c not in keys and c not in stamps]
    t = target.withColumn(_T, F.lit(True)).alias("t")
    s = source.select(*[c for c in source.columns if c in tcols]).withColumn(_S, F.lit(True)).alias("s")
    cond = None
    for k in keys:
        tk, sk = F.col(f"t.{k}"), F.col(f"s.{k}")
        e = tk.eqNullSafe(sk) if null_safe else (tk == sk)
        cond = e if cond is None else cond & e
    if on_match == "keep" and not with_action:
        # Existing rows never change: look up the source's keys only and
        # append the missing ones; the target's other columns are not joined.
        known = target.select(*keys).withColumn(_T, F.lit(True)).alias("t")
        fresh = s.join(known, cond, "left_anti").select(*[
            (stamps[c] if c in stamps else F.col(f"s.{c}") if c in src_cols else F.lit(None))
            .cast(target.schema[c].dataType).alias(c) for c in tcols])
        return target.union(fresh)
    j = t.join(s, cond, "full_outer")

    in_t = F.col(f"t.{_T}").isNotNull()
    in_s = F.col(f"s.{_S}").isNotNull()
    if on_match == "keep":
        changed = F.lit(False)
    elif guard is not None:
        changed = ~F.col(f"t.{guard}").eqNullSafe(F.col(f"s.{guard}"))
    else:
        changed = F.lit(True)
    insert = in_s & ~in_t
    update = in_s & in_t & changed

    out = []
    for c in tcols:
        tc = F.col(f"t.{c}")
        sc = F.col(f"s.{c}") if c in src_cols else F.lit(None).cast(target.schema[c].dataType)
        if c in stamps:
            v = F.when(insert | update, stamps[c].cast(target.schema[c].dataType)).otherwise(tc)
        elif c in keys:
            v = F.when(in_t, tc).otherwise(sc)
        elif c in update_cols:
            v = F.when(insert | update, sc).otherwise(tc)
        else:  # identity columns: set on insert, never updated
            v = F.when(insert, sc).otherwise(tc)
        out.append(v.alias(c))
    if with_action:
        out.append(F.when(insert, "insert").when(update, "update")
                    .when(in_s, "unchanged").otherwise("untouched").alias("_action"))
    return j.select(*out)


def touched_partitions(target: DataFrame, source: DataFrame, keys: Sequence[str], partition_col: str,
                       partition_values: Sequence | None = None, locate: bool = False) -> list:
    """Partition values an upsert of ``source`` into ``target`` can change.

    The batch's own values plus, with ``locate=True``, the partitions where
    the batch's keys live now (needed when the partition column can change
    on update).  Locating reads two columns of the target and semi-joins
    them with the batch keys (AQE broadcasts the keys when the batch is
    small).  The result is bounded by the number of table partitions.
    """
    if partition_values is None:
        partition_values = [r[0] for r in source.select(partition_col).distinct().collect()]
    values = list(partition_values)
    if locate:
        here = (target.select(*keys, partition_col)
                .join(source.select(*keys).distinct(), list(keys), "left_semi")
                .select(partition_col).distinct().collect())
        values += [r[0] for r in here if r[0] not in values]
    return values


def partition_filter(partition_col: str, values: Sequence) -> Column:
    """``partition_col IN values`` (NULL-aware, never NULL itself)."""
    vals = [v for v in values if v is not None]
    cond = F.col(partition_col).isin(vals) if vals else F.lit(False)
    if len(vals) < len(values):
        cond = cond | F.col(partition_col).isNull()
    return F.coalesce(cond, F.lit(False))


def upsert_touched(target: DataFrame, source: DataFrame, keys: Sequence[str], partition_col: str,
                   partition_values: Sequence | None = None, locate: bool = False,
                   materialize: bool = True, **kwargs) -> tuple[DataFrame, list]:
    """New state of the touched partitions only, and their values.

    The static filter on the partition column is applied by the parquet
    scan as ``PartitionFilters``, so only touched partitions are read and
    shuffled; ``TableStore.publish_partitions`` then rewrites only them.
    The batch is read up to three times (its partition values, the key
    lookup, the join), so by default it is checkpointed once to the
    session's shared checkpoint folder instead of being recomputed.  The
    join then shuffles the checkpointed batch once more (a checkpoint does
    not carry the hash partitioning), which costs far less than running the
    batch's preparation, with its own shuffle, two more times.
    """
    if materialize:
        checkpoint_dir(source.sparkSession)
        source = source.checkpoint(eager=True)
    values = touched_partitions(target, source, keys, partition_col, partition_values, locate)
    return upsert(target.where(partition_filter(partition_col, values)), source, keys, **kwargs), values


def upsert_partitions(target: DataFrame, source: DataFrame, keys: Sequence[str], partition_col: str,
                      partition_values: Sequence | None = None, locate: bool = False,
                      **kwargs) -> DataFrame:
    """``upsert`` that joins only the target partitions the batch touches;
    untouched partitions pass through without a shuffle.  Without ``locate``
    the partition column must be a function of the key (e.g. the country in
    the sales key); see ``touched_partitions``."""
    merged, values = upsert_touched(target, source, keys, partition_col, partition_values, locate, **kwargs)
    outside = target.where(~partition_filter(partition_col, values))
    if kwargs.get("with_action"):
        outside = outside.withColumn("_action", F.lit("untouched"))
    return merged.unionByName(outside)


@dataclass(frozen=True)
class Changes:
    """What a batch changes in a stored table."""

    merged: DataFrame      # new state of the partitions in ``values``, with ``_action``
    values: list           # partitions in which a row is inserted, updated or moved away
    counts: dict[str, int]  # rows of the batch per action: insert, update, unchanged
    changed: DataFrame     # the changed rows or keys, written once; for ``session.release``
    part: Callable[[int, int], DataFrame]  # part i of n of ``merged``, by key: n parts shuffle one after the other


def upsert_changed(target: DataFrame, source: DataFrame, keys: Sequence[str], partition_col: str, guard: str,
                   candidates: Sequence | None = None, null_safe: bool = True, stored: bool = False,
                   **kwargs) -> Changes:
    """Guarded upsert (M3) of only the partitions that change.

    The batch meets the target's key and guard columns in the partitions that
    may hold its keys (``candidates``, e.g. from ``profile.may_hold``; None: all), which
    tells inserted, updated and unchanged rows apart.  Unchanged rows go no
    further: partitions holding only such rows are neither read as a whole nor
    rewritten, and a batch delivered again changes nothing.  A changed row
    that moves to another partition changes both.  The changed rows are written once;
    partition lists and counts are bounded by the number of partitions.
    ``stored``: the batch is read from files (``session.materialize``), so only its key, guard and
    partition columns meet the target and only the changed keys are written; the rows of
    these keys are read again, the whole batch if none is unchanged.  Where no partition
    may hold its keys (``candidates`` empty), all are inserted, and its rows are only counted per partition.
    """
    if stored and candidates is not None and not candidates:
        with tidy(source.sparkSession):
            own = source.groupBy(partition_col).agg(F.count(F.lit(1)).alias("_n")).collect()
        values = [r[0] for r in own]
        part = _parts(target.where(partition_filter(partition_col, values)), source, keys, guard=guard,
                      null_safe=null_safe, with_action=True, **kwargs)
        none = source.sparkSession.createDataFrame([], source.select(*keys).schema)
        return Changes(part(0, 1), values, {"insert": sum(r["_n"] for r in own), "update": 0, "unchanged": 0}, none,
                       part)
    here = target if candidates is None else target.where(partition_filter(partition_col, candidates))
    # one row per key, so that a damaged target cannot multiply the batch
    held = here.select(*keys, F.col(guard).alias("_guard"), F.col(partition_col).alias("_at")).groupBy(
        *keys).agg(F.collect_set(F.struct("_at")).alias("_held"), F.min(F.struct("_guard")).alias("_guard"),
                   F.lit(True).alias("_known"))
    cond = None
    for k in keys:
        a, b = F.col(f"s.{k}"), F.col(f"h.{k}")
        e = a.eqNullSafe(b) if null_safe else a == b
        cond = e if cond is None else cond & e
    compared = source.select(*dict.fromkeys([*keys, guard, partition_col])) if stored else source
    j = compared.alias("s").join(held.alias("h"), cond, "left").select(
        "s.*", "_held", F.when(F.col("_known").isNull(), F.lit("insert"))
        .when(F.col("_guard._guard").eqNullSafe(F.col(f"s.{guard}")), F.lit("unchanged"))
        .otherwise(F.lit("update")).alias("_action"))
    obs, actions = Observation(), ["insert", "update", "unchanged"]
    changed = materialize(j.observe(obs, *[F.count_if(F.col("_action") == a).alias(a) for a in actions])
                          .where(F.col("_action") != "unchanged"))
    counts = {a: int(obs.get[a]) for a in actions}
    own = F.struct(F.col(partition_col).alias("_at"))
    with tidy(source.sparkSession):
        places = changed.select(F.explode(F.array_append(F.coalesce("_held", F.array().cast(
            changed.schema["_held"].dataType)), own)).alias("_p")).select("_p._at").distinct()
        values = [r[0] for r in places.collect()]
    rows = changed.drop("_held", "_action")
    if stored:
        cond = None
        for k in keys:
            a, b = F.col(f"s.{k}"), F.col(f"c.{k}")
            e = a.eqNullSafe(b) if null_safe else a == b
            cond = e if cond is None else cond & e
        rows = source if not counts["unchanged"] else source.alias("s").join(
            changed.select(*keys).alias("c"), cond, "left_semi")
    part = _parts(target.where(partition_filter(partition_col, values)), rows, keys, guard=guard,
                  null_safe=null_safe, with_action=True, **kwargs)
    return Changes(part(0, 1), values, counts, changed, part)


def _parts(target: DataFrame, source: DataFrame, keys: Sequence[str], **kwargs) -> Callable[[int, int], DataFrame]:
    """``upsert`` of the rows whose key falls to part ``i`` of ``n``; the parts make up the whole."""
    def part(i: int, n: int) -> DataFrame:
        if n == 1:
            return upsert(target, source, keys, **kwargs)
        own = F.pmod(F.xxhash64(*[F.col(k).cast(target.schema[k].dataType) for k in keys]), F.lit(n)) == F.lit(i)
        return upsert(target.where(own), source.where(own), keys, **kwargs)
    return part
