"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from martspark.session import checkpoint_dir

#: The white space of the word definition ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of renumbering,
    resampling or recomputing what later steps rely on.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_fold(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as '')."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs; null counts 0."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def running_sums(df: DataFrame, order: list, sums: dict[str, Column],
                 by: list[str] = ()) -> DataFrame:
    """Add exclusive running sums of ``sums`` in ``order``, within ``by``.

    Distributed prefix sums: rows are range-partitioned by (by, order) and
    stored with their range number, each range sums its own rows, and the
    ranges' totals (one row per range and ``by`` value) give the offsets.  No
    task holds more than one range, however hot one ``by`` value is.
    ``order`` must end in a column that breaks ties.
    """
    spark, by = df.sparkSession, list(by)
    n = partitions(spark)
    ranged = (df.withColumns({f"__v_{k}": c for k, c in sums.items()})
              .repartitionByRange(n, *by, *order)
              .withColumn("__range", F.spark_partition_id()))
    ranged = stored(ranged, "ranges")
    totals = ranged.groupBy("__range", *by).agg(
        *[F.sum(f"__v_{k}").alias(f"__t_{k}") for k in sums])
    before = W.partitionBy(*by).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("__range", *by, *[
        F.coalesce(F.sum(f"__t_{k}").over(before), F.lit(0)).alias(f"__o_{k}") for k in sums])
    inside = (W.partitionBy("__range", *by).orderBy(*order)
              .rowsBetween(W.unboundedPreceding, -1))
    local = ranged.withColumns({k: F.coalesce(F.sum(f"__v_{k}").over(inside), F.lit(0))
                                for k in sums})
    a, b = local.alias("a"), offsets.alias("b")
    same = F.col("a.__range") == F.col("b.__range")
    for c in by:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, same).select(
        *[F.col(f"a.{c}") for c in df.columns],
        *[(F.col(f"a.{k}") + F.col(f"b.__o_{k}")).alias(k) for k in sums])


def may_occur(df: DataFrame, on: list[str], members: DataFrame, bits: int = 1 << 26) -> DataFrame:
    """Rows of ``df`` whose ``on`` values occur in ``members``, and a few others.

    A filter to put before a join: it spares rows without a partner the
    shuffle.  Members set one bit each in a bitmap of ``bits`` bits (8 MB,
    whatever their number), which is broadcast; when they are so many that
    most bits are set, it lets more rows pass, never fewer than it should.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(bits))
    maps = (members.select(place.alias("__p"))
            .groupBy(F.bitmap_bucket_number("__p").alias("__bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__p")).alias("__bits")))
    byte = F.conv(F.hex(F.expr("substring(__bits, CAST(bitmap_bit_position(__p) DIV 8 + 1 AS INT), 1)")),
                  16, 10).cast("int")
    is_set = F.expr("shiftright(__byte, CAST(bitmap_bit_position(__p) % 8 AS INT)) & 1") == 1
    return (df.withColumn("__p", place)
            .join(F.broadcast(maps), F.bitmap_bucket_number("__p") == F.col("__bucket"))
            .withColumn("__byte", byte).where(is_set).select(*df.columns))


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of an edge list (a, b): rows (node, root).

    Alternating large-star and small-star rounds; each is two joins on a
    pre-aggregated minimum per node, so no neighbourhood is gathered.
    ``root`` is the component's smallest node.  Nodes without edges do not
    appear.
    """
    spark = edges.sparkSession
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                            F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stored(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(
                     F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                     F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s"))
                 .select("s.u", "s.v").where("u <> v").distinct())
        e = stored(small, "small")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


class BoundedCache(dict):
    """Memo of ``make(key)`` that is emptied when it reaches ``limit`` keys."""

    def __init__(self, make, limit: int = 1 << 19):
        super().__init__()
        self._make, self._limit = make, limit

    def __missing__(self, key):
        if len(self) >= self._limit:
            self.clear()
        value = self[key] = self._make(key)
        return value


def sorted_groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Cut a stream of record batches sorted by ``key`` into one table per key."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(k).to_numpy(zero_copy_only=False)) for k in key]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if lo:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)
