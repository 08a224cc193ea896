"""Exact duplicates through an extendible-hash index on shared files.

Native DataFrame operations only.

1. Every text has a 64-bit key.  The keys, counted per map task, make the directory: a
   bucket of more than ``capacity`` keys is split on the next key bit and the directory
   doubles, up to ``max_depth`` bits; a bucket of that depth holds its overflow.
   The directory has at most 2**max_depth slots and is broadcast.
2. Rows are routed through the directory: a key's first bits name its slot, the
   slot its bucket, and buckets are range-partitioned, so each owner task has a range
   of keys.  Inside its range the owner groups equal texts (by comparing whole texts),
   chains different texts of one key, and writes the entries (bucket, 64-bit key, chain
   number, keeper, group size, SHA-256) in key order.
3. A lookup goes the same way: key, slot, bucket, and entries of that bucket only.
   A key with a chain of one identifies its text; documents of a chained
   key are matched to their entry by comparing texts again.

Copies are combined before they are routed: rows of a hot key are merged per map task
first, so a text that a third of all rows share reaches its owner as one row per task.

Defined cases: a null text counts as ''; texts differ unless identical;
a null doc_id never wins over a number; if a doc_id is repeated with the same
text, all its rows count in ``group_size`` and share ``kept``; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from martspark.llm.common import partitions, scratch_path, stored, table

CAPACITY = 1 << 16  # keys of a bucket, at most
BUCKETS = 16        # per partition, at least, if there are enough keys
MAX_DEPTH = 18      # the directory has at most 262,144 slots
HOT = 1024          # a key is hot with more rows than this and than ...
HOT_SHARE = 16      # ... this part of an average partition: at most 16 keys a partition


@dataclass(frozen=True)
class Index:
    """Paths of a stored index."""

    entries: str    # bucket, local_depth, key, chain, chain_len, keep_id, group_size, text_sha256
    directory: str  # slot, bucket, local_depth: one row per slot
    key_bits: int
    chained: bool   # some key holds more than one text


def text_key(text: Column, key_bits: int = 64) -> Column:
    h = F.xxhash64(text)
    return h if key_bits == 64 else F.shiftrightunsigned(h, 64 - key_bits)


def _slot(key: Column, key_bits: int, depth: int) -> Column:
    """The first ``depth`` bits of a key (a shift by 64 would be none)."""
    return F.shiftrightunsigned(key, key_bits - depth) if depth else F.lit(0).cast("long")


def _slots(buckets: DataFrame, depth: int) -> DataFrame:
    """The directory proper: 2**depth slots, each naming its bucket."""
    width = F.expr(f"shiftleft(1L, {depth} - depth)")
    first = F.col("prefix") * width
    return buckets.select(F.explode(F.sequence(first, first + width - 1)).alias("slot"),
                          first.alias("bucket"), F.col("depth").alias("local_depth"))


def _routed(rows: DataFrame, spark: SparkSession, path: str, key_bits: int) -> DataFrame:
    """``rows`` (column key) with the bucket that the stored directory names."""
    slots = spark.read.parquet(path)
    depth = (slots.agg(F.max("slot")).first()[0] or 0).bit_length()
    # bounded: 2**max_depth slots
    return (rows.withColumn("slot", _slot(F.col("key"), key_bits, depth))
            .join(F.broadcast(slots), "slot").drop("slot"))


def directory(keys: DataFrame, key_bits: int, capacity: int, max_depth: int) -> DataFrame:
    """Buckets (depth, prefix, n) of an extendible hash over ``keys.key``.

    Counts entries per prefix at every depth at once and keeps the prefixes
    whose parent overflows but which do not, which is where splitting one
    bucket at a time ends.  The histogram has at most 2**max_depth rows.
    """
    max_depth = min(max_depth, key_bits)
    hist = keys.groupBy(_slot(F.col("key"), key_bits, max_depth).alias("slot")).agg(
        F.count("*").alias("n"))
    levels = (hist.select(F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth"),
                          "slot", "n")
              .withColumn("prefix", F.expr(f"shiftrightunsigned(slot, {max_depth} - depth)"))
              .groupBy("depth", "prefix").agg(F.sum("n").alias("n")))
    over = levels.where(F.col("n") > capacity)
    parents = over.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"))
    fits = (F.col("n") <= capacity) | (F.col("depth") == max_depth)
    below = levels.withColumn("up", F.shiftrightunsigned("prefix", 1)).join(
        parents, ["depth", "up"], "left_semi")
    return (below.where(fits & (F.col("depth") > 0)).select("depth", "prefix", "n")
            .union(levels.where((F.col("depth") == 0) & fits).select("depth", "prefix", "n")))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                key_bits: int = 64, capacity: int | None = None, max_depth: int = MAX_DEPTH) -> Index:
    """Build the directory, group texts in their owners and store both in the shared folder.

    ``capacity`` defaults to what gives every partition ``BUCKETS`` buckets, ``CAPACITY`` at most.
    """
    spark = docs.sparkSession
    p = partitions(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(text_key(text, key_bits).alias("key"), text.alias("text"),
                       F.col(id_col).alias("id"))
    keys = stored(rows.groupBy("key").agg(F.count("*").alias("rows")), "exact-keys")
    size = keys.agg(F.count("*").alias("keys"), F.sum("rows").alias("rows")).first()
    if capacity is None:
        capacity = max(1, min(CAPACITY, size.keys // (BUCKETS * p)))
    path = scratch_path(spark, "exact-index")
    buckets = stored(directory(keys, key_bits, capacity, max_depth), "exact-buckets")
    depth = buckets.agg(F.max("depth")).first()[0] or 0
    _slots(buckets, depth).write.parquet(f"{path}/directory")

    limit = max(HOT, (size.rows or 0) // (HOT_SHARE * p))
    hot = keys.where(F.col("rows") > limit).select("key", F.lit(True).alias("hot"))
    marked = rows.join(F.broadcast(hot), "key", "left")  # bounded: HOT_SHARE * p keys
    one = marked.where(F.col("hot").isNull()).select("key", "text", "id", F.lit(1).cast("long").alias("n"))
    # copies of a hot key meet in the map task that reads them, not yet in one place
    many = (marked.where("hot").groupBy(F.spark_partition_id().alias("task"), "key", "text")
            .agg(F.max("id").alias("id"), F.count("*").alias("n")).drop("task"))
    owned = (_routed(one.unionByName(many), spark, f"{path}/directory", key_bits)
             .repartitionByRange(p, "bucket"))
    # from here on every step works inside the owner's range of buckets
    entries = (owned.groupBy("bucket", "key", "text")
               .agg(F.first("local_depth").alias("local_depth"), F.max("id").alias("keep_id"),
                    F.sum("n").alias("group_size"))
               .withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256)).drop("text"))
    chain = W.partitionBy("bucket", "key")
    (entries.withColumn("chain", F.row_number().over(chain.orderBy("text_sha256")))
     .withColumn("chain_len", F.count("*").over(chain))
     .sortWithinPartitions("bucket", "key", "chain").write.parquet(f"{path}/entries"))
    chained = not spark.read.parquet(f"{path}/entries").where("chain_len > 1").isEmpty()
    return Index(f"{path}/entries", f"{path}/directory", key_bits, chained)


def lookup(docs: DataFrame, index: Index, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, chain."""
    spark = docs.sparkSession
    entries = spark.read.parquet(index.entries)
    text = F.coalesce(F.col(text_col), F.lit(""))
    at = ["bucket", "key"]
    rows = _routed(docs.select(F.col(id_col).alias("doc_id"), text_key(text, index.key_bits).alias("key"),
                               text.alias("text")), spark, index.directory, index.key_bits)
    found = ["doc_id", "keep_id", "group_size", "text_sha256", "chain"]
    out = rows.drop("text").join(entries.where("chain_len = 1"), at).select(*found)
    if index.chained:
        # colliding keys: fetch the chained texts and compare bytes
        chains = entries.where("chain_len > 1")
        texts = (rows.join(chains.select(*at).distinct(), at, "left_semi")
                 .groupBy(*at, "text").agg(F.count("*").alias("n"))
                 .withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256))
                 .join(chains, [*at, "text_sha256"])
                 .select(*at, "text", "keep_id", "group_size", "text_sha256", "chain"))
        out = out.union(rows.join(texts, [*at, "text"]).select(*found))
    return out.select("doc_id", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "text_sha256", F.col("chain").cast("int").alias("chain"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    index = build_index(docs, id_col, text_col, **options)
    return lookup(docs, index, id_col, text_col)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("chain")


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
