"""Mix sources to target weights by exact word budgets.

Every document gets a hash-random key; within its source the documents are
range-sorted by it, a distributed prefix sum of sizes gives each document's
start, and a source is cut at its exact budget.  A budget above the source's
size repeats it: whole epochs first, then the start of the order again.  The
document at the cut is taken in part, so a source's words equal its rounded
target.  A hot source is spread over many ranges.

Targets: sources by code point, null last, weigh 5, 2, 1, repeating; together
they get ``share`` of all words.  A source's target stops at ``max_epochs``
times its size, and the excess goes to the others by weight until none is
above.  With sources in order of size per weight, that ends at one level:
sources before it are at their stop, the others get level x weight.  The level
also comes from distributed prefix sums.

Defined cases: null text has size 0; documents of size 0 are never taken;
null sources form one source; rows that repeat doc_id and size are
interchangeable; an empty table gives an empty result; other columns are
ignored.  Keys are MD5 digests, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.llm.common import running_sums, stored, table, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Rows (source, source_size, target) from rows (source, source_size)."""
    by_name = F.col("source").asc_nulls_last()
    ranked = running_sums(sizes, [by_name], {"__rank": F.lit(1)})
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("__rank") % len(weights) + 1).cast("int"))
    capped = ranked.select(
        "source", "source_size", w.alias("weight"),
        (F.lit(float(max_epochs)) * F.col("source_size")).alias("cap"))
    level = stored(running_sums(
        capped.withColumn("ratio", F.col("cap") / F.col("weight")),
        [F.col("ratio"), by_name], {"cap_before": F.col("cap"), "weight_before": F.col("weight")}),
        "levels")
    total, weight = level.agg(F.sum("source_size"), F.sum("weight")).first()
    if total is None:
        return sizes.withColumn("target", F.lit(0.0))
    at = ((F.lit(share * total) - F.col("cap_before"))
          / (F.lit(weight) - F.col("weight_before")))
    lam = (level.withColumn("level", at).where(F.col("level") <= F.col("ratio"))
           .agg(F.min_by("level", F.struct("ratio", F.col("source").isNull(), "source")))
           .first()[0])
    rest = F.lit(lam) * F.col("weight") if lam is not None else F.col("cap")
    return level.select("source", "source_size", F.least("cap", rest).alias("target"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
        max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken) for rows (doc_id, source, size)."""
    light = stored(docs.select("doc_id", "source", "size", F.md5(F.concat(
        F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
        .alias("key")), "mix")
    sizes = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, share, max_epochs), "targets")
    placed = running_sums(light, ["key", "doc_id", "size"], {"before": F.col("size")}, ["source"])
    a, t = placed.alias("a"), targets.alias("t")
    out = a.join(t, F.col("a.source").eqNullSafe(F.col("t.source"))).select(
        "a.doc_id", "a.size", "t.source_size", "t.target", "a.before",
        F.round("t.target").cast("long").alias("budget"))
    epochs = F.expr("IF(source_size > 0, budget DIV source_size, 0L)")
    left = F.col("budget") - epochs * F.col("source_size") - F.col("before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return out.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, as often as it takes them.

    A document taken in part is emitted whole, so no text is cut.
    """
    plan = (mix(sized(docs), **options).where(F.col("taken") > 0)
            .groupBy("doc_id", "size").agg(F.sum("taken").alias("taken"),
                                           F.count("*").alias("rows")))
    copies = F.expr("CAST(ceil(taken / rows / size) AS INT)")
    p = plan.select(F.col("doc_id").alias("__id"), F.col("size").alias("__size"),
                    copies.alias("__copies"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (word_count(F.col("text"))
                                                        == F.col("__size"))
    return (docs.join(p, same)
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .select(*docs.columns))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(sized(table(spark, sf_dir, "documents")))


SQL = f"""
WITH d AS (SELECT doc_id, source, md5('{SEED}' || coalesce(doc_id::VARCHAR, '')) AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS k FROM d GROUP BY source),
w AS (SELECT *, CASE k WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight,
    {MAX_EPOCHS}.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, cap / weight AS ratio,
    ({SHARE}::DOUBLE * sum(source_size) OVER ()
     - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER ()
       - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
m AS (SELECT min(level) AS lam FROM (SELECT level FROM l WHERE level <= ratio
      ORDER BY ratio, source NULLS LAST LIMIT 1)),
t AS (SELECT source, source_size, least(cap, lam * weight) AS target,
    CAST(round(least(cap, lam * weight)) AS BIGINT) AS budget FROM l, m),
p AS (SELECT doc_id, size, source_size, target, budget,
    CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs,
    CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
    epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS taken
FROM p
"""
