"""Shards along a Hilbert curve over several metadata dimensions.

Native DataFrame operations only.  Each dimension is quantised to at most
2**bits cells, keeping order: one cell per distinct value if there are that few, else
quantiles of the rows, counted exactly.  So a frequent value has a cell of its own, and
rare ones share cells of about equal row count.  The cell's Hilbert index orders the rows,
and runs of equal row count become shards.  Neighbours on the curve agree in all
dimensions, so a shard's value ranges are narrow in each of them and files can be pruned on any.

Row numbers come without a global sort: cells are at most 2**(bits x
dimensions), a hot cell is split into parts by the id's hash, the parts'
counts give offsets, and rows are numbered inside a part.  A part holds about
1/``PARTS`` of all rows at any size.

Defined cases: null text has 0 bytes, so size 16; null lang or source sort as
'' ; null doc_id is ordered last within its part; repeated rows each get a
slot; an empty table gives an empty result; other columns are ignored.
Law ``rows``: shard sizes differ by at most one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from martspark.llm.common import running_sums, stored, table

SHARDS = 40
BITS = 4
PARTS = 8192


def cell_bounds(rows: DataFrame, dim: str, bits: int, total: int) -> list:
    """The smallest value of each cell of ``dim``, rising; at most 2**bits values."""
    values = rows.groupBy(dim).agg(F.count("*").alias("__n"))
    few = [r[0] for r in values.select(dim).limit((1 << bits) + 1).collect()]
    if len(few) <= 1 << bits:
        return sorted(few, key=lambda v: v.encode() if isinstance(v, str) else v)
    before = running_sums(values, [dim], {"__before": F.col("__n")})
    cells = before.groupBy(F.expr(f"__before * {1 << bits} DIV {total}").alias("__q")).agg(F.min(dim).alias("v"))
    return [r.v for r in cells.orderBy("__q").collect()]


def quantised(dim: str, bounds: list, bits: int) -> Column:
    """Number of the cell that holds the value of ``dim``.

    Fewer than 2**bits cells are spread over the whole axis: what its first bits tell apart
    stays apart on the curve."""
    known = F.array(*[F.lit(v) for v in bounds])
    nth = F.size(F.filter(known, lambda b: b <= F.col(dim))) - 1
    return F.floor(nth * F.lit(1 << bits) / F.lit(len(bounds))).cast("int")


def hilbert_index(axes: list[str], bits: int) -> Column:
    """Hilbert index of a grid cell (Skilling's transform as SQL higher-order functions)."""
    n = len(axes)
    x = f"array({', '.join(f'CAST({a} AS BIGINT)' for a in axes)})"
    if bits > 1:
        # undo the excess work from the top bit down: swap or invert the low bits
        step = ("transform(x, (v, j) -> CASE"
                " WHEN (x[i] & shiftleft(1L, b)) <> 0 THEN"
                "   IF(j = 0, v ^ (shiftleft(1L, b) - 1), v)"
                " WHEN i = 0 THEN v"
                " WHEN j = 0 OR j = i THEN v ^ ((x[0] ^ x[i]) & (shiftleft(1L, b) - 1))"
                " ELSE v END)")
        x = (f"aggregate(sequence({bits - 1}, 1, -1), {x}, (y, b) ->"
             f" aggregate(sequence(0, {n - 1}), y, (x, i) -> {step}))")
    if n > 1:
        x = (f"aggregate(sequence(1, {n - 1}), {x}, (x, i) ->"
             " transform(x, (v, j) -> IF(j = i, v ^ x[i - 1], v)))")
    if bits > 1:
        flip = (f"aggregate(sequence({bits - 1}, 1, -1), 0L, (t, b) ->"
                f" IF((g[{n - 1}] & shiftleft(1L, b)) <> 0, t ^ (shiftleft(1L, b) - 1), t))")
        x = f"transform({x}, v -> v)" if n == 1 else x
        x = f"aggregate(array({x}), CAST(NULL AS ARRAY<BIGINT>), (a, g) -> transform(g, v -> v ^ {flip}))"
    read = (f"aggregate(sequence({bits - 1}, 0, -1), 0L, (h, b) ->"
            f" aggregate(x, h, (k, v) -> k * 2 + (shiftright(v, b) & 1L)))")
    return F.expr(f"aggregate(array({x}), 0L, (a, x) -> {read})")


def order_by_curve(rows: DataFrame, dims: list[str], key: list[str], shards: int,
                   bits: int = BITS, parts: int = PARTS) -> DataFrame:
    """Add ``cell`` (curve index), ``shard`` and ``slot`` to stored ``rows``.

    ``dims`` are non-null numbers or texts, ``key`` the columns that order rows of
    one cell; the first of them also splits hot cells.  Broadcasts: cells (at
    most 2**(bits x dims) rows) and parts (at most that plus ``parts``).
    """
    total = rows.count()
    if not total:
        return rows.select("*", *[F.lit(None).cast("long").alias(c) for c in ("cell", "slot")],
                           F.lit(None).cast("int").alias("shard"))
    cell = {f"__q_{d}": quantised(d, cell_bounds(rows, d, bits, total), bits) for d in dims}
    gridded = rows.withColumns(cell)
    cells = (gridded.groupBy(*cell).agg(F.count("*").alias("__n"))
             .withColumn("cell", hilbert_index(list(cell), bits))
             .withColumn("__parts", F.expr(f"CAST(ceil(__n * {parts} / {total}) AS BIGINT)")))
    split = F.conv(F.substring(F.md5(F.coalesce(F.col(key[0]).cast("string"), F.lit(""))
                                     .cast("binary")), 1, 8), 16, 10).cast("long")
    placed = (gridded.join(F.broadcast(cells.drop("__n")), list(cell))
              .withColumn("__part", split % F.col("__parts")).drop("__parts", *cell))
    counts = placed.groupBy("cell", "__part").agg(F.count("*").alias("__n"))
    before = W.orderBy("cell", "__part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("cell", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0))
                           .alias("__start"))
    inside = W.partitionBy("cell", "__part").orderBy(
        F.col(key[0]).asc_nulls_last(), *[F.col(k) for k in key[1:]])
    ranked = (placed.withColumn("__row", F.row_number().over(inside) - 1)
              .join(F.broadcast(starts), ["cell", "__part"])
              .withColumn("__row", F.col("__start") + F.col("__row")))
    return (ranked.withColumn("shard", F.expr(f"CAST(__row * {shards} DIV {total} AS INT)"))
            .withColumn("slot", F.expr(f"__row - (shard * {total}L + {shards - 1}) DIV {shards}"))
            .drop("__row", "__part", "__start"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Shard and slot per document, over language, source and text size."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    light = stored(docs.select(
        "doc_id", (F.octet_length(data).cast("long") + 16).alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.coalesce(F.col("lang"), F.lit("")).alias("d_lang"),
        F.coalesce(F.col("source"), F.lit("")).alias("d_source")), "curve")
    return order_by_curve(light, ["d_lang", "d_source", "size"],
                          ["doc_id", "size", "text_crc32"], shards, bits)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write documents into ``path/shard=<n>`` in slot order.

    A ``shard`` or ``slot`` column of the input is replaced.
    """
    placed = shard_documents(docs, shards).select(
        F.col("doc_id").alias("__id"), F.col("text_crc32").alias("__crc"), "shard", "slot",
        F.row_number().over(W.partitionBy("doc_id", "text_crc32").orderBy("shard", "slot"))
        .alias("__k"))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rest = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = docs.select(*rest).withColumn("__c", crc).withColumn(
        "__j", F.row_number().over(W.partitionBy("doc_id", "__c").orderBy("text")))
    same = (F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__c") == F.col("__crc"))
            & (F.col("__j") == F.col("__k")))
    (rows.join(placed, same).select(*rest, "shard", "slot")
     .repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), "cell")


def _sql() -> str:
    """The same shards in SQL: the curve's steps unrolled over the distinct cells."""
    full = 1 << BITS
    steps, name = [], "c0"
    names = ["x0", "x1", "x2"]

    def step(exprs: dict[str, str], extra: str = "") -> None:
        nonlocal name
        new = f"c{len(steps) + 1}"
        steps.append(f"{new} AS (SELECT q0, q1, q2, n, "
                     + ", ".join(f"{exprs.get(x, x)} AS {x}" for x in names) + f" FROM {name})")
        name = new

    for b in range(BITS - 1, 0, -1):
        q, p = 1 << b, (1 << b) - 1
        for i in range(3):
            if i == 0:
                step({"x0": f"CASE WHEN x0 & {q} <> 0 THEN xor(x0, {p}) ELSE x0 END"})
                continue
            t = f"(xor(x0, x{i}) & {p})"
            on = f"x{i} & {q} <> 0"
            step({"x0": f"CASE WHEN {on} THEN xor(x0, {p}) ELSE xor(x0, {t}) END",
                  f"x{i}": f"CASE WHEN {on} THEN x{i} ELSE xor(x{i}, {t}) END"})
    step({"x1": "xor(x1, x0)"})
    step({"x2": "xor(x2, x1)"})
    flip = "0::BIGINT"
    for b in range(BITS - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN x2 & {1 << b} <> 0 THEN {(1 << b) - 1} ELSE 0 END)"
    step({x: f"xor({x}, {flip})" for x in names})
    bits = " + ".join(f"((x{i} >> {b}) & 1) * {1 << (3 * b + 2 - i)}"
                      for b in range(BITS) for i in range(3))
    quantiles = ",\n".join(f"""v{i} AS (SELECT d{i} AS v, count(*) AS n FROM d GROUP BY d{i}),
b{i} AS (SELECT v, nth * {full} // (max(nth) OVER () + 1) AS q{i} FROM (
  SELECT v, dense_rank() OVER (ORDER BY raw) - 1 AS nth FROM (
  SELECT v, CASE WHEN (SELECT count(*) FROM v{i}) <= {full} THEN row_number() OVER (ORDER BY v)
    ELSE coalesce(sum(n) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * {full}
         // (SELECT count(*) FROM d) END AS raw FROM v{i})))""" for i in range(3))
    return f"""
WITH RECURSIVE tbl(i, k, v) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END
  FROM tbl WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM tbl WHERE k = 8),
d AS (SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
        xor(list_reduce(list_prepend(4294967295::BIGINT,
            list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                           lambda h: CAST('0x' || h AS BIGINT))),
          lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32,
        coalesce(lang, '') AS d0, coalesce(source, '') AS d1, strlen(coalesce(text, '')) AS d2
      FROM documents, crc),
{quantiles},
g AS (SELECT d.*, (SELECT count(*) FROM d) AS total, q0, q1, q2
      FROM d JOIN b0 ON d0 = b0.v JOIN b1 ON d1 = b1.v JOIN b2 ON d2 = b2.v),
c0 AS (SELECT q0, q1, q2, count(*) AS n, q0::BIGINT AS x0, q1::BIGINT AS x1, q2::BIGINT AS x2
       FROM g GROUP BY q0, q1, q2),
{', '.join(steps)},
h AS (SELECT q0, q1, q2, n, {bits} AS cell FROM {name}),
p AS (SELECT g.*, cell, CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT)
        % CAST(ceil(n * {PARTS} / total) AS BIGINT) AS part
      FROM g JOIN h USING (q0, q1, q2)),
r AS (SELECT *, row_number() OVER (ORDER BY cell, part, doc_id NULLS LAST, bytes, text_crc32) - 1
        AS rk FROM p),
s AS (SELECT *, CAST(rk * {SHARDS} // total AS INTEGER) AS shard FROM r)
SELECT doc_id, bytes + 16 AS size, text_crc32, 'rows' AS law, shard,
       rk - (shard * total + {SHARDS - 1}) // {SHARDS} AS slot,
       CAST(NULL AS INTEGER) AS grown_shard, cell
FROM s
"""


SQL = _sql()
