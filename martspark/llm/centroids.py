"""Centroid clustering with a vantage-point tree over the centroids.

Vectors are scaled to integers, so every distance, sum and tie is exact.

1. Usable vectors are scaled and stored once.
2. Each round builds a vantage-point tree over the centroids on the driver
   (they are few: ``k`` x dimension numbers, at most ``TREE_CELLS``) and
   broadcasts it.  Every vector searches it best first with a queue of its own:
   it takes the node with the smallest lower bound, computes the exact integer
   distance to the node's centroids, and queues the children whose ball or
   shell can hold a centroid at most as far as the best one.  The pruning radius is
   inclusive, so equally near centroids are all seen and the smallest number
   wins.  The vectors of a batch take their steps together.
3. A task sends, per cluster, the count and the component sums of its
   vectors; Spark adds them up.  The driver gets ``k`` x dimension sums and
   floors the means.

A lost executor repeats its share of one round from the stored vectors.

Defined cases: vectors that are null, of another length, or hold null or
non-finite entries are left out; repeated rows and equal vectors count
as often as they occur; a null id hashes as no digits; with fewer usable vectors than
``k`` there are fewer centroids, without any the result is empty; equal
start vectors give equal centroids, of which the larger number stays empty and in
place; components beyond +-2**26 after scaling raise an error, since squared distances
would not fit a long; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.llm.common import stored, table

DIM, K, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
LEAF = 2                 # centroids of a leaf
TREE_CELLS = 1 << 24     # k x dimension, what a broadcast tree may hold
LARGEST = 1 << 26        # of a scaled component
QUEUE_CELLS = 1 << 21    # queue entries of the vectors searched together


def usable(vector: Column, dim: int | None = None) -> Column:
    """Not null, without null and non-finite entries, of ``dim`` entries (never NULL)."""
    ok = vector.isNotNull() & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (
        F.abs(c.cast("double")) == F.lit(math.inf)))
    if dim is not None:
        ok = ok & (F.size(vector) == dim)
    return F.coalesce(ok, F.lit(False))


def scaled(vector: Column, scale: int, shift: int = 0, largest: int = LARGEST) -> Column:
    """floor(scale * c) + shift as longs, c as double."""
    value = lambda c: F.floor(c.cast("double") * F.lit(float(scale)))
    return F.transform(vector, lambda c: F.when(
        F.abs(c.cast("double")) * scale <= largest, value(c) + F.lit(shift).cast("long"))
        .otherwise(F.raise_error(F.lit(f"a component beyond {largest} after scaling by {scale}"))))


@dataclass(frozen=True)
class Tree:
    """Nodes in arrays; a leaf holds its centroids, an inner node its vantage point."""

    points: np.ndarray       # centroids, int64
    members: list            # per node: numbers of the centroids to measure there
    child: np.ndarray        # (nodes, 2): inside and outside child, -1: none
    low: np.ndarray          # (nodes, 2): least and greatest distance of a child's
    high: np.ndarray         # centroids to the vantage point


def build_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    members, child, low, high = [], [], [], []

    def grow(ids: np.ndarray) -> int:
        at = len(members)
        members.append(None)
        child.append([-1, -1])
        low.append([0.0, 0.0])
        high.append([0.0, 0.0])
        if len(ids) <= leaf:
            members[at] = ids
            return at
        # the centroid farthest from the first: a vantage point at the rim
        # separates better than one in the middle
        rim = int(np.argmax(_distances(points[ids], points[ids[0]])))
        members[at] = ids[rim:rim + 1]
        rest = np.delete(ids, rim)
        d = np.sqrt(_distances(points[rest], points[ids[rim]]).astype(float))
        order = np.argsort(d, kind="stable")
        half = (len(rest) + 1) // 2
        for side, part in enumerate((order[:half], order[half:])):
            if len(part):
                low[at][side], high[at][side] = d[part].min(), d[part].max()
                child[at][side] = grow(rest[part])
        return at

    grow(np.arange(len(points)))
    return Tree(points, members, np.array(child), np.array(low), np.array(high))


def _distances(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances (int64 holds 64 components up to 2**27 apart and more)."""
    d = rows - point
    return np.einsum("ij,ij->i", d, d)


def nearest(tree: Tree, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each row's nearest centroid; distances computed."""
    n = len(rows)
    best = np.full(n, np.iinfo(np.int64).max)
    name = np.zeros(n, np.int64)
    queue = np.full((n, len(tree.members)), np.inf)  # lower bound of each queued node
    queue[:, 0] = 0.0
    alive, measured = np.arange(n), 0
    while len(alive):
        node = queue[alive].argmin(axis=1)
        bound = queue[alive, node]
        # inclusive: a node that may hold an equally near centroid is searched
        go = np.isfinite(bound) & (bound <= np.sqrt(best[alive].astype(float)))
        alive, node = alive[go], node[go]
        queue[alive, node] = np.inf
        for v in np.unique(node):
            at = alive[node == v]
            for c in tree.members[v]:
                d = _distances(rows[at], tree.points[c])
                measured += len(at)
                closer = (d < best[at]) | ((d == best[at]) & (c < name[at]))
                best[at[closer]], name[at[closer]] = d[closer], c
            if tree.child[v, 0] < 0:
                continue
            root = np.sqrt(d.astype(float))  # to the vantage point
            for side in (0, 1):
                if (kid := tree.child[v, side]) < 0:
                    continue
                lo, hi = tree.low[v, side], tree.high[v, side]
                # roots are rounded: a bound is lowered by more than their error
                slack = 1e-12 * (root + hi) + 1e-12
                queue[at, kid] = np.maximum(0.0, np.maximum(root - hi, lo - root) - slack)
    return name, best, measured


def _vectors(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """A batch's vectors, all of one length, as a matrix."""
    return np.asarray(batch.column(column).flatten(), np.int64).reshape(batch.num_rows, -1)


def _searched(tree: Tree, rows: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    step = max(16, QUEUE_CELLS // len(tree.members))
    for lo in range(0, len(rows), step):
        name, best, _ = nearest(tree, rows[lo:lo + step])
        yield slice(lo, lo + step), name, best


def _round_sums(shared, k: int, dim: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, count, total = shared.value, np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            rows = _vectors(batch, "x")
            for part, name, _ in _searched(tree, rows):
                count += np.bincount(name, minlength=k)
                np.add.at(total, name, rows[part])
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.int64()))],
            ["cluster", "n", "total"])

    return sums


def _assigned(shared):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_searched(shared.value, _vectors(batch, "x")))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(np.concatenate([f[1] for f in found]), pa.int32()),
                     pa.array(np.concatenate([f[2] for f in found]))],
                    ["vec_id", "cluster", "distance"])

    return assign


def fit(vectors: DataFrame, start: np.ndarray, rounds: int) -> np.ndarray:
    """Centroids after ``rounds`` rounds over the stored ``vectors`` (column x)."""
    spark, points = vectors.sparkSession, start
    k, dim = points.shape
    if k * dim > TREE_CELLS:
        raise ValueError(f"{k} centroids of {dim} components are beyond {TREE_CELLS} numbers")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(build_tree(points))
        parts = vectors.select("x").mapInArrow(
            _round_sums(shared, k, dim), "cluster bigint, n bigint, total array<bigint>")
        # counts and sums as decimals: no number of vectors overflows them
        wide = "decimal(38,0)"
        sums = (parts.select("cluster", "n", F.posexplode("total").alias("at", "v"))
                .groupBy("cluster", "at").agg(F.sum(F.col("n").cast(wide)).alias("n"),
                                              F.sum(F.col("v").cast(wide)).alias("v")).collect())
        moved = points.copy()
        for r in sums:  # k x dim rows at most
            moved[r.cluster, r.at] = int(r.v) // int(r.n)
        shared.unpersist()
        if np.array_equal(moved, points):  # further rounds would repeat this one
            break
        points = moved
    return points


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM,
            scale: int = SCALE, seed: int = SEED, id_col: str = "vec_id",
            vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Rows (vec_id, cluster, distance) of the usable vectors, and the centroids.

    Start: the ``k`` vectors with the smallest SHA-256 of ``<seed>:<id>``.
    """
    spark = vectors.sparkSession
    kept = stored(vectors.where(usable(F.col(vector_col), dim)).select(
        F.col(id_col).cast("long").alias("vec_id"),
        scaled(F.col(vector_col), scale).alias("x")), "vectors")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = (kept.select("x", F.sha2(name.cast("binary"), 256).alias("h"))
             .orderBy("h", "x").limit(k).collect())
    empty = spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint")
    if not first:
        return empty, np.empty((0, dim), np.int64)
    points = fit(kept, np.array([r.x for r in first], np.int64), rounds)
    shared = spark.sparkContext.broadcast(build_tree(points))
    return stored(kept.mapInArrow(_assigned(shared), empty.schema), "assigned"), points


def clustering_report(assigned: DataFrame, points: np.ndarray) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia and centroid_sha256."""
    spark = assigned.sparkSession
    sums = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows at most
    total = sum(sums.values())
    digest = lambda p: hashlib.sha256(",".join(map(str, p.tolist())).encode()).hexdigest()
    facts = spark.createDataFrame(
        [(c, s, total, digest(points[c])) for c, s in sums.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering_report(*cluster(table(spark, sf_dir, "embeddings")))


def _round_sql(i: int) -> str:
    return f"""
a{i} AS MATERIALIZED (
  SELECT rid, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT v.rid, c.cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d
        FROM comp v JOIN c{i} c USING (pos) GROUP BY v.rid, c.cluster)
  GROUP BY rid),
c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, c.pos, coalesce(m.x, c.x) AS x
  FROM c{i} c LEFT JOIN (
    SELECT a.cluster, v.pos,
           ((sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
    FROM a{i} a JOIN comp v USING (rid) GROUP BY a.cluster, v.pos) m USING (cluster, pos))"""


SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS rid,
         list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {DIM}
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
comp AS MATERIALIZED (
  SELECT rid, generate_subscripts(x, 1) AS pos, unnest(x) AS x FROM kept),
c0 AS MATERIALIZED (
  SELECT s.cluster, v.pos, v.x
  FROM (SELECT rid, row_number() OVER (
          ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS cluster
        FROM kept QUALIFY cluster < {K}) s JOIN comp v USING (rid)),
{",".join(_round_sql(i) for i in range(ROUNDS + 1))},
named AS (
  SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY pos)) AS digest
  FROM c{ROUNDS} GROUP BY cluster)
SELECT k.vec_id, a.cluster::INT AS cluster, a.distance,
       sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
       sum(a.distance) OVER ()::BIGINT AS inertia, n.digest AS centroid_sha256
FROM a{ROUNDS} a JOIN kept k USING (rid) JOIN named n USING (cluster)
"""
