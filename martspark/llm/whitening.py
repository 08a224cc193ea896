"""Embedding whitening: blockwise QR and a bidiagonal qd solver.

Entries become integers, so counts, sums and deviations are exact.

1. Usable vectors are scaled to integers and stored; the fit list holds each
   distinct vector once (copies are merged by the map tasks before the shuffle).
2. Every task reduces its centred rows to a triangular factor R, block by
   block; factors are merged sixteen at a time until one is left.  A
   factor has dimension^2 numbers however many rows it stands for, so nothing
   larger reaches a task or the driver (``MAX_DIM``).
3. ``bidiagonal.right_vectors`` of R gives the singular values s and the right
   vectors: the covariance has the eigenvalues s^2 / n and these eigenvectors.  The covariance
   itself is never formed, so small eigenvalues keep their digits.
4. All rows are projected; the covariance of the projected fit list
   is compared with the identity.

Defined cases: vectors that are null or hold null or non-finite entries are
left out, as are those whose length differs from the most frequent one (ties:
the longest); repeated rows are one fit vector and keep a result each;
directions without variance have no component, so that equal vectors alone,
a single vector or an empty table give an empty result; entries beyond +-2**26 after
scaling raise an error; a null vec_id is kept; other columns are ignored.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.llm.bidiagonal import right_vectors
from martspark.llm.centroids import scaled, usable
from martspark.llm.common import stored, table

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
MAX_DIM = 2048   # a factor of 32 MB
MERGED = 16      # factors per merging task
FACTOR = "r binary"
WIDE = "decimal(38,0)"


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("x").flatten(), np.int64).reshape(batch.num_rows, -1)


def _stack(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.vstack([r, rows]), mode="r")


def _factor_batch(r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])


@dataclass(frozen=True)
class Centre:
    """Number of fit vectors and their sums per dimension, exact."""

    n: int
    sums: np.ndarray  # int64

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact; divided by n it is the centred row."""
        return x * self.n - self.sums


def _row_factors(centre: Centre):
    def factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(centre.sums)
        r, step = np.zeros((0, d)), max(1024, d)
        for batch in batches:
            z = centre.deviations(_matrix(batch)) / centre.n
            for lo in range(0, len(z), step):
                r = _stack(r, z[lo:lo + step])
        if len(r):
            yield _factor_batch(r)

    return factors


def _merged_factors(d: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            for one in batch.column("r"):
                r = _stack(r, np.frombuffer(one.as_buffer(), float).reshape(-1, d))
        if len(r):
            yield _factor_batch(r)

    return merge


def triangular_factor(fit: DataFrame, centre: Centre) -> np.ndarray:
    """R of the centred fit rows (d x d), by a tree of merges."""
    d = len(centre.sums)
    parts = stored(fit.mapInArrow(_row_factors(centre), FACTOR), "factors")
    left = parts.count()
    while left > 1:
        to = -(-left // MERGED)
        parts = stored(parts.repartition(to).mapInArrow(_merged_factors(d), FACTOR), "factors")
        left = parts.count()
    r = np.frombuffer(parts.first().r, float).reshape(-1, d)
    return np.vstack([r, np.zeros((d - len(r), d))])


def _square_sums(y: np.ndarray) -> list[int]:
    """Exact sum of squares of each row."""
    if np.abs(y).max(initial=0) < 1 << 28 and y.shape[1] <= 64:
        return np.einsum("ij,ij->i", y, y).tolist()
    wide = y.astype(object)
    return (wide * wide).sum(axis=1).tolist()


def _projected(centre: Centre, directions: np.ndarray):
    """Whitened values of rows: the centred row times the scaled eigenvectors."""
    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = centre.deviations(x)
        return y, (y / centre.n) @ directions

    return project


def _moments(project, k: int):
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = project(_matrix(batch))[1]
            total += w.sum(axis=0)
            square += w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array([np.concatenate([total, square.ravel()])], pa.list_(pa.float64()))], ["m"])

    return moments


def _whitened(project, k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                y, w = project(_matrix(part))
                deviation = pa.array([decimal.Decimal(v) for v in _square_sums(y)],
                                     pa.decimal128(38, 0))
                at = pa.array(np.repeat(np.arange(part.num_rows), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(at),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                     deviation.take(at), pa.array(w.ravel())],
                    ["vec_id", "component", "deviation", "whitened"])

    return rows


def _column_sums(fit: DataFrame) -> tuple[int, dict[int, int]]:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for batch in batches:
            x = _matrix(batch)
            n, total = n + len(x), total + x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n]), pa.array([total], pa.list_(pa.int64()))], ["n", "total"])

    found = (fit.mapInArrow(sums, "n bigint, total array<bigint>")
             .select("n", F.posexplode("total").alias("at", "v")).groupBy("at")
             .agg(F.sum(F.col("n").cast(WIDE)).alias("n"), F.sum(F.col("v").cast(WIDE)).alias("v"))
             .collect())  # a row per dimension
    return (int(found[0].n) if found else 0), {r.at: int(r.v) for r in found}


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error).

    ``deviation`` is decimal(38,0): exact for any number of vectors.
    """
    spark = vectors.sparkSession
    kept = stored(vectors.where(usable(F.col(vector_col)) & (F.size(vector_col) > 0)).select(
        F.col(id_col).cast("long").alias("vec_id"),
        scaled(F.col(vector_col), scale, shift).alias("x")), "vectors")
    length = (kept.groupBy(F.size("x").alias("d")).count()
              .orderBy(F.col("count").desc(), F.col("d").desc()).first())
    schema = f"vec_id bigint, component int, deviation {WIDE}, whitened double"
    if length is None:
        return _with_facts(spark.createDataFrame([], schema), 0, [], 0.0)
    d = length.d
    if d > MAX_DIM:
        raise ValueError(f"vectors of {d} entries; at most {MAX_DIM} are supported")
    kept = kept.where(F.size("x") == d)
    fit = stored(kept.select("x").distinct(), "fit")
    n, sums = _column_sums(fit)
    if n * int(np.abs(list(sums.values())).max()) >= 1 << 62:
        raise ValueError(f"{n} vectors: n * x does not fit a long")
    centre = Centre(n, np.array([sums[i] for i in range(d)], np.int64))
    squares, v = right_vectors(triangular_factor(fit, centre), components)
    k = v.shape[1]
    if not k:
        return _with_facts(spark.createDataFrame([], schema), n, [], 0.0)
    e = squares / n
    project = _projected(centre, v / np.sqrt(e[:k]))
    parts = (fit.mapInArrow(_moments(project, k), "m array<double>")
             .select(F.posexplode("m").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")))
    m = np.zeros(k + k * k)
    for r in parts.collect():  # k + k * k rows
        m[r.at] = r.v
    mean = m[:k] / n  # zero but for rounding: the rows were centred before
    error = np.abs(m[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max()
    rows = kept.mapInArrow(_whitened(project, k), schema)
    return _with_facts(rows, n, (e[:k] / e.sum()).tolist(), float(error))


def _with_facts(rows: DataFrame, n: int, explained: list[float], error: float) -> DataFrame:
    share = F.array(*[F.lit(x) for x in explained]) if explained else F.array().cast("array<double>")
    return rows.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(share, F.col("component") - 1).alias("explained"),
                       F.lit(error).alias("identity_error"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` as a long, null where it would not fit; ``deviation_exact`` always has it."""
    out = whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumns({"deviation_exact": F.col("deviation"),
                            "deviation": F.col("deviation").try_cast("long")})
