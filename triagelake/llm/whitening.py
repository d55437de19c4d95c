"""Whitening of embeddings by shifted CholeskyQR: distributed Gram passes, triangular solves, composed R factors, SVD of R.

Rows.  A row whose vector is null or holds a null or non-finite entry is dropped.  The dimension of the table is the most frequent
vector length (ties: the longer); rows of other lengths are dropped as malformed.  Each entry c becomes the integer
x = floor(1024 c) + 100000; the fit list is all remaining rows: n rows with per-dimension sums S.

Fit.  With the centred rows A = x - S/n (never materialised beyond one Arrow batch), three passes over the rows each sum the Gram
matrix of A R^-1 for the R found so far (A itself first); partial Grams of every task are reduced by Spark, entry by entry.
Each Cholesky factor is taken of G + s I with the shift s = 11 (n d + d (d + 1)) u trace(G), which keeps it defined however
ill-conditioned or rank-deficient A is; the second and third restore orthogonality to working precision (CholeskyQR3).  The composed R = R3 R2 R1 satisfies
A = Q R with orthonormal Q, so the SVD R = U diag(sigma) W' gives the eigenvectors of the covariance V = A'A / n as the columns of
W and its eigenvalues as e = sigma^2 / n.  A component's sign makes its largest entry positive.

Results.  For each remaining row and component k up to ``COMPONENTS``: whitened = (x - S/n) . w_k / sqrt(e_k), explained = e_k /
trace(V), deviation = sum over dimensions of (n x - S)^2 in exact integers (``deviation_exact``, decimal; ``deviation`` the same as
long, null beyond its range) and identity_error, the largest absolute entry of the covariance of the whitened values (centred,
divisor n) less the identity, measured on the written rows in one more pass.  Components with e_k <= d u trace(V) (no variance left:
n = 1, constant or dependent dimensions) have a null whitened and are left out of identity_error; with trace(V) = 0 explained is
null too.  Repeated rows and repeated vec_ids are separate rows of the fit.  An empty table, or one without any remaining row, gives
an empty result.  Other columns are ignored.

Memory.  The driver holds d x d matrices and d sums only; every task one Arrow batch of rows and one d x d Gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm.common import stored

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000


def integers(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id, x (array of longs) of all rows that remain, each of the table's dimension."""
    finite = embeddings.where(F.col(column).isNotNull()).where(
        F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf")))))
    lengths = finite.groupBy(F.size(column).alias("d")).count()
    modal = lengths.orderBy(F.desc("count"), F.desc("d")).limit(1)
    return (finite.join(modal.select("d").hint("broadcast"), F.size(column) == F.col("d"))  # one row: the modal length
            .select(F.col(key).alias("vec_id"),
                    F.transform(column, lambda c: F.floor(F.lit(SCALE) * c.cast("double")) + F.lit(OFFSET)).alias("x")))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().astype(np.float64).reshape(-1, d) if batch.num_rows else np.zeros((0, d))


def moments(rows: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """n and the exact per-dimension sums S: one partial row per task, summed by dimension in Spark."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                total += batch.column("x").flatten().to_numpy().astype(np.int64).reshape(-1, d).sum(axis=0)
                n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([n, *total.tolist()], pa.int64())], names=["i", "v"])

    got = (rows.select("x").mapInArrow(partial, "i int, v long").groupBy("i").agg(F.sum("v").alias("v"))).collect()
    values = dict((r.i, r.v) for r in got)
    return int(values.get(-1, 0)), np.array([values.get(i, 0) for i in range(d)], dtype=np.int64)


def solve_upper(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Y with Y R = A for an upper triangular R, column by column (forward substitution)."""
    y = np.empty_like(a)
    for j in range(r.shape[0]):
        y[:, j] = (a[:, j] - y[:, :j] @ r[:j, j]) / r[j, j]
    return y


def gram(rows: DataFrame, d: int, mean: np.ndarray, r: np.ndarray | None) -> np.ndarray:
    """Sum over all rows of B'B with B = (x - mean) R^-1 (R = identity if None): partial Grams per task, reduced by entry."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            a = _matrix(batch, d) - mean
            b = a if r is None else solve_upper(a, r)
            total += b.T @ b
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i * d + j, pa.int64()), pa.array(total[i, j])], names=["k", "v"])

    got = rows.select("x").mapInArrow(partial, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    g = np.zeros((d, d))
    for row in got:
        g[row.k // d, row.k % d] = row.v
    return np.triu(g) + np.triu(g, 1).T


def components(rows: DataFrame, d: int, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues e (falling) and unit eigenvectors (columns) of the covariance, by shifted CholeskyQR3 and the SVD of R."""
    mean = sums / n

    def factor(g: np.ndarray) -> np.ndarray:
        shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps * max(np.trace(g), np.finfo(float).tiny)
        return np.linalg.cholesky(g + shift * np.eye(d)).T

    r = factor(gram(rows, d, mean, None))
    for _ in range(2):
        r = factor(gram(rows, d, mean, r)) @ r
    _, sigma, wt = np.linalg.svd(r)
    w = wt.T
    w = w * np.where(w[np.abs(w).argmax(axis=0), np.arange(d)] < 0, -1.0, 1.0)
    return sigma ** 2 / n, w


def whiten(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, deviation_exact, whitened, explained, identity_error: one row per row and component."""
    rows = stored(integers(embeddings, column, key), "whitening-rows")
    first = rows.select(F.size("x").alias("d")).limit(1).collect()
    spark = rows.sparkSession
    if not first or first[0].d == 0:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, deviation_exact decimal(38,0), "
                                         "whitened double, explained double, identity_error double")
    d = first[0].d
    n, sums = moments(rows, d)
    e, w = components(rows, d, n, sums)
    trace = float(e.sum())
    k = min(most, d)
    alive = [bool(e[c] > d * np.finfo(float).eps * trace) for c in range(k)]
    mean = F.array(*[F.lit(float(m)) for m in sums / n])
    centred = F.zip_with("x", mean, lambda v, m: v.cast("double") - m)

    def projection(c: int) -> F.Column:
        if not alive[c]:
            return F.lit(None).cast("double")
        vector = F.array(*[F.lit(float(v)) for v in w[:, c]])
        return F.aggregate(F.zip_with(F.col("centred"), vector, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v) / F.lit(
            float(np.sqrt(e[c])))

    exact = F.aggregate(
        F.zip_with("x", F.array(*[F.lit(int(s)) for s in sums]),
                   lambda a, s: (F.lit(n) * a - s).cast("decimal(38,0)")),
        F.lit(0).cast("decimal(38,0)"), lambda t, v: (t + v * v).cast("decimal(38,0)"))
    wide = stored(rows.select("vec_id", "x", centred.alias("centred")).select(
        "vec_id", exact.alias("deviation_exact"), F.array(*[projection(c) for c in range(k)]).alias("whitened")), "whitening-wide")
    error = identity_error(wide, [c for c in range(k) if alive[c]])
    explained = [float(e[c] / trace) if trace > 0 else None for c in range(k)]
    return wide.select(
        "vec_id", F.lit(n).cast("long").alias("n"), "deviation_exact",
        F.expr("try_cast(deviation_exact AS bigint)").alias("deviation"),
        F.posexplode("whitened").alias("c", "whitened")).select(
        "vec_id", (F.col("c") + 1).cast("int").alias("component"), "n", "deviation", "deviation_exact", "whitened",
        F.element_at(F.array(*[F.lit(v).cast("double") for v in explained]), F.col("c") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


def identity_error(wide: DataFrame, alive: list[int]) -> float | None:
    """Largest absolute entry of cov(whitened) - I over the components that have variance: one pass, partial sums per task."""
    if not alive:
        return None
    k = len(alive)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, p = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                y = batch.column("whitened").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)[:, alive]
                n, s, p = n + len(y), s + y.sum(axis=0), p + y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, k * k + k), pa.int32()),
                                          pa.array([float(n), *s.tolist(), *p.reshape(-1).tolist()], pa.float64())], names=["i", "v"])

    got = dict((r.i, r.v) for r in wide.select("whitened").mapInArrow(partial, "i int, v double").groupBy("i").agg(
        F.sum("v").alias("v")).collect())
    n = got[-1]
    s = np.array([got[i] for i in range(k)])
    p = np.array([got[k + i] for i in range(k * k)]).reshape(k, k)
    covariance = (p - np.outer(s, s) / n) / n
    return float(np.abs(covariance - np.eye(k)).max())
