"""Principal components over array columns, and time-series folds.

The covariance is built from partial Gram matrices: each Arrow batch of
centred vectors contributes its own d x d block (d^2 rows), and the blocks
are summed per cell with an ordinary aggregation — n never meets the driver
and no row is exploded into d^2 rows.  Only the d x d result is brought to
the driver for the eigen-solve.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.arrays import as_matrix, dot, fold_by_block, fold_by_phase, fractional_change, subtract

_GRAM_SCHEMA = "i int, j int, s double, n long"


def column_means(df: DataFrame, col: str = "values") -> list[float]:
    """Element-wise mean of the array column (d values).  Rows whose array is null
    do not count; arrays of different lengths, or with a null inside, are an error."""
    return _means_and_count(df, col)[0]


def _means_and_count(df: DataFrame, col: str) -> tuple[list[float], int]:
    """In one pass: sums by position and the row count, with the lengths seen."""
    stats = df.where(F.col(col).isNotNull()).select(col).mapInArrow(_sums(col), "pos int, s double, n long")
    rows = stats.groupBy("pos").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).orderBy("pos").collect()  # d rows
    if any(r["n"] != rows[0]["n"] for r in rows):
        raise ValueError(f"the arrays in {col} differ in length")
    n = rows[0]["n"] if rows else 0
    return [r["s"] / n for r in rows], n


def _sums(col: str):
    def run(batches):
        for b in batches:
            if b.num_rows:
                x = as_matrix(b.column(col))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(x.shape[1]), pa.int32()), pa.array(x.sum(0)),
                     pa.array(np.full(x.shape[1], len(x)), pa.int64())], names=["pos", "s", "n"])
    return run


def center(df: DataFrame, mean: list[float], col: str = "values") -> DataFrame:
    mu = F.array(*[F.lit(float(m)) for m in mean])
    return df.withColumn(col, subtract(col, mu))


def _gram_batches(col: str):
    def run(batches):
        g, n = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            x = as_matrix(b.column(col))
            g = x.T @ x if g is None else g + x.T @ x
            n += len(x)
        if g is None:
            return
        ii, jj = np.indices(g.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ii.ravel(), pa.int32()), pa.array(jj.ravel(), pa.int32()),
             pa.array(g.ravel(), pa.float64()), pa.array(np.full(g.size, n), pa.int64())],
            names=["i", "j", "s", "n"])
    return run


def covariance(centred: DataFrame, col: str = "values") -> DataFrame:
    """(i, j, cov) with cov = sum((x - mu)_i (x - mu)_j) / n over centred rows; null
    rows do not count, ragged rows and nulls inside arrays are an error."""
    parts = centred.where(F.col(col).isNotNull()).select(col).mapInArrow(_gram_batches(col), _GRAM_SCHEMA)
    # each task reports its row count on every cell it emits
    return parts.groupBy("i", "j").agg((F.sum("s") / F.sum("n")).alias("cov"))


def _spread_batches(col: str, mean: np.ndarray, block: np.ndarray):
    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                x = as_matrix(b.column(col)) - mean
                y = x.T @ (x @ block)
                total = y if total is None else total + y
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "s"])
    return run


def spread(df: DataFrame, mean, n: int, block: np.ndarray, col: str = "values") -> np.ndarray:
    """Covariance times ``block`` (d x b) in one pass, X'(X block) / n of centred rows: a
    task holds and sends d x b sums, never the d x d covariance."""
    rows = df.where(F.col(col).isNotNull()).select(col)
    out = np.zeros(block.shape)
    for r in rows.mapInArrow(_spread_batches(col, np.array(mean), block), "i int, j int, s double").groupBy(
            "i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = r["s"] / n
    return out


def leading(df: DataFrame, k: int, col: str = "values", width: int = 16, tol: float = 1e-11, most: int = 100,
            seed: int = 11):
    """(mean, the ``k`` largest eigenvalues of the covariance, their unit vectors as
    columns, n) by blocked iteration over the rows.

    Each pass multiplies a block of ``width`` orthonormal directions by the covariance;
    directions already tried are kept, and Rayleigh-Ritz over all of them gives the
    components, until every residual is under ``tol`` of the largest eigenvalue.  The
    driver holds d x (passes * width) numbers; rows and cells of the covariance stay in
    the tasks.  With fewer dimensions than ``passes * width`` the result is exact.  The
    sign makes the entry of largest magnitude positive."""
    mean, n = _means_and_count(df, col)
    d = len(mean)
    k = min(k, d)
    rng = np.random.default_rng(seed)
    basis, image = np.zeros((d, 0)), np.zeros((d, 0))
    block = np.linalg.qr(rng.normal(size=(d, min(d, max(width, 1)))))[0] if d else basis
    for _ in range(most):
        basis = np.hstack([basis, block])
        image = np.hstack([image, spread(df, mean, n, block, col)])
        small = basis.T @ image
        vals, inner = np.linalg.eigh((small + small.T) / 2)
        vals, inner = vals[::-1][:k], inner[:, ::-1][:, :k]
        vecs = basis @ inner
        rest = image @ inner - vecs * vals
        if basis.shape[1] == d or (len(vals) == k and np.abs(rest).max(initial=0.0) <= tol * vals[0]):
            break
        # what the newest directions lead to beyond those known, orthonormal to all of them
        block = image[:, -block.shape[1]:]
        for _ in range(2):
            block = block - basis @ (basis.T @ block)
        u, size, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, size > 1e-10 * max(vals[0], 1e-300)][:, :d - basis.shape[1]]
        if not block.shape[1]:  # an invariant subspace: look beside it
            block = rng.normal(size=(d, min(width, d - basis.shape[1])))
        for _ in range(2):
            block = np.linalg.qr(block - basis @ (basis.T @ block))[0]
    for c in range(len(vals)):
        if vecs[np.argmax(np.abs(vecs[:, c])), c] < 0:
            vecs[:, c] = -vecs[:, c]
    return mean, vals, vecs, n


def total_variance(df: DataFrame, mean, col: str = "values") -> float:
    """The trace of the covariance: mean squared distance from ``mean``."""
    off = subtract(col, F.array(*[F.lit(float(m)) for m in mean]))
    return float(df.where(F.col(col).isNotNull()).agg(F.avg(dot(off, off))).first()[0] or 0.0)


def eigen(cov: DataFrame):
    """Eigenvalues (descending) and unit eigenvectors (columns), sign fixed so
    the largest-magnitude entry of each vector is positive."""
    rows = cov.collect()
    d = max(r["i"] for r in rows) + 1
    m = np.zeros((d, d))
    for r in rows:
        m[r["i"], r["j"]] = r["cov"]
    vals, vecs = np.linalg.eigh(m)
    order = np.argsort(vals)[::-1]
    vals, vecs = vals[order], vecs[:, order]
    for k in range(d):
        if vecs[np.argmax(np.abs(vecs[:, k])), k] < 0:
            vecs[:, k] = -vecs[:, k]
    return vals, vecs


def components_frame(spark, vals, vecs, k: int) -> DataFrame:
    rows = [(int(c), float(vals[c]), [float(x) for x in vecs[:, c]]) for c in range(k)]
    return spark.createDataFrame(rows, "component int, eigenvalue double, vector array<double>")


def scores(df: DataFrame, vectors, col: str = "values") -> DataFrame:
    """Uncentred scores x . v_k for each component vector."""
    return df.withColumn("scores", F.array(*[dot(col, F.array(*[F.lit(float(x)) for x in v]))
                                             for v in vectors]))


def variance_explained(vals, k: int, total: float | None = None) -> float:
    return float(np.sum(vals[:k]) / (np.sum(vals) if total is None else total))


def project_line(df: DataFrame, mean, v, col: str = "values") -> DataFrame:
    """mu + ((x - mu) . v) v — the point's projection on the first component."""
    mu = F.array(*[F.lit(float(m)) for m in mean])
    vv = F.array(*[F.lit(float(x)) for x in v])
    t = dot(subtract(col, mu), vv)
    return df.withColumn("projection", F.zip_with(mu, vv, lambda m, x: m + t * x))


def global_minmax(df: DataFrame, col: str = "values") -> DataFrame:
    return df.agg(F.min(F.array_min(col)).alias("min_value"), F.max(F.array_max(col)).alias("max_value"))


def fractional(df: DataFrame, col: str = "values") -> DataFrame:
    return df.withColumn(col, fractional_change(col))


def fold_phase(df: DataFrame, period: int, col: str = "values") -> DataFrame:
    return df.withColumn(col, fold_by_phase(col, period))


def fold_block(df: DataFrame, block: int, col: str = "values") -> DataFrame:
    return df.withColumn(col, fold_by_block(col, block))


def pca(df: DataFrame, k: int, col: str = "values"):
    """Full PCA: (mean, eigenvalues, eigenvectors, top-k component frame)."""
    mean = column_means(df, col)
    cov = covariance(center(df, mean, col), col)
    vals, vecs = eigen(cov)
    return mean, vals, vecs, components_frame(df.sparkSession, vals, vecs, k)
