"""Whitening of embeddings by FEAST contour integration.

Spark sums up the covariance of the different integer vectors; its largest
eigenpairs come from the resolvent.  Inertia counts (negative pivots of the shifted
covariance, from its tridiagonal form) cut the spectrum into short intervals with
known numbers of eigenvalues.  For each interval, Gauss-Legendre quadrature of
complex shifted solves along a half circle through its ends,

    Q = Re sum_k w_k (z_k I - V)^-1 Y,

projects a block Y on the interval's eigenvectors, and Rayleigh-Ritz extracts them;
that is repeated until residuals vanish and the Ritz values in the interval are as
many as the inertia counts say, so none is missed.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pin
from .vectors import matrix

NODES = 8


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(diagonal, beside it) of the tridiagonal matrix that reflections make of ``v``."""
    a = v.copy()
    n = len(a)
    beside = np.zeros(max(0, n - 1))
    for k in range(n - 1):
        x = a[k + 1:, k].copy()
        beside[k] = -np.copysign(np.linalg.norm(x), x[0])
        x[0] -= beside[k]
        size = x @ x
        if size == 0:
            continue
        rest = a[k + 1:, k + 1:]
        p = rest @ x * (2 / size)
        q = p - x * (x @ p / size)
        rest -= np.outer(x, q) + np.outer(q, x)
    return np.diag(a).copy(), beside


def count_above(tri: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """How many eigenvalues exceed ``shift``: the positive pivots of V - shift I."""
    diagonal, beside = tri
    tiny = np.finfo(float).tiny ** 0.5
    pivot, above = diagonal[0] - shift, 0
    for k in range(len(diagonal)):
        if k:
            pivot = diagonal[k] - shift - beside[k - 1] ** 2 / pivot
        if abs(pivot) < tiny:
            pivot = -tiny
        above += pivot > 0
    return above


def clear_shift(tri, lo: float, hi: float, margin: float) -> float:
    """A shift between ``lo`` and ``hi``, near their middle, with no eigenvalue within ``margin``."""
    for k in range(1, 4 * len(tri[0]) + 4):
        at = lo + (hi - lo) * (0.5 + 0.45 * (-1) ** k * (k // 2) / (2 * len(tri[0]) + 2))
        if count_above(tri, at - margin) == count_above(tri, at + margin):
            return at
    raise ArithmeticError("no gap between the eigenvalues of this interval")


def intervals(tri, top: int, ceiling: float, most: int = 12) -> list[tuple[float, float, int]]:
    """(lo, hi, eigenvalues inside) of pieces of the spectrum, highest first, that hold
    the ``top`` largest eigenvalues and some more; ``most`` a piece, or a cluster."""
    margin = 1e-11 * ceiling
    hi = ceiling * (1 + 1e-6)
    lo = low = -1e-3 * ceiling
    while hi - lo > 1e-3 * ceiling:  # the highest shift with enough eigenvalues above it
        mid = clear_shift(tri, lo, hi, margin)
        if count_above(tri, mid) >= top:
            lo = mid
        else:
            hi = mid
    if lo != low:
        low = lo
    out, todo = [], [(low, ceiling * (1 + 1e-6))]
    while todo:
        a, b = todo.pop()
        inside = count_above(tri, a) - count_above(tri, b)
        if inside > most and b - a > 1e-6 * ceiling:
            mid = clear_shift(tri, a, b, margin)
            todo += [(a, mid), (mid, b)]
        elif inside:
            out.append((a, b, inside))
    return out


def contour(v: np.ndarray, lo: float, hi: float, block: np.ndarray) -> np.ndarray:
    """The quadrature: ``block`` projected on the eigenvectors between ``lo`` and ``hi``."""
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    middle, radius, eye = (lo + hi) / 2, (hi - lo) / 2, np.eye(len(v))
    out = np.zeros_like(block)
    for x, w in zip(nodes, weights):
        turn = np.exp(1j * np.pi * (1 + x) / 2)
        out += (w * radius / 2 * turn * np.linalg.solve((middle + radius * turn) * eye - v, block)).real
    return out


def interval_pairs(v: np.ndarray, lo: float, hi: float, inside: int, rng, most: int = 60):
    """The ``inside`` eigenpairs of ``v`` between ``lo`` and ``hi``, values falling."""
    n, scale = len(v), np.abs(v).sum(1).max()
    size = min(n, 2 * inside + 8)
    block = rng.normal(size=(n, size))
    for _ in range(most):
        q, _ = np.linalg.qr(contour(v, lo, hi, block))
        values, inner = np.linalg.eigh(q.T @ v @ q)  # Rayleigh-Ritz
        block = q @ inner
        here = np.nonzero((values > lo) & (values <= hi))[0]
        vectors = block[:, here]
        if len(here) == inside and np.abs(v @ vectors - vectors * values[here]).max() <= 1e-13 * scale * n ** 0.5:
            return values[here][::-1], vectors[:, ::-1]
    raise ArithmeticError(f"{len(here)} of {inside} eigenvalues found between {lo} and {hi}")


def top_pairs(v: np.ndarray, top: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` largest eigenvalues of the symmetric, positive semidefinite ``v``,
    falling, and their unit eigenvectors as columns.  Those that cannot be told from
    zero are left out."""
    ceiling = float(np.abs(v).sum(1).max()) if len(v) else 0.0
    if not ceiling:
        return np.zeros(0), np.zeros((len(v), 0))
    tri, rng = tridiagonal(v), np.random.default_rng(seed)
    least = 1e-12 * ceiling * len(v)
    top = min(top, count_above(tri, least))
    found = [interval_pairs(v, *piece, rng) for piece in intervals(tri, top, ceiling)]
    q, _ = np.linalg.qr(np.concatenate([f[1] for f in found], axis=1))  # and once across the intervals
    values, inner = np.linalg.eigh(q.T @ v @ q)
    return values[::-1][:top], (q @ inner)[:, ::-1][:, :top]


class Fit(NamedTuple):
    """n different vectors with sums per dimension; eigenvalues, components (columns)
    and the trace of their covariance; the identity error of what they whiten."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float


def integer_vectors(df: DataFrame, vec_col: str, grid: int, shift: int, *keep: str) -> DataFrame:
    """(keep, x) of the rows whose vector has the dimension most have, and no null or
    non-finite entry: x = floor(grid * entry) + shift as longs."""
    vec = F.col(vec_col)
    sound = F.coalesce(F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    good = df.where(sound & (F.size(vec) > 0))
    common = good.groupBy(F.size(vec).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    x = F.transform(vec, lambda c: F.floor(grid * c.cast("double")) + F.lit(shift).cast("long"))
    return good.where(F.size(vec) == (common["d"] if common else 0)).select(*keep, x.alias("x"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            s = matrix(b.column(0), len(b.column(0)[0])).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(s))), pa.array(s),
                                              pa.array(np.full(len(s), b.num_rows))], ["pos", "s", "n"])


def _products(mean: np.ndarray, turn: np.ndarray | None):
    """Sums of products of the centred vectors (``turn``: and projected on its columns),
    added up in the task, as rows of the upper triangle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                y = matrix(b.column(0).slice(at, 4096), len(mean)) - mean
                y = y if turn is None else y @ turn
                total = total + y.T @ y
        if isinstance(total, int):
            return
        for i, row in enumerate(total):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(row) - i, i)), pa.array(np.arange(i, len(row))), pa.array(row[i:])], ["i", "j", "s"])

    return run


def _summed(fit: DataFrame, n: int, mean: np.ndarray, turn: np.ndarray | None = None) -> np.ndarray:
    d = len(mean) if turn is None else turn.shape[1]
    out = np.zeros((d, d))
    cells = fit.mapInArrow(_products(mean, turn), "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    for r in cells.toLocalIterator():  # d * (d + 1) / 2 sums
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"] / n
    return out


def fit_whitening(vectors: DataFrame, k: int = 16, most_dimensions: int = 4096) -> Fit:
    """Fit on each different vector of ``x`` (a column of longs) once.

    The driver holds the d x d covariance, so d is at most ``most_dimensions``.  Sums
    are exact longs; products are of centred doubles.
    """
    fit = pin(vectors.select("x").distinct(), "fit")
    sums = fit.mapInArrow(_sums, "pos long, s long, n long").groupBy("pos").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n")).orderBy("pos").collect()  # d rows
    if not sums:
        return Fit(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    if len(sums) > most_dimensions:
        raise ValueError(f"{len(sums)} dimensions of {most_dimensions} at most")
    n, s = sums[0]["n"], [r["s"] for r in sums]
    mean = np.array([x / n for x in s])
    v = _summed(fit, n, mean)
    values, components = top_pairs(v, k)
    white = _summed(fit, n, mean, components / np.sqrt(values)) if len(values) else np.zeros((0, 0))
    error = float(np.abs(white - np.eye(len(values))).max()) if len(values) else 0.0
    return Fit(n, s, values, components, float(np.trace(v)), error)


def _whiten(n: int, sums: list[int], turn: np.ndarray, ids: int):
    mean = np.array([x / n for x in sums])
    whole = np.array(sums, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                x = matrix(part.column(ids), len(sums))
                y = x - mean
                if (float(n) * y).__pow__(2).sum(1).max() < 2.0 ** 62:
                    dev = (n * x - np.array(sums)).__pow__(2).sum(1)
                else:  # Python integers; a sum beyond a long is an error
                    dev = [int(sum(((n * r - whole) ** 2).tolist())) for r in x.astype(object)]
                white = y @ turn
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in range(ids)), pa.array(dev, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * turn.shape[1], pa.int32()),
                                              pa.array(white.ravel()))],
                    [*part.schema.names[:ids], "deviation", "whitened"])

    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 16, grid: int = 64,
           shift: int = 1_000_000) -> DataFrame:
    """One row per row of ``df`` and component: id, component (from 1, by falling
    eigenvalue), n (different vectors), deviation (sum over dimensions of
    (n x - S) ** 2, exact), whitened (x - S / n on the component, over the root of its
    eigenvalue), explained (eigenvalue over trace) and identity_error (of the
    covariance of whitened over the fit).

    Vectors become x = floor(``grid`` * entry) + ``shift``.  Rows whose vector is null,
    empty, of another length than most, or holds a null or non-finite entry are left
    out.  Repeated rows each give their rows but count once in the fit; null ids stay.
    Components are up to ``k``, and only those whose eigenvalue can be told from zero:
    none, hence no rows, for an empty table or equal vectors.  Other columns are not
    read, so their names cannot clash.  A deviation beyond a long is an error.
    """
    rows = integer_vectors(df, vec_col, grid, shift, F.col(id_col).alias("id"))
    f = fit_whitening(rows, k)
    out = "id long, deviation long, whitened array<double>".replace("long", dict(rows.dtypes)["id"], 1)
    if not len(f.values):
        white = rows.select("id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    else:
        white = rows.mapInArrow(_whiten(f.n, f.sums, f.components / np.sqrt(f.values), 1), out)
    explained = F.array(*[F.lit(float(e / f.trace)) for e in f.values]).cast("array<double>")
    each = white.select("id", "deviation", F.posexplode("whitened").alias("pos", "whitened"))
    return each.select(
        F.col("id").alias(id_col), (F.col("pos") + 1).alias("component"), F.lit(f.n).cast("long").alias("n"),
        "deviation", "whitened", F.element_at(explained, F.col("pos") + 1).alias("explained"),
        F.lit(f.identity_error).alias("identity_error"))
