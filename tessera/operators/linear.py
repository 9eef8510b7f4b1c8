"""Linear regression from first principles on ``array<double>`` features.

Gradient descent reads the rows once: its gradients follow from the products of
features and label, which packed blocks of rows add up.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml import Pipeline
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from ..functions.arrays import as_matrix, dot, outer_flat
from .regression import rmse_r2

FEATURES = ("l_quantity", "l_discount", "l_tax")


def scaled_points(power: DataFrame, cols=FEATURES) -> DataFrame:
    """(key, label, features): every feature min-max scaled to [0, 1]."""
    b = power.agg(*[F.min(c).alias(f"lo_{c}") for c in cols],
                  *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    feats = []
    for c in cols:
        lo, hi = b[f"lo_{c}"], b[f"hi_{c}"]
        span = (hi - lo) if hi != lo else 1.0
        feats.append((F.col(c) - F.lit(lo)) / F.lit(span))
    return power.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("key"),
                        F.col("label").cast("double").alias("label"),
                        F.array(*feats).alias("features"))


def label_range(points: DataFrame) -> DataFrame:
    return points.agg(F.min("label").alias("min_label"), F.max("label").alias("max_label"))


def shift_label(points: DataFrame) -> DataFrame:
    lo = points.agg(F.min("label")).first()[0]
    return points.withColumn("label", F.col("label") - F.lit(lo))


def baseline_rmse(train: DataFrame, *evals: DataFrame) -> list[float]:
    """RMSE of predicting the training mean label on each frame."""
    mu = train.agg(F.avg("label")).first()[0]
    out = []
    for e in (train, *evals):
        d = F.col("label") - F.lit(mu)
        out.append(e.agg(F.sqrt(F.avg(d * d))).first()[0])
    return out


def _w(weights) -> F.Column:
    return F.array(*[F.lit(float(x)) for x in weights])


def predict(points: DataFrame, weights) -> DataFrame:
    return points.withColumn("prediction", dot("features", _w(weights)))


def gradient_summand(points: DataFrame, weights) -> DataFrame:
    """(w . x - y) * x per row."""
    err = dot("features", _w(weights)) - F.col("label")
    return points.withColumn("summand", F.transform("features", lambda x: x * err))


def packed_gram(points: DataFrame) -> np.ndarray:
    """X'X over rows (features, label), from packed blocks: every Arrow batch becomes one
    matrix, each task adds up one product a batch, and only d + 1 squared sums a task are
    shuffled.  Rows with null features or label do not count; ragged ones are an error."""
    def run(batches):
        total = None
        for b in batches:
            if not b.num_rows:
                continue
            x = np.column_stack([as_matrix(b.column(0)), b.column(1).to_numpy(zero_copy_only=False)])
            total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())],
                                             ["i", "j", "s"])

    rows = points.select("features", F.col("label").cast("double").alias("label")).dropna()
    cells = rows.mapInArrow(run, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    d = 1 + max((r["i"] for r in cells), default=-1)
    out = np.zeros((d, d))
    for r in cells:
        out[r["i"], r["j"]] = r["s"]
    return out


def gradient_descent(train: DataFrame, iters: int, alpha: float = 1.0):
    """Full-batch descent from w = 0 with step alpha / (n * sqrt(i + 1)).

    Returns (weights, [rmse before each update], [weights after each update]).  The
    gradient of the squared error, X'Xw - X'y, and the error itself depend on the rows
    through the products of (x, y) only, so the rows are read once, however many steps
    are made."""
    ones = train.withColumn("features", F.concat(F.array(F.lit(1.0)), "features"))
    gram = packed_gram(ones)
    if not len(gram):
        return [], [], []
    n, g, c, yy = gram[0, 0], gram[1:-1, 1:-1], gram[1:-1, -1], gram[-1, -1]
    w = np.zeros(len(c))
    errors, history = [], []
    for i in range(iters):
        errors.append(math.sqrt(max(0.0, w @ g @ w - 2 * (w @ c) + yy) / n))
        w = w - alpha / (n * math.sqrt(i + 1)) * (g @ w - c)
        history.append(w.tolist())
    return w.tolist(), errors, history


def two_way(points: DataFrame) -> DataFrame:
    """Append all d*d products x_i * x_j (x*y and y*x both kept)."""
    return points.withColumn("features", F.concat("features", outer_flat("features")))


def as_vectors(points: DataFrame) -> DataFrame:
    return points.withColumn("fv", array_to_vector("features"))


def elastic_fit(train: DataFrame, reg: float = 0.1, elastic: float = 0.2, iters: int = 500, tol: float = 1e-6):
    lr = LinearRegression(featuresCol="fv", labelCol="label", maxIter=iters, regParam=reg,
                          elasticNetParam=elastic, fitIntercept=True, tol=tol)
    return lr.fit(as_vectors(train))


def evaluate(model, points: DataFrame) -> DataFrame:
    return rmse_r2(model.transform(as_vectors(points)))


def grid_search(train: DataFrame, val: DataFrame, regs=(1e-10, 1e-5, 1.0), elastic: float = 0.2,
                iters: int = 500):
    """Fit each regParam; keep the lowest validation RMSE.  Returns (rows, best model)."""
    rows, best = [], None
    for r in regs:
        m = elastic_fit(train, r, elastic, iters)
        e = evaluate(m, val).first()["rmse"]
        rows.append((float(r), float(e)))
        if best is None or e < best[1]:
            best = (m, e)
    return rows, best[0]


def poly_pipeline(degree: int = 2, reg: float = 1e-10, elastic: float = 0.2, iters: int = 500,
                  tol: float = 1e-6) -> Pipeline:
    """Degree-2 expansion (d(d+3)/2 features: no duplicate x*y/y*x) + regression."""
    pe = PolynomialExpansion(degree=degree, inputCol="fv", outputCol="poly")
    lr = LinearRegression(featuresCol="poly", labelCol="label", maxIter=iters, regParam=reg,
                          elasticNetParam=elastic, tol=tol)
    return Pipeline(stages=[pe, lr])
