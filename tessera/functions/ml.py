"""Model-evaluation expressions."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# Log-loss epsilon and the raw-score clamp of the sigmoid.
LOG_LOSS_EPSILON = 1e-16
RAW_CLAMP = 20.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sigmoid_clamped(raw) -> Column:
    r = F.least(F.greatest(_c(raw), F.lit(-RAW_CLAMP)), F.lit(RAW_CLAMP))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-r))


def log_loss(p, label, eps: float = LOG_LOSS_EPSILON) -> Column:
    p, label = _c(p), _c(label)
    return F.when(label == 1, -F.ln(p + F.lit(eps))).otherwise(-F.ln(F.lit(1.0) - p + F.lit(eps)))


def squared_error(label, prediction) -> Column:
    d = _c(label) - _c(prediction)
    return d * d
