"""Which rows of a vector column take part, and their dimension."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def usable(vec):
    """Column: the vector is there, not zero, and all components are finite."""
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(ok & F.exists(vec, lambda x: x != 0), F.lit(False))


def dimension(df: DataFrame, vec_col: str) -> int:
    """The length that most usable vectors have (ties: the larger); 0 without any."""
    top = df.where(usable(F.col(vec_col))).groupBy(F.size(vec_col).alias("d")).count().orderBy(
        F.desc("count"), F.desc("d")).first()
    return top["d"] if top else 0


def matrix(col: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a list column whose lists all have ``dim`` values."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
