"""Dense-vector arithmetic on ``array<double>`` columns with higher-order functions."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return total(F.zip_with(_c(a), _c(b), lambda x, y: x * y))


def norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0).cast("double"), lambda acc, x: acc + x * x))


def scale(a, s) -> Column:
    s = s if isinstance(s, Column) else F.lit(s)
    return F.transform(_c(a), lambda x: x * s)


def multiply(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x * y)


def subtract(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x - y)


def add(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def to_double(a) -> Column:
    return F.transform(_c(a), lambda x: x.cast("double"))


def mean(a) -> Column:
    return total(a) / F.size(_c(a))


def pop_stddev(a) -> Column:
    """Population standard deviation of the elements of each array."""
    m = mean(a)
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0).cast("double"),
                              lambda acc, x: acc + (x - m) * (x - m)) / F.size(_c(a)))


def fractional_change(a) -> Column:
    """(x - mean) / mean for every element."""
    m = mean(a)
    return F.transform(_c(a), lambda x: (x - m) / m)


def fold_by_phase(a, period: int) -> Column:
    """Sum elements sharing the same index modulo ``period`` (result has ``period`` entries)."""
    arr = _c(a)
    return F.transform(F.sequence(F.lit(0), F.lit(period - 1)),
                       lambda i: F.aggregate(F.filter(arr, lambda x, j: j % period == i),
                                             F.lit(0.0).cast("double"), lambda acc, x: acc + x))


def fold_by_block(a, block: int) -> Column:
    """Sum consecutive blocks of ``block`` elements (result has size/block entries)."""
    arr = _c(a)
    nblocks = (F.size(arr) / block).cast("int")
    return F.transform(F.sequence(F.lit(0), nblocks - 1),
                       lambda k: F.aggregate(F.slice(arr, k * block + 1, block),
                                             F.lit(0.0).cast("double"), lambda acc, x: acc + x))


def outer_flat(a) -> Column:
    """All d*d pairwise products x_i * x_j, row-major (i outer, j inner)."""
    arr = _c(a)
    return F.flatten(F.transform(arr, lambda x: F.transform(arr, lambda y: x * y)))


def as_matrix(arr: pa.Array) -> np.ndarray:
    """The rows of an Arrow list column as one matrix of doubles."""
    lengths = pc.list_value_length(arr).to_numpy(zero_copy_only=False)
    if (lengths != lengths[0]).any():
        raise ValueError(f"arrays of {lengths.min()} to {lengths.max()} values in one column")
    flat = arr.flatten()
    if flat.null_count:
        raise ValueError(f"{flat.null_count} null values inside arrays")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(arr), int(lengths[0]))
