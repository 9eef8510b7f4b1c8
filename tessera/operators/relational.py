"""Relational building blocks that are more than one DataFrame call."""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """Number of nulls in every column, in one pass."""
    cols = cols or df.columns
    return df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])


def any_null(df: DataFrame, cols=None) -> Column:
    cols = cols or df.columns
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def sum_all_numeric(df: DataFrame, key: str) -> DataFrame:
    """``groupBy(key).sum()``: sums every numeric column, the key included."""
    return df.groupBy(key).sum()


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """``orderBy(...).limit(k)`` — planned as TakeOrderedAndProject (no full sort)."""
    return df.orderBy(*order).limit(k)


def fraction(pred: Column) -> Column:
    """Share of rows for which ``pred`` holds."""
    return F.avg(pred.cast("double"))


def describe_rounded(df: DataFrame, cols, digits: int = 4) -> DataFrame:
    """``describe()`` (count, mean, sample stddev, min, max as strings), with
    the numeric text rounded so it compares across engines."""
    d = df.describe(*cols)
    return d.select("summary", *[F.round(F.col(c).cast("double"), digits).alias(c) for c in cols])


def split_by_key(df: DataFrame, key: str, weights) -> list[DataFrame]:
    """Reproducible split: rows go by ``pmod(key*7919+13, 100)`` into ranges
    proportional to ``weights`` (a deterministic stand-in for randomSplit)."""
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        lo = int(round(acc / total * 100))
        acc += w
        hi = int(round(acc / total * 100))
        bounds.append((lo, hi))
    b = F.pmod(F.col(key) * 7919 + 13, F.lit(100))
    return [df.where((b >= lo) & (b < hi)) for lo, hi in bounds]


def split_bucket(key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(k * 7919 + 13, F.lit(100))


def sample_fixed_n(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """A random sample of exactly ``min(n, count)`` rows (top-n by a seeded random key)."""
    return df.withColumn("_r", F.rand(seed)).orderBy("_r").limit(n).drop("_r")


def width_bins(x: Column, width: float) -> Column:
    """Integer bin ``floor(x / width)``."""
    return F.floor(x / F.lit(width)).cast("long")


def _group_codes(batch: pa.RecordBatch, keys: int) -> tuple[np.ndarray, np.ndarray]:
    """(group of each row, a row of each group) by the first ``keys`` columns."""
    code = np.zeros(batch.num_rows, np.int64)
    for k in range(keys):
        c = batch.column(k).dictionary_encode(null_encoding="encode")
        code = code * max(1, len(c.dictionary)) + c.indices.to_numpy(zero_copy_only=False)
        _, code = np.unique(code, return_inverse=True)
    _, first, code = np.unique(code, return_index=True, return_inverse=True)
    return code, first


def _vector_sums(keys: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            code, first = _group_codes(b, keys)
            col = b.column(keys)
            size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            width = int(size.max())
            flat = col.flatten()
            pos = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            cell = np.repeat(code, size) * width + pos
            there = flat.is_valid().to_numpy(zero_copy_only=False)
            x = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(np.float64)
            n = np.bincount(cell[there], minlength=len(first) * width)
            s = np.bincount(cell[there], weights=x[there], minlength=len(first) * width)
            at = np.nonzero(n)[0]
            of = pa.array(first[at // width]) if len(at) else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k).take(of) for k in range(keys)), pa.array(at % max(1, width), pa.int32()),
                 pa.array(s[at]), pa.array(n[at])], names)

    return run


def element_sums(df: DataFrame, col: str, *keys: str) -> DataFrame:
    """(keys, pos, total, n): the sum and number of the values at each position of the
    array column, by group.

    A mergeable vector accumulator: every Arrow batch adds its vectors up by group, so
    a batch sends one row a group and position, not one a value, and the partial sums
    are merged by an ordinary aggregate.  Null keys are a group; null arrays and null
    values do not count; arrays may differ in length."""
    src = df.select(*keys, F.col(col).cast("array<double>").alias(col))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
    names = [*keys, "pos", "s", "n"]
    parts = src.mapInArrow(_vector_sums(len(keys), names), ", ".join([*kept, "pos int, s double, n long"]))
    return parts.groupBy(*keys, "pos").agg(F.sum("s").alias("total"), F.sum("n").alias("n"))
