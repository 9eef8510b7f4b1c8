"""Broadcast only behind a size check.

``broadcast_if_small`` is for rows that are scanned, filtered and projected: below a
generator, a join or an aggregate no hint is given (AQE may switch at run time from
real sizes).  The optimizer's estimate is the size of the compressed files there, of
which rows in memory are many times, so rows are counted, as ``broadcast_pinned`` does
for a table that was written already.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F, types as T

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if it measures at most ``max_bytes``, as ``broadcast_pinned`` has it;
    else a hint to shuffle, for Spark too would broadcast it by the size of its files."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if re.search(r"\b(Generate|Join|Aggregate|Window|Expand|Union)\b", plan):
        return df
    known = broadcast_pinned(df, max_bytes)
    return df.hint("merge") if known is df else known


def broadcast_pinned(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if what is written measures at most ``max_bytes``: 16 bytes a
    value and the lengths of strings."""
    width = F.lit(16 * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
    size = df.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df
