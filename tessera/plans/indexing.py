"""Global row numbers and running sums without a single-partition window.

Both work the way ``zipWithIndex`` does: range-sort the rows, pin the
partitioning with a checkpoint, count each partition (one small row per
partition), turn the counts into offsets, and add each row's position inside
its own partition.  Only the per-partition table (bounded by the partition
count, not the data) is broadcast.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .lineage import cut_lineage


def _pinned(df: DataFrame, order_cols) -> DataFrame:
    ordered = df.orderBy(*order_cols)
    staged = ordered.withColumn("_pid", F.spark_partition_id()) \
                    .withColumn("_mid", F.monotonically_increasing_id())
    return cut_lineage(staged)


def dense_index(df: DataFrame, order_cols, name: str = "index") -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order_cols`` order."""
    pinned = _pinned(df, order_cols)
    per_part = pinned.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"),
                                          F.min("_mid").alias("_first"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = pinned.join(F.broadcast(offsets.select("_pid", "_off", "_first")), "_pid")
    return out.withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("long")) \
              .drop("_pid", "_mid", "_off", "_first")


def running_sums(df: DataFrame, order_cols, value_cols, suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``value_cols`` in ``order_cols`` order."""
    pinned = _pinned(df, order_cols)
    local_w = Window.partitionBy("_pid").orderBy("_mid") \
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = pinned.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in value_cols])
    prev = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(prev), F.lit(0)).alias(f"_o_{c}")
                                      for c in value_cols])
    out = pinned
    for c in value_cols:
        out = out.withColumn(f"{c}{suffix}", F.sum(c).over(local_w))
    out = out.join(F.broadcast(offsets), "_pid")
    for c in value_cols:
        out = out.withColumn(f"{c}{suffix}", F.col(f"{c}{suffix}") + F.col(f"_o_{c}"))
    return out.drop("_pid", "_mid", *[f"_o_{c}" for c in value_cols])
