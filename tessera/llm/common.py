"""Helpers shared by the operators of this package."""
from __future__ import annotations

import ctypes
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, what: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def pin(df: DataFrame, what: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    Cuts the lineage, survives lost executors and keeps column pruning.
    """
    path = shared_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` bears."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def connected_components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node reachable.

    Large-star / small-star contraction: every round links each node's larger
    neighbours, then its smaller ones, to the smallest node it sees.  Mins are
    pre-aggregated, joins are plain shuffle joins (AQE splits the hot node of a
    star), each round is written to the shared folder, and only a count and a
    checksum come to the driver.
    """
    def stars(e: DataFrame, large: bool) -> DataFrame:
        e = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        low = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        if large:
            e = e.where("v > u").join(low, "u").select("v", "m")
            return e.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        e = e.join(low, "u")
        e = e.select(F.col("v").alias("u"), F.col("m").alias("v")).union(e.select("u", F.col("m").alias("v")))
        return e.where("u <> v").distinct()

    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    # every edge points from the larger node to the smaller one
    e = pin(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct(), "edges")
    seen, before = mark(e), None
    while seen != before and seen[0]:
        e = pin(stars(stars(e, True), False), "edges")
        before, seen = seen, mark(e)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v"), F.col("v")).distinct())


def runs(batches: Iterator[pa.RecordBatch], key: str, least: int = 1 << 16) -> Iterator[pa.Table]:
    """Regroup batches of a partition sorted by ``key`` into tables that never
    cut a run of equal keys, each of about ``least`` rows or one run."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n < least:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        k = t.column(key).to_numpy()
        cut = int(np.searchsorted(k, k[-1], side="left"))
        if cut:
            yield t.slice(0, cut)
            t = t.slice(cut)
        held, n = t.to_batches(), t.num_rows
        least = max(least, 2 * n if not cut else least)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def pairs_in_runs(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, i + d) inside each run of the sorted ``keys``, by distance d."""
    i = np.arange(len(keys))
    d = 1
    while True:
        i = i[i < len(keys) - d]
        i = i[keys[i] == keys[i + d]]
        if not len(i):
            return
        yield i, i + d
        d += 1


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links a-b, the smallest index each node reaches."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def shards_for(rows: int, per_shard: int) -> int:
    return max(1, math.ceil(rows / per_shard))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches hold ``rows`` rows unless the session says something of its own:
    whole texts are long, and a batch is held by the JVM and by Python at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":  # Spark's own default
        spark.conf.set(key, str(rows))


def release() -> None:
    """Give memory that a batch or partition used back to the system: workers live on
    through later stages, beside the JVM of their executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)
