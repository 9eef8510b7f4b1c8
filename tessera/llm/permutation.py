"""Nearest neighbours by largest inner product from a permutation index.

Vectors are lifted to unit length (the added component makes up for shorter
ones, so the nearest lifted vectors are those of largest inner product).  Each
is represented by its ``prefix`` nearest pivots in order, and posted, with its
place in that order, in the inverted file of each of them.  A query reads the
files of its own nearest pivots, ranks what is posted there by footrule
distance between the two orders, and reranks the best by the inner product.
Equal vectors are posted once, with the ids that can be in an answer.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import pin, shards_for
from .vectors import dimension, matrix, usable

FOUND = pa.schema([("query_id", pa.int64()), ("query_row", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])


def lift(x: np.ndarray, longest: float) -> np.ndarray:
    """Unit vectors with one more component; ``longest`` is the largest norm."""
    y = x / longest
    return np.column_stack([y, np.sqrt(np.clip(1 - (y * y).sum(1), 0, None))])


def nearest_pivots(unit: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each row, nearest first."""
    near = -(unit @ pivots.T)
    if prefix < near.shape[1]:
        top = np.argpartition(near, prefix - 1, axis=1)[:, :prefix]
    else:
        top = np.tile(np.arange(near.shape[1]), (len(near), 1))
    return np.take_along_axis(top, np.argsort(np.take_along_axis(near, top, 1), 1, kind="stable"), 1)


def apart(unit: np.ndarray, most: int, cosines: tuple[float, ...] = (0.5, 0.7, 0.9, 1 - 1e-9)) -> np.ndarray:
    """Up to ``most`` of the rows, the first ones that lie apart: those at the
    least cosine to the ones taken before, then those at the next, never equals."""
    taken, near = [], np.full(len(unit), -np.inf)
    for least in cosines:
        for i in range(len(unit)):
            if len(taken) == most:
                return unit[taken]
            if near[i] < least:
                taken.append(i)
                near = np.maximum(near, unit @ unit[i])
                near[i] = np.inf
    return unit[taken]


class InvertedFiles:
    """The posting lists of one shard: for each pivot, rows and their places."""

    def __init__(self, order: np.ndarray, pivots: int):
        self.rows_n, self.prefix = order.shape
        flat = order.ravel()
        by = np.argsort(flat, kind="stable")
        self.at = np.searchsorted(flat[by], np.arange(pivots + 1))
        self.rows, self.places = by // self.prefix, (by % self.prefix).astype(np.int32)

    def closeness(self, order: np.ndarray) -> np.ndarray:
        """Of every row to a query's order: the more, the smaller the footrule
        distance in which a pivot beyond the prefix counts as at its end."""
        out = np.zeros(self.rows_n, np.int32)
        m = self.prefix
        for place, pivot in enumerate(order.tolist()):
            a, b = self.at[pivot], self.at[pivot + 1]
            there = self.places[a:b]
            # both ends of |place - m| + |there - m| are saved, |place - there| is paid
            out[self.rows[a:b]] += (m - place) + (m - there) - np.abs(there - place)
        return out


def _search(pivots: np.ndarray, longest: float, dim: int, prefix: int, k: int, share: float, least: int):
    def search(index: pa.Table, queries: pa.Table) -> pa.Table:
        if not index.num_rows or not queries.num_rows:
            return FOUND.empty_table()
        x = matrix(index.column("vec"), dim).astype(np.float64)
        q = matrix(queries.column("q_vec"), dim).astype(np.float64)
        members = index.column("members").combine_chunks()
        ends = np.cumsum(pc.list_value_length(members).to_numpy())
        starts = np.concatenate([[0], ends[:-1]])
        ids, own = (members.flatten().field(c).to_numpy() for c in ("id", "row"))
        files = InvertedFiles(nearest_pivots(lift(x, longest), pivots, prefix), len(pivots))
        norm = np.linalg.norm(q, axis=1, keepdims=True)
        orders = nearest_pivots(np.column_stack([q / norm, np.zeros(len(q))]), pivots, prefix)
        take = min(len(x), max(math.ceil(share * len(x)), least) + 1)  # one more: the query itself
        qid, rid = queries.column("q_id").to_numpy(), queries.column("q_row").to_numpy()
        out: list[tuple] = []
        for i in range(len(q)):
            best = np.arange(len(x))
            if take < len(x):  # all that are as close as the last one
                close = files.closeness(orders[i])
                best = np.flatnonzero(close >= np.partition(close, len(x) - take)[len(x) - take])
            rough = x[best] @ q[i]
            if len(best) > k + 1:
                edge = np.partition(rough, len(best) - k - 1)[len(best) - k - 1]
                best = best[rough >= edge - 1e-9 * max(1.0, abs(edge))]
            score = (x[best] * q[i]).sum(1)  # the same order of additions for every row
            at = np.concatenate([np.arange(starts[b], ends[b]) for b in best])
            score = np.repeat(score, ends[best] - starts[best])[own[at] != rid[i]]
            at = at[own[at] != rid[i]]
            top = np.lexsort((ids[at], -score))[:k]
            out.append((np.full(len(top), qid[i]), np.full(len(top), rid[i]), ids[at[top]], score[top]))
        if not out:
            return FOUND.empty_table()
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=FOUND)

    return search


def permutation_search(df: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
                       pivots: int = 256, prefix: int = 64, share: float = 0.12, least: int = 1000,
                       shard_rows: int = 8192, query_block: int = 4096) -> DataFrame:
    """The ``k`` rows of ``df`` nearest to each row for which ``is_query`` (a
    column of ``df``) holds: query_id, rank, ``id_col``, score.

    The pivots are a bounded sample: of the 16 ``pivots`` different vectors with
    the smallest hash, ``pivots`` that lie apart.  All different vectors are
    indexed, in shards of about ``shard_rows``, each with the ``k`` + 1 smallest ids
    that bear it, as no answer holds more; every block of queries visits every
    shard, and there the better of ``share`` of its vectors and ``least`` vectors
    is reranked, with all that are as close as the last of them.  Rows are
    candidates of all queries but the one they are themselves (repeated rows are
    candidates of each other).  Ties go to the smaller id.  Vectors that are null, zero, of another
    length than most, or hold null or non-finite components take no part, nor do
    rows without an id; an empty table gives no rows.
    """
    spark = df.sparkSession
    dim = dimension(df, vec_col)
    rows = df.where(usable(F.col(vec_col)) & (F.size(vec_col) == dim) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"),
        F.coalesce(is_query, F.lit(False)).alias("query"), F.monotonically_increasing_id().alias("row"))
    rows = pin(rows, "vectors")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))
    n_q, longest = rows.agg(F.count_if("query"), F.max(norm)).first()
    if not n_q:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double").withColumnRenamed(
            "id", id_col)
    # the limit on a row number is taken before the shuffle too: a common vector is no large group
    each = Window.partitionBy("hash", "vec").orderBy("id", "row")
    members = rows.select("id", "row", "vec", F.xxhash64("vec").alias("hash")).withColumn(
        "place", F.row_number().over(each)).where(F.col("place") <= k + 1)
    vectors = pin(members.groupBy("hash", "vec").agg(
        F.array_sort(F.collect_list(F.struct("id", "row"))).alias("members")), "postings")
    n = vectors.count()
    sample = vectors.orderBy("hash", "vec").limit(16 * pivots).select("vec").toArrow()  # bounded
    piv = apart(lift(matrix(sample.column("vec"), dim).astype(np.float64), longest), pivots)
    prefix = min(prefix, len(piv))
    shards, blocks = shards_for(n, shard_rows), shards_for(n_q, query_block)
    shard, block = F.pmod("hash", F.lit(shards)), F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks))
    index = vectors.withColumn("shard", shard).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = rows.where("query").withColumn("block", block).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    # names of their own: both sides come from the same table
    asked = asked.select(F.col("shard").cast("long").alias("q_shard"), F.col("block").cast("int").alias("q_block"),
                         F.col("id").alias("q_id"), F.col("row").alias("q_row"), F.col("vec").alias("q_vec"))
    found = index.select("shard", F.col("block").cast("int").alias("block"), "vec", "members").groupBy(
        "shard", "block").cogroup(asked.groupBy("q_shard", "q_block")).applyInArrow(
        _search(piv, longest, dim, prefix, k, share, least),
        "query_id long, query_row long, id long, score double")
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), "id")
    out = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", F.col("id").alias(id_col), "score")
