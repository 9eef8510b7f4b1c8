"""Embedding near-duplicates by E8 lattice hashing.

Each table projects unit vectors to eight random orthogonal directions, scaled
and shifted, and decodes the projection to the nearest point of the E8 lattice,
the vector's home cell.  A vector is also posted in the neighbouring cells (home
plus a shortest lattice vector) nearest to its projection.  Vectors meet in a
cell that is home to at least one of them; every meeting is verified by cosine.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import connected_components, forest, pin, runs
from .vectors import dimension, matrix, usable

#: The 240 shortest vectors: permutations of (+-1, +-1, 0 x 6), and (+-1/2 x 8) with evenly many minus signs.
ROOTS = np.array([[s if k == i else t if k == j else 0 for k in range(8)] for i, j in combinations(range(8), 2)
                  for s, t in product((1, -1), repeat=2)]
                 + [v for v in product((.5, -.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0])


def decode(y: np.ndarray) -> np.ndarray:
    """The E8 point nearest to each row: the better one of the nearest points
    of D8 (integers with an even sum) and of D8 shifted by one half."""
    def d8(x):
        r = np.rint(x)
        d = x - r
        odd = np.nonzero(r.sum(1) % 2)[0]
        worst = np.abs(d[odd]).argmax(1)
        r[odd, worst] += np.where(d[odd, worst] >= 0, 1, -1)
        return r

    a, b = d8(y), d8(y - .5) + .5
    return np.where((((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1))[:, None], a, b)


def directions(dim: int, tables: int, scale: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    g = rng.normal(size=(tables, dim, 8))
    g = np.linalg.qr(g)[0] if dim >= 8 else g / np.linalg.norm(g, axis=1, keepdims=True)
    return g * scale * np.sqrt(dim), rng.uniform(0, 1, (tables, 8))


def cells(unit: np.ndarray, g: np.ndarray, shift: np.ndarray, probes: int) -> np.ndarray:
    """(rows, tables, 1 + probes) 32-bit cell numbers, home first."""
    mix = np.random.default_rng(8).integers(1, 1 << 62, 8, dtype=np.uint64) | np.uint64(1)
    out = np.empty((len(unit), len(g), 1 + probes), np.int64)
    for t in range(len(g)):
        y = unit @ g[t] + shift[t]
        home = decode(y)
        at = np.argpartition((home - y) @ ROOTS.T, probes, axis=1)[:, :probes]
        points = np.concatenate([home[:, None], home[:, None] + ROOTS[at]], 1)
        h = (np.rint(2 * points).astype(np.int64).view(np.uint64) * mix).sum(2, dtype=np.uint64)
        h = (h ^ (h >> np.uint64(29))) * mix[0]
        out[:, t] = (h >> np.uint64(32)).astype(np.int64)
    return out


def _post(dim: int, tables: int, probes: int, scale: float, seed: int, payload: bool):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, shift = directions(dim, tables, scale, seed)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                x = matrix(b.column("vec"), dim).astype(np.float64)
                c = cells(x / np.linalg.norm(x, axis=1)[:, None], g, shift, probes)
                key = (np.arange(tables)[:, None] << 32 | c).reshape(len(x), -1)
                n = key.shape[1]
                cols = [pa.array(key.ravel()), pa.array(np.tile(np.arange(n) % (1 + probes) == 0, len(x)))]
                names = ["key", "home"]
                if payload:
                    take = pa.array(np.repeat(np.arange(len(x)), n))
                    small = c.reshape(len(x), -1).astype(np.uint32).view(np.uint8).reshape(len(x), -1)
                    own = pa.array([r.tobytes() for r in small], pa.binary())
                    cols += [b.column("cid").take(take), b.column("copies").take(take), b.column("vec").take(take),
                             own.take(take)]
                    names += ["cid", "copies", "vec", "cells"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return post


def _verify(dim: int, tables: int, probes: int, least: float, block: int = 1024):
    """Links first met in the cell at hand: (cid, links, root) with the smallest
    cid that the links of a group of cells lead to."""
    def pairs(key, cid, x, own, lead, other):
        """Index pairs of one cell: ``lead`` rows call it home, ``other`` rows are posted in it."""
        table, cell = key >> 32, np.uint32(key & 0xFFFFFFFF)
        norm = np.linalg.norm(x, axis=1)
        unit = (x / norm[:, None]).astype(np.float32)
        for p in range(0, len(lead), block):
            a_rows = lead[p:p + block]
            for q in range(0, len(other), block):
                b_rows = other[q:q + block]
                i, j = np.nonzero(unit[a_rows] @ unit[b_rows].T >= least - 1e-4)
                a, b = a_rows[i], b_rows[j]
                ok = cid[a] != cid[b]
                a, b = a[ok], b[ok]
                for s in range(0, len(a), 65536):
                    i, j = a[s:s + 65536], b[s:s + 65536]
                    ok = (x[i] * x[j]).sum(1) / (norm[i] * norm[j]) >= least
                    i, j = i[ok], j[ok]
                    # the pair belongs to the first table where it meets ...
                    meet = ((own[i, :table, :1] == own[j, :table]).any(2)
                            | (own[j, :table, :1] == own[i, :table]).any(2)).any(1)
                    # ... and there to the home of the smaller cid, if the other one is posted in it
                    swap = cid[i] > cid[j]
                    lo, hi = np.where(swap, j, i), np.where(swap, i, j)
                    there = (own[lo, table, :1] == own[hi, table]).any(1)
                    mine = np.where(there, own[lo, table, 0] == cell, True) & ~meet
                    # both call it home: the pair comes up twice
                    both = (own[i, table, 0] == cell) & (own[j, table, 0] == cell)
                    mine &= ~(both & swap)
                    yield i[mine], j[mine]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, "run", 1 << 13):
            key, part, cid = (t.column(c).to_numpy() for c in ("key", "part", "cid"))
            copies, lead, other = (t.column(c).to_numpy() for c in ("copies", "lead", "other"))
            x = matrix(t.column("vec"), dim).astype(np.float64)
            own = np.frombuffer(b"".join(t.column("cells").to_pylist()), np.uint32).reshape(len(x), tables, 1 + probes)
            order = np.lexsort((part, key))
            edge = np.nonzero((np.diff(key[order]) != 0) | (np.diff(part[order]) != 0))[0] + 1
            a, b = [], []
            for run in np.split(order, edge):
                if len(run) > 1:
                    for i, j in pairs(int(key[run[0]]), cid[run], x[run], own[run],
                                      np.nonzero(lead[run])[0], np.nonzero(other[run])[0]):
                        a.append(run[i])
                        b.append(run[j])
            if not a:
                continue
            # one node for each cid, in order of cid
            ids, node = np.unique(cid, return_inverse=True)
            i, j = np.concatenate(a), np.concatenate(b)
            n = np.zeros(len(ids), np.int64)
            np.add.at(n, node[i], copies[j])
            np.add.at(n, node[j], copies[i])
            root = forest(len(ids), node[i], node[j])
            at = np.nonzero(n)[0]
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(n[at]), pa.array(ids[root[at]])],
                                             ["cid", "links", "root"])

    return verify


def lattice_components(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.9,
                       tables: int = 6, probes: int = 4, scale: float = 0.625, seed: int = 10,
                       bucket_rows: int = 4096) -> DataFrame:
    """One row per row of ``df``: id, n_links (other rows found with cosine
    ``least`` or more), component_id (smallest id reachable) and kept.

    Equal vectors are one class with a number of copies; repeated rows count as
    rows.  Vectors that are null, zero, of another length than most, or hold
    null or non-finite components link with nothing: n_links 0 and their own id.
    A cell with over ``bucket_rows`` rows is compared in blocks that different
    tasks take.  Found links are counted and joined up where they are found;
    pairs are never written out.  Null ids are never the smallest.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    dim = dimension(rows, "vec")
    good = usable(F.col("vec")) & (F.size("vec") == dim)
    classes = pin(rows.where(good).groupBy("vec").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
                  .withColumn("cid", F.monotonically_increasing_id()), "classes")
    if not dim:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    keys = classes.select("vec").mapInArrow(
        _post(dim, tables, probes, scale, seed, False), "key long, home boolean")
    crowded = pin(keys.groupBy("key").count().where(F.col("count") > bucket_rows).select(
        "key", F.ceil(F.col("count") / bucket_rows).cast("int").alias("n")), "crowded")
    few = F.broadcast if crowded.count() <= 100_000 else (lambda d: d)  # 12 bytes a row when broadcast
    vec_type = classes.schema["vec"].dataType.simpleString()
    posted = classes.select("cid", "copies", "vec").mapInArrow(
        _post(dim, tables, probes, scale, seed, True),
        f"key long, home boolean, cid long, copies long, vec {vec_type}, cells binary")
    n = F.coalesce("n", F.lit(1))
    own = F.pmod(F.xxhash64("cid"), n).cast("int")
    each = F.sequence(F.lit(0), n - 1)
    blocks = F.concat(
        F.when(F.col("home"), F.transform(each, lambda j: F.struct(
            (own * n + j).alias("part"), F.lit(True).alias("lead"), (j == own).alias("other")))).otherwise(F.array()),
        F.transform(F.filter(each, lambda j: ~(F.col("home") & (j == own))), lambda j: F.struct(
            (j * n + own).alias("part"), F.lit(False).alias("lead"), F.lit(True).alias("other"))))
    dealt = posted.join(few(crowded), "key", "left").withColumn("b", F.explode(blocks)).select(
        F.xxhash64("key", "b.part").alias("run"), "key", "b.*", "cid", "copies", "vec", "cells")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = dealt.repartition(parts, "run").sortWithinPartitions("run").mapInArrow(
        _verify(dim, tables, probes, least), "cid long, links long, root long")
    met = pin(met.groupBy("cid", "root").agg(F.sum("links").alias("links")), "met")
    roots = connected_components(met, "cid", "root")
    links = met.groupBy("cid").agg(F.sum("links").alias("links"))
    known = classes.select("vec", "cid", "least", "copies").join(links, "cid", "left").join(
        roots, F.col("cid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cid"))
    named = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(named, "root").select(
        "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.where(good).join(known, "vec").select("id", "n_links", "component_id").union(
        rows.where(~good).select("id", F.lit(0).cast("long"), "id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
