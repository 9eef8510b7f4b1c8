"""Alignment of the tokens of two tokenizers by diagonal run skipping.

Both token sequences of a text spell the same bytes, so their end offsets are two
rising arrays.  Where tokens correspond one to one, the arrays are equal at a
constant shift of indices; such a stretch is jumped by comparing blocks of doubling
length at the current shift, halved again at its end.  Where a stretch ends, the
shorter side advances token by token until both end together; that irregular group
sets the new shift.

Corpus-wide counts of linked id pairs are joined back by blocks: a block of
documents posts each of its different pairs once, so a pair that stands in every
document is one row a block, not one a document.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .batchtokens import encoder, slices_by_bytes
from .common import pin, release

class Aligned(NamedTuple):
    """Token ``left[k]`` of the first side is linked to ``right[k]`` of the other;
    ``groups`` spells the tokens of each group, ``a1,a2|b1``."""

    left: np.ndarray
    right: np.ndarray
    groups: list[str]


def diagonal_runs(a: list[int], b: list[int], names_a: list[str], names_b: list[str]) -> Aligned:
    """Align two sides by their end offsets ``a`` and ``b``, whose last ones are equal."""
    starts_a, starts_b, sizes, groups = [], [], [], []  # links come in stretches of one shift
    i = j = 0
    n, m = len(a), len(b)
    while i < n:
        if a[i] == b[j]:  # one to one: probe along the shift j - i
            at, step, most = 1, 2, min(n - i, m - j)
            while at < most and a[i + at:i + at + step] == b[j + at:j + at + step]:
                at, step = min(at + step, most), 2 * step
            while step := step // 2:  # the stretch ends in the block that differs
                if at + step <= most and a[i + at:i + at + step] == b[j + at:j + at + step]:
                    at += step
            starts_a.append(i)
            starts_b.append(j)
            sizes.append(at)
            groups += [f"{x}|{y}" for x, y in zip(names_a[i:i + at], names_b[j:j + at])]
            i, j = i + at, j + at
        else:  # an irregular group: each step goes on to the next two tokens that overlap
            p, q = i, j
            x, y = a[p], b[q]
            while True:
                starts_a.append(p)
                starts_b.append(q)
                sizes.append(1)
                if x == y:
                    break
                if x < y:
                    p += 1
                    x = a[p]
                else:
                    q += 1
                    y = b[q]
            groups.append(",".join(names_a[i:p + 1]) + "|" + ",".join(names_b[j:q + 1]))
            i, j = p + 1, q + 1
    first_a, first_b, size = (np.array(x, np.int64) for x in (starts_a, starts_b, sizes))
    left = np.repeat(first_a - (np.cumsum(size) - size), size)
    left += np.arange(len(left))
    return Aligned(left, left + np.repeat(first_b - first_a, size), groups)


ALIGNED = ("n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<bigint>, times array<int>, block long")


def align_tokens(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", block_bytes: int = 16 << 20) -> DataFrame:
    """``docs`` without the text, with the numbers of tokens, groups and links, the
    digest of the groups, the different linked id pairs (id of the first vocabulary
    times 2 ** 32 plus that of the other), how often each is linked, and a block
    number that about ``block_bytes`` of neighbouring texts share.

    Both vocabularies encode a space and the text.  Null and empty texts, and those
    whose tokens of either side do not spell these bytes, have no tokens.  Repeated
    rows each give a row; an empty table gives none; columns named like an added one
    are replaced.
    """
    added = {c.split()[0] for c in ALIGNED.split(", ")}
    keep = [c for c in docs.columns if c != text_col and c.lower() not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        enc_a, enc_b = encoder(path_a, plain=True), encoder(path_b)
        side_a, side_b = _Side(enc_a.spellings()), _Side(enc_b.spellings())
        for batch in batches:
            texts = pc.fill_null(batch.column(len(keep)), "")
            for lo, hi in slices_by_bytes(texts, block_bytes):
                part = texts.slice(lo, hi - lo)
                a, b = enc_a.encode(part, lead=True), enc_b.encode(part, lead=True)
                rows = []
                for k, text in enumerate(part):
                    ids_a, ids_b = a.ids[a.start[k]:a.stop[k]], b.ids[b.start[k]:b.stop[k]]
                    rows.append(_row(text.as_py(), ids_a, ids_b, side_a, side_b))
                block += 1
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(lo, hi - lo) for c in range(len(keep))),
                     *(pa.array(cols[c], pa.int64()) for c in range(4)), pa.array(cols[4], pa.string()),
                     _lists(cols[5], pa.int64()), _lists(cols[6], pa.int32()),
                     pa.array(np.full(hi - lo, block))], [*keep, *[c.split()[0] for c in ALIGNED.split(", ")]])
        release()

    src = docs.select(*keep, text_col)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
    return src.mapInArrow(run, ", ".join([*kept, ALIGNED]))


def _lists(rows, kind: pa.DataType) -> pa.Array:
    at = np.cumsum([0, *map(len, rows)])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, kind))


NONE = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))


class _Side:
    """Bytes, their number and the decimal of every id of a vocabulary."""

    def __init__(self, spellings: list[bytes]):
        self.spellings = spellings
        self.size = np.array([len(s) for s in spellings])
        self.names = [str(k) for k in range(len(spellings))]

    def ends(self, ids: list[int], data: bytes) -> list[int] | None:
        """End offsets of tokens that spell ``data``."""
        if b"".join(map(self.spellings.__getitem__, ids)) != data:
            return None
        return np.cumsum(self.size[ids]).tolist()


def _row(text: str, ids_a: np.ndarray, ids_b: np.ndarray, side_a: _Side, side_b: _Side):
    if not text:
        return NONE
    data, some_a, some_b = b" " + text.encode(), ids_a.tolist(), ids_b.tolist()
    ends_a, ends_b = side_a.ends(some_a, data), side_b.ends(some_b, data)
    if ends_a is None or ends_b is None:
        return NONE
    left, right, groups = diagonal_runs(ends_a, ends_b, list(map(side_a.names.__getitem__, some_a)),
                                        list(map(side_b.names.__getitem__, some_b)))
    pairs = ids_a[left].astype(np.int64) << 32 | ids_b[right].astype(np.int64)
    pairs.sort()
    first = np.nonzero(np.diff(pairs, prepend=-1))[0]
    return (len(some_a), len(some_b), len(groups), len(left), hashlib.sha256(";".join(groups).encode()).hexdigest(),
            pairs[first], np.diff(first, append=len(pairs)))


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, pair, n): in how many of the documents of a block that are read together a pair is linked."""
    for batch in batches:
        block = batch.column(0).to_numpy()
        size = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
        of, pair = np.repeat(block, size), batch.column(1).flatten().to_numpy()
        for b in np.unique(block):
            found, n = np.unique(pair[of == b], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), b)), pa.array(found), pa.array(n)],
                                             ["block", "pair", "n"])


def _scores(keep: list[str]):
    def score(docs: pa.Table, known: pa.Table) -> pa.Table:
        known = known.combine_chunks()
        pair = known.column("pair").to_numpy()
        order = np.argsort(pair, kind="stable")
        pair, count, best = (known.column(c).to_numpy()[order] for c in ("pair", "n", "best"))
        n_best, total = [], []
        for mine, times in zip(docs.column("pairs"), docs.column("times")):
            at = np.searchsorted(pair, mine.values.to_numpy())
            times = times.values.to_numpy().astype(np.int64)
            n_best.append(int(times[count[at] == best[at]].sum()))
            total.append(int((times * count[at]).sum()))
        return pa.table([*(docs.column(c) for c in keep), pa.array(n_best, pa.int64()), pa.array(total, pa.int64())],
                        [*keep, "n_best", "count_sum"])

    return score


def align_corpus(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", block_bytes: int = 16 << 20) -> DataFrame:
    """``align_tokens`` without its lists and blocks, with n_best (links whose pair's
    count, the number of documents that hold it linked, is the highest of the first
    id's) and count_sum (of the counts over all links).

    Counts are over the whole corpus.  Documents without tokens have zeros.
    """
    marked = pin(align_tokens(docs.drop("n_best", "count_sum"), path_a, path_b, text_col, block_bytes), "aligned")
    posted = pin(marked.where(F.size("pairs") > 0).select("block", "pairs").mapInArrow(
        _block_pairs, "block long, pair long, n long"), "posted")
    counts = pin(posted.groupBy("pair").agg(F.sum("n").alias("n")), "counts")
    highest = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("best"))
    rated = counts.withColumn("a", F.shiftright("pair", 32)).join(highest, "a").select("pair", "n", "best")
    known = posted.select("block", "pair").join(rated, "pair").select("block", "pair", "n", "best")
    keep = [c for c in marked.columns if c not in ("pairs", "times", "block")]
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in marked.select(*keep).schema.fields]
    scored = marked.where(F.size("pairs") > 0).groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        _scores(keep), ", ".join([*kept, "n_best long, count_sum long"]))
    zero = F.lit(0).cast("long")
    return scored.unionByName(marked.where(F.size("pairs") == 0).select(
        *keep, zero.alias("n_best"), zero.alias("count_sum")))
