"""Best-fit packing of documents into sequences, certified by lower bounds.

Pieces shorter than a sequence are dealt to partitions and packed there by
best-fit decreasing.  A dual-feasible function f bounds the bins from below by
ceil(sum f(length) / f(capacity)); a partition whose number of bins meets the
best of a family of such bounds is certified, and done but for its emptiest bin.
Of the others, full bins are kept.  The documents of all other bins are
exchanged: dealt anew, to fewer partitions, and packed again, down to one
partition whose bins are final.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batchtokens import encoder, slices_by_bytes
from .common import pin, release, shards_for

PIECE = "piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, text_col: str = "text") -> DataFrame:
    """Pieces of whole documents: the columns of ``docs`` but the text, then
    piece (from 0), start, length and ids_crc32.

    A document is its ids and ``end_id``; null and empty texts are ``end_id``
    alone.  One longer than ``capacity`` is cut into pieces of that length, the
    first of which takes what remains.
    """
    keep = [c for c in docs.columns if c != text_col]
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # of what earlier stages left in this worker
        tok = encoder(path)
        for batch in batches:
            texts = batch.column(len(keep))
            for lo, hi in slices_by_bytes(texts):
                row, piece, start, length, crc = [], [], [], [], []
                found = tok.encode(texts.slice(lo, hi - lo))
                for r, (a, b) in enumerate(zip(found.start.tolist(), found.stop.tolist())):
                    ids = memoryview(found.ids[a:b].astype("<u4").tobytes() + end)
                    n = len(ids) // 4
                    at, to = 0, n if n <= capacity else n % capacity or capacity
                    k = 0
                    while at < n:
                        row.append(lo + r)
                        piece.append(k)
                        start.append(at)
                        length.append(to - at)
                        crc.append(zlib.crc32(ids[4 * at:4 * to]))
                        at, to, k = to, to + capacity, k + 1
                take = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).take(take) for i in range(len(keep))), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    [*keep, "piece", "start", "length", "ids_crc32"])
        release()

    src = docs.select(*keep, text_col)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]), PIECE])
    return src.mapInArrow(cut, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of every item and the room left in every bin."""
    order = np.argsort(-lengths, kind="stable")
    where = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    room: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some bin has r left
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fit = mask >> n
        if fit:
            r = n + (fit & -fit).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                mask ^= 1 << r
        else:
            b, r = len(room), capacity
            room.append(capacity)
        where[i], offset[i] = b, capacity - r
        room[b] = r - n
        if r > n:
            by_room[r - n].append(b)
            mask |= 1 << (r - n)
    return where, offset, np.array(room, np.int64)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins needed at least for ``counts[n]`` items of each length n, by three
    families of dual-feasible functions: the identity; u_k, which rounds
    (k + 1) n / capacity; and the one that takes items over capacity - t as
    whole bins and drops items up to t."""
    n = np.nonzero(counts)[0]
    if not len(n):
        return 0
    c = counts[n]
    best = -(-int((n * c).sum()) // capacity)
    for k in range(1, 65):
        up = (k + 1) * n
        f = np.where(up % capacity == 0, n * k, up // capacity * capacity)  # times k * capacity
        best = max(best, -(-int((f * c).sum()) // (k * capacity)))
    for t in np.unique(np.minimum(n, capacity - n)):
        if 0 < t <= capacity // 2:
            f = np.where(n > capacity - t, capacity, np.where(n >= t, n, 0))
            best = max(best, -(-int((f * c).sum()) // capacity))
    return best


def _packer(capacity: int, round_: int, last: bool):
    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "piece_id"], ascending=[False, True], ignore_index=True)
        n = pdf["length"].to_numpy()
        where, offset, room = best_fit_decreasing(n, capacity)
        bound = lower_bound(np.bincount(n, minlength=capacity + 1), capacity)
        done = np.full(len(room), len(room) <= bound or last) | (room == 0)
        if not last and len(room) > 1:
            done[room.argmax()] = False  # a certified partition still hands on its emptiest bin
        part = int(key[0])
        return pd.DataFrame({
            "piece_id": pdf["piece_id"], "length": n, "offset": offset, "done": done[where],
            "sequence_id": (round_ << 56) | (part << 24) | where})

    return pack


def pack_best_fit(lengths: DataFrame, capacity: int, part_rows: int = 100_000, rounds: int = 12) -> DataFrame:
    """(piece_id, length, sequence_id, offset) for pieces (piece_id, length) with
    lengths 1 to ``capacity``; offsets in a sequence run without gaps from 0.

    ``piece_id`` must be unique.  A partition holds ``part_rows`` rows or so, in
    every round.  A single partition is final; with more, rounds go on while they
    leave fewer pieces than before, ``rounds`` at most, and the last one is final.
    """
    todo = lengths.select("piece_id", "length")
    rows = todo.count()
    done, before = None, None
    for k in range(rounds):
        parts = shards_for(rows, part_rows)
        last = parts == 1 or k == rounds - 1 or (before is not None and rows > 0.9 * before)
        before = rows
        dealt = todo.withColumn("part", F.pmod(F.xxhash64("piece_id", F.lit(k)), F.lit(parts)))
        packed = pin(dealt.groupBy("part").applyInPandas(
            _packer(capacity, k, last), "piece_id long, length long, offset long, done boolean, sequence_id long"),
            "packed")
        new = packed.where("done").select("piece_id", "length", "sequence_id", "offset")
        done = new if done is None else done.union(new)
        todo = packed.where("not done").select("piece_id", "length")
        rows = todo.count()
        if not rows:
            break
    return done


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, text_col: str = "text",
                   part_rows: int = 100_000) -> DataFrame:
    """Pieces of ``token_pieces`` with the sequence_id and offset of each.

    Full pieces are sequences of their own (negative ids).  Repeated rows are
    packed once each; an empty table gives no rows.  Columns of ``docs`` named
    like an added one are left out.
    """
    added = {"piece", "start", "length", "ids_crc32", "piece_id", "sequence_id", "offset"}
    docs = docs.select(*[c for c in docs.columns if c.lower() not in added])
    pieces = pin(token_pieces(docs, path, capacity, end_id, text_col).withColumn(
        "piece_id", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == capacity)
    rest = pieces.where(F.col("length") < capacity)
    placed = pack_best_fit(rest, capacity, part_rows)
    out = rest.join(placed.drop("length"), "piece_id")
    cols = [c for c in pieces.columns if c != "piece_id"]
    return out.select(*cols, "sequence_id", "offset").union(
        full.select(*cols, (-1 - F.col("piece_id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
