"""Document fingerprints of improbable features.

Every window of ``WINDOW`` bytes has an entropy.  How often each entropy occurs over
all documents ranks windows: the rarer, the better.  In every neighbourhood of ``NEAR``
window positions the best one (the first of equals) scores a point; windows with
``POINTS`` or more are the features of a text.  Features go, in order, into a chain of
Bloom filters of ``FILTER`` bytes with ``FILL`` features each.  Two fingerprints are as
alike as the filters of the shorter chain find a like one in the other: the bits two
filters share, above those they would share by chance, over the most they could.
"""
from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

WINDOW, NEAR, POINTS = 24, 24, 6
FILTER, FILL, HASHES = 256, 160, 5
BINS, WEAK = 128, 2.0  # bins of entropies; under so many bits a window is no feature
CHUNK = 1 << 20

UNIT = 1 << 24  # entropies are summed as integers, so that a window has the same one anywhere
STEP = np.array([round(c * np.log2(c) * UNIT) if c else 0 for c in range(WINDOW + 1)], np.int64)
GAIN = np.diff(STEP)  # what sum(c log c) gains as a count c becomes c + 1
MOST = float(np.log2(WINDOW))


def alike(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte, how many of the WINDOW - 1 bytes before it, and after it, equal it."""
    back, ahead = np.zeros(len(b), np.uint8), np.zeros(len(b), np.uint8)
    for d in range(1, WINDOW):
        same = b[d:] == b[:-d]
        back[d:] += same
        ahead[:-d] += same
    return back, ahead


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """The bin (0 to BINS - 1) of the entropy of every window of the bytes ``data``."""
    n = len(data) - WINDOW + 1
    out = np.zeros(max(0, n), np.uint8)
    for lo in range(0, n, CHUNK):
        b = data[lo:lo + CHUNK + WINDOW - 1]
        back, ahead = alike(b)
        # the first window grows byte by byte; then one leaves, whose count falls, and one enters
        counts = np.bincount(b[:WINDOW], minlength=256)
        first = STEP[counts].sum()
        # byte j enters a window that holds back[j] of its kind, among them byte j - WINDOW + 1 on
        enter = GAIN[back[WINDOW:]]
        leave = GAIN[ahead[:-WINDOW]]
        total = first + np.concatenate([np.zeros(1, np.int64), np.cumsum(enter - leave)])
        out[lo:lo + len(total)] = bin_of(total)
    return out


def bin_of(total: np.ndarray) -> np.ndarray:
    """The bin of windows with this sum of c log c."""
    bits = MOST - total / (WINDOW * UNIT)
    return np.clip(bits * ((BINS - 1) / MOST) + 0.5, 0, BINS - 1).astype(np.uint8)


def ranks(histogram: np.ndarray) -> np.ndarray:
    """Rank of each bin: 0 is the rarest that is not weak; 255 marks weak ones."""
    order = np.lexsort((np.arange(BINS), histogram))
    out = np.empty(BINS, np.uint8)
    out[order] = np.arange(BINS)
    out[: int(np.ceil(WEAK * (BINS - 1) / MOST))] = 255
    return out


def feature_places(rank: np.ndarray) -> np.ndarray:
    """Positions of the windows that are best in POINTS or more neighbourhoods."""
    n = len(rank)
    points = np.zeros(n, np.int16)
    near = min(NEAR, n)
    for lo in range(0, max(0, n - near + 1), CHUNK):
        r = rank[lo:lo + CHUNK + near - 1]
        key = r.astype(np.int32) << 22 | np.arange(len(r), dtype=np.int32)  # CHUNK and NEAR fit in 22 bits
        width = 1
        while 2 * width <= near:  # minima over doubling widths
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if near > width:
            key = np.minimum(key[:len(key) - (near - width)], key[near - width:])
        points[lo:lo + len(r)] += np.bincount(key & 0x3FFFFF, minlength=len(r)).astype(np.int16)
    return np.nonzero((points >= min(POINTS, near)) & (rank < 255))[0]


def features(text: str, rank: np.ndarray) -> np.ndarray:
    """Hashes of the features of a text, in order; one without any has itself."""
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    places = feature_places(rank[entropy_bins(raw)]).tolist() if len(raw) >= WINDOW else []
    cut = [data[p:p + WINDOW] for p in places] or [data] * (len(data) > 0)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, cut), np.uint64, len(cut))


def filters(text: str, rank: np.ndarray) -> np.ndarray:
    """The chain of Bloom filters: (filters, FILTER) bytes; none for an empty text."""
    found = features(text, rank)
    out = np.zeros((-(-len(found) // FILL), 8 * FILTER), np.uint8)
    if len(found):
        first, step = found & np.uint64(0xFFFFFFFF), found >> np.uint64(32) | np.uint64(1)
        bits = (first[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) % np.uint64(8 * FILTER)
        out[np.repeat(np.arange(len(found)) // FILL, HASHES), bits.ravel().astype(np.int64)] = 1
    return np.packbits(out, axis=1)


def spelled(chain: np.ndarray) -> str:
    return ":".join(base64.b64encode(f.tobytes()).decode() for f in chain)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1; two empty chains are alike, an empty one and another are not."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    a, b = a.view(np.uint64), b.view(np.uint64)
    size = np.bitwise_count(b).sum(1).astype(float)
    total = 0.0
    for f in a:
        mine = float(np.bitwise_count(f).sum())
        shared = np.bitwise_count(f & b).sum(1)
        chance = mine * size / (8 * FILTER)
        room = np.maximum(np.minimum(mine, size) - chance, 1e-9)
        total += float(np.clip((shared - chance) / room, 0.0, 1.0).max())
    return min(1.0, total / len(a))


def entropy_histogram(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Windows of each entropy bin over all whole texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            for t in batch.column(0):
                total += np.bincount(entropy_bins(np.frombuffer((t.as_py() or "").encode(), np.uint8)), minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), pa.array(total)], ["bin", "n"])

    out = np.zeros(BINS, np.int64)
    for r in docs.select(text_col).mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n")).collect():
        out[r[0]] = r[1]  # BINS rows
    return out


def edited(text: str, after: str) -> str:
    """``text`` with its last half replaced by as much of ``after`` from its start."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


SCHEMA = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def _compare(rank: np.ndarray, batch_rows: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (part, tail, id, text) sorted by part, tail and order; each but a tail is
        compared with the next of its part."""
        held, out = None, []
        for batch in batches:
            part, tail, ids, texts = (batch.column(k) for k in range(4))
            for p, last, i, t in zip(part.to_pylist(), tail.to_pylist(), ids.to_pylist(), texts):
                text = t.as_py() or ""
                if held and held[0] != p:
                    held = None  # what comes after the first tail row of a part is not needed
                if last and not held:
                    continue
                chain = filters(text, rank)
                if held:
                    _, my_id, mine, my_chain = held
                    new = edited(mine, text)
                    changed = filters(new, rank)
                    out.append((my_id, len(mine), hashlib.sha256(new.encode()).hexdigest(), spelled(my_chain),
                                spelled(changed), likeness(my_chain, changed), likeness(my_chain, chain)))
                held = None if last else (p, i, text, chain)
                if len(out) >= batch_rows:
                    yield _batch(out)
                    out = []
        yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[] for _ in NAMES]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], NAMES)


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       rank: np.ndarray | None = None, parts: int | None = None) -> DataFrame:
    """One row per row of ``docs``: its id, n_chars (code points), the sha256 of its
    edited text (the last half replaced by the beginning of the next document's, by
    falling id; after the last comes the first), the fingerprints of both texts, and
    the likeness of its fingerprint to the edited text's and to the next document's.

    ``rank`` (of entropy bins) is counted over all of ``docs`` unless given.  Null texts
    count as empty; an empty fingerprint is "" and like only an empty one.  Rows of
    equal id follow each other by the hash of their texts; null ids come last.  Other
    columns are not read, so their names cannot clash.  An empty table gives no rows.

    Texts are shuffled once, to ranges of ids that hold about equally many rows; the
    first row of each range goes to the range before it as well.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    key = F.coalesce("id", F.lit(-(1 << 63)).cast("long"))  # null ids are last
    parts = max(2, parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.agg(F.percentile_approx(key, [k / parts for k in range(1, parts)], 100 * parts).alias("c")).first()["c"]
    if cuts is None:
        return spark.createDataFrame([], SCHEMA.replace("id long", f"`{id_col}` long", 1))
    splits = [float("-inf"), *sorted(set(map(float, cuts))), float("inf")]
    rows = Bucketizer(splits=splits, inputCol="place", outputCol="part").transform(
        rows.withColumn("place", key.cast("double"))).select("id", "text", (-F.col("part")).cast("int").alias("part"))
    firsts = rows.groupBy("part").agg(F.max(key).alias("key")).orderBy("part").collect()  # a row a range
    tails = spark.createDataFrame([(f["key"], firsts[k - 1]["part"]) for k, f in enumerate(firsts)], "key long, part int")
    rank = ranks(entropy_histogram(rows, "text")) if rank is None else rank
    here = rows.select("part", F.lit(False).alias("tail"), "id", "text")
    again = rows.select("id", "text", key.alias("key")).join(F.broadcast(tails), "key").select(  # a row a range, longs only
        "part", F.lit(True).alias("tail"), "id", "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = here.union(again).withColumn("hash", F.xxhash64("text")).repartition(n, "part").sortWithinPartitions(
        "part", "tail", F.desc_nulls_last("id"), "hash", F.md5("text"))
    return out.select("part", "tail", "id", "text").mapInArrow(_compare(rank), SCHEMA).withColumnRenamed("id", id_col)
