"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each of some whole records,
followed by a skippable frame that holds the seek table: the compressed and plain
size of every frame, their number, and a magic number at the very end.  The
index maps each record to its bundle, frame and offset within the plain frame,
so that one record is read by fetching one frame.
"""
from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import pin

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = "id long, bundle string, frame int, offset long, length long"


def filesystem(path: str):
    """The file system of a folder that driver and executors share, and the path in it."""
    from pyarrow import fs

    path = re.sub("^file:/+", "file:///", re.sub("^s3[an]:", "s3:", path))
    return fs.FileSystem.from_uri(path)


def record(id_, url: str | None, payload: bytes, digest: bytes, refers_to) -> bytes:
    """A response record, or a revisit of the one it refers to, which keeps the
    HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if id_ is None else id_}>",
            "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {re.sub('[\x00-\x20]', '', url or '')}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head[2:2] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                     f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; payload is empty for a revisit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    page = re.compile("<urn:page:(-?[0-9]*)>")
    number = lambda name: int(n) if name in fields and (n := page.match(fields[name])[1]) else None
    return {"id": number("WARC-Record-ID"), "type": fields["WARC-Type"], "url": fields["WARC-Target-URI"],
            "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "refers_to": number("WARC-Refers-To"),
            "payload": payload, "payload_bytes": size}


class Bundle:
    """Writes a bundle under a name of its own and moves it into place when closed."""

    def __init__(self, fs, folder: str, name: str, frame_bytes: int):
        import zstandard

        self.fs, self.name, self.frame_bytes = fs, name, frame_bytes
        self.final = f"{folder}/{name}"
        self.path = f"{self.final}.{uuid.uuid4().hex}.tmp"
        self.out = fs.open_output_stream(self.path)
        self.zstd = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.at = self.size = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset) of the record."""
        if self.held and self.at + len(data) > self.frame_bytes:
            self.flush()
        place = len(self.frames), self.at
        self.held.append(data)
        self.at += len(data)
        return place

    def flush(self):
        if self.held:
            packed = self.zstd.compress(b"".join(self.held))
            self.out.write(packed)
            self.frames.append((len(packed), self.at))
            self.size += len(packed)
            self.held, self.at = [], 0

    def close(self):
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()
        self.fs.move(self.path, self.final)


def seek_table(file) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of every frame of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    each = 12 if flags & 0x80 else 8
    file.seek(size - 9 - n * each)
    data = file.read(n * each)
    out, at = [], 0
    for k in range(n):
        packed, plain = struct.unpack_from("<II", data, k * each)
        out.append((at, packed, plain))
        at += packed
    return out


def _write(folder: str, frame_bytes: int, bundle_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        part, k, bundle = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            rows = []
            for id_, url, payload, digest, refers_to in zip(*(c for c in batch.columns)):
                data = record(id_.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py())
                if bundle is None:
                    bundle = Bundle(fs, root, f"part-{part:06d}-{k:04d}.warc.zst", frame_bytes)
                rows.append((id_.as_py(), bundle.name, *bundle.add(data), len(data)))
                if bundle.size >= bundle_bytes:
                    bundle.close()
                    bundle, k = None, k + 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                    ["id", "bundle", "frame", "offset", "length"])
        if bundle is not None:
            bundle.close()

    return write


def write_bundles(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", least_bytes: int = 0, frame_bytes: int = 1 << 20,
                  bundle_bytes: int = 1 << 28) -> DataFrame:
    """Write one record a row to bundles in ``folder`` (shared by all machines) and
    return the index: id, bundle, frame, offset (in the plain frame), length.

    The payload is the text in UTF-8 (null: empty).  Of equal payloads (SHA-1 and
    length) of at least ``least_bytes`` the smallest id is a response, repeated
    rows of that id too; others revisit it.  Null ids are never the smallest; a
    group of only null ids is all responses.  An empty table writes nothing.
    A repeated task writes the same file again: rows are ordered, and a bundle
    appears under its name only when it is whole.
    """
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.unhex(F.sha1("payload")))
    rows = rows.withColumn("size", F.octet_length("payload"))
    least = rows.where(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.min("id").alias("first"))
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    typed = rows.join(least, ["digest", "size"], "left").select("id", "url", "payload", "digest",
                                                               refers.alias("refers_to"))
    typed = typed.sortWithinPartitions("digest", "id", "url")
    return pin(typed.mapInArrow(_write(folder, frame_bytes, bundle_bytes), INDEX), "index")


def _fetch(folder: str, payload: bool):
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        fs, root = filesystem(folder)
        plain = zstandard.ZstdDecompressor()
        name, file, table, held, frame = None, None, [], None, b""
        for batch in batches:
            out = []
            for bundle, k, at, length in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle != name:
                    if file:
                        file.close()
                    name, held = bundle, None
                    file = fs.open_input_file(f"{root}/{bundle}")
                    table = seek_table(file)
                if k != held:
                    start, packed, size = table[k]
                    file.seek(start)
                    held, frame = k, plain.decompress(file.read(packed), max_output_size=size)
                r = parse(frame[at:at + length])
                if r["type"] == "response":
                    digest = base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode()
                    if digest != r["digest"] or len(r["payload"]) != r["payload_bytes"]:
                        raise ValueError(f"record {r['id']} in {bundle} is damaged")
                out.append((r["id"], r["url"], r["type"], r["refers_to"], r["payload_bytes"], r["digest"],
                            r["payload"] if payload else None))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                    ["id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])
        if file:
            file.close()

    return fetch


def read_records(index: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records of an index, or of any of its rows: id, url, record_type,
    refers_to, payload_bytes, payload_digest (base32 SHA-1) and the payload (null
    if not asked for; empty for revisits).  Only frames that hold one are read,
    each once; the digest of every response is verified.
    """
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = index.select("bundle", "frame", "offset", "length").repartition(n, "bundle", "frame").sortWithinPartitions(
        "bundle", "frame", "offset")
    return rows.mapInArrow(_fetch(folder, payload), (
        "id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
        "payload binary"))
