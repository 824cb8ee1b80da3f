"""WARC archives as seekable Zstandard bundles.

*Records.*  One WARC/1.1 record per page: a response holding an HTTP head and
the page's payload (the html in UTF-8; null is empty), or, when a page with a
smaller id has an equal payload of at least ``min_revisit_bytes``, a revisit
with the HTTP head only.

*Bundles.*  Records are grouped into independent Zstandard frames of about
``FRAME_BYTES``; a bundle ends with a seek table in the public seekable format
(a skippable frame with both sizes of every frame and a footer), so any frame
is found from the file's end and the whole file is still plain Zstandard.

*Index.*  One row per record: ``record_id, page_id, bundle, frame, start,
length``; start and length are relative to the decompressed frame.  ``read``
takes any rows of an index and opens only their frames.

A bundle gets a name of its own on every attempt, and the index lists those of
the attempts that Spark committed, so a lost executor leaves files no index
row points to, and nothing else.

Defined cases: rows that repeat a page are records of their own (all response
if their id is the smallest with the payload); a null page_id revisits any
equal payload that has an id; a null url has no target field; line breaks and
other control characters in a url are percent-encoded; an empty table gives no
bundle and an empty index; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import shared_dir
from cartwheel.llm.scratch import stage
from cartwheel.llm.words import to_bytes

FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 18, 64 << 20, 3
#: Payloads that occur more than once are sent to the scan of the pages up to
#: so many; more are joined with a shuffle.
BROADCAST_PAYLOADS = 1_000_000

#: Fixed values of the formats.
SEEKABLE_MAGIC, SKIPPABLE_MAGIC = 0x8F92EAB1, 0x184D2A5E
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE_DATE = "1970-01-01T00:00:00Z"

INDEX = "record_id string, page_id long, bundle string, frame long, start long, length long"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return pafs.FileSystem.from_uri(path)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> tuple[str, bytes]:
    """(record id, bytes) of one record."""
    digest = payload_digest(payload)
    name = record_id(page_id, digest)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name}",
        f"WARC-Date: {CAPTURE_DATE}",
    ]
    if url is not None:
        target = "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)
        fields.append(f"WARC-Target-URI: {target}")
    if page_id is not None:
        fields.append(f"WARC-X-Page-ID: {page_id}")
    fields.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        fields += [
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"WARC-X-Refers-To-Page-ID: {refers_to}",
            f"WARC-Profile: {REVISIT_PROFILE}",
        ]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return name, "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(record: bytes) -> dict:
    """Fields of one record; a response's payload is held against its
    digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "record_id": fields["WARC-Record-ID"],
        "page_id": number("WARC-X-Page-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("WARC-X-Refers-To-Page-ID"),
    }


class BundleWriter:
    """Frames of records, then the seek table."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        fs, path = filesystem(self.uri)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(path, compression=None)
        self.sizes: list[tuple[int, int]] = []
        self.records: list[bytes] = []
        self.held = self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Take a record; returns its frame and start."""
        if self.held and self.held + len(record) > FRAME_BYTES:
            self.flush()
        at = len(self.sizes), self.held
        self.records.append(record)
        self.held += len(record)
        return at

    def flush(self) -> None:
        if self.held:
            frame = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(b"".join(self.records))
            self.out.write(frame)
            self.sizes.append((len(frame), self.held))
            self.written += len(frame)
            self.records, self.held = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *x) for x in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


class BundleReader:
    """Frames of a bundle by number, found through its seek table."""

    def __init__(self, uri: str):
        fs, path = filesystem(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        self.file.seek(size - 9)
        frames, _, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{uri} has no seek table")
        self.file.seek(size - 9 - 8 * frames)
        self.sizes = np.frombuffer(self.file.read(8 * frames), dtype="<u4").reshape(-1, 2).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes[:, 0])))

    def frame(self, n: int) -> bytes:
        self.file.seek(int(self.starts[n]))
        data = self.file.read(int(self.sizes[n, 0]))
        return zstandard.ZstdDecompressor().decompress(data, max_output_size=int(self.sizes[n, 1]))

    def close(self) -> None:
        self.file.close()


def _typed(pages: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """``page_id, url, payload, refers_to, revisit`` per page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    repeated = stage(
        rows.where(F.length("payload") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first"),
        "warc_repeated",
    )
    if repeated.count() <= BROADCAST_PAYLOADS:
        repeated = F.broadcast(repeated)
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(repeated, "digest", "left").select(
        "page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit")
    )


def write(pages: DataFrame, folder: str, min_revisit_bytes: int = 0) -> DataFrame:
    """Write the bundles of ``pages(page_id, url, html)`` to a folder that all
    executors share; returns the index (staged: reading it writes nothing)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle: BundleWriter | None = None
        for batch in batches:
            rows = []
            ids, urls, refers, revisit = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            for i, payload in enumerate(to_bytes(batch.column(2))):
                if bundle is None:
                    bundle = BundleWriter(folder)
                name, record = encode_record(ids[i], urls[i], payload, refers[i], revisit[i])
                frame, start = bundle.add(record)
                rows.append((name, ids[i], bundle.uri, frame, start, len(record)))
                if bundle.written >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in INDEX.split(", ")]
            )
        if bundle is not None:
            bundle.close()

    return stage(_typed(pages, min_revisit_bytes).mapInArrow(run, INDEX), "warc_index")


RECORD = (
    "record_id string, page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


def read(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of some index rows, read from their bundles."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, uri, number, frame = None, None, None, b""
        for batch in batches:
            rows = []
            bundle, frames, starts, lengths = (batch.column(i).to_pylist() for i in range(4))
            for b, n, at, size in zip(bundle, frames, starts, lengths):
                if b != uri:
                    if reader is not None:
                        reader.close()
                    reader, uri, number = BundleReader(b), b, None
                if n != number:
                    frame, number = reader.frame(n), n
                r = decode_record(frame[at : at + size])
                if not with_payload:
                    r["payload"] = None
                rows.append(r)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in zip(names, kinds)], names=names
            )
        if reader is not None:
            reader.close()

    return (
        index.select("bundle", "frame", "start", "length")
        .repartition("bundle", "frame")
        .sortWithinPartitions("bundle", "frame", "start")
        .mapInArrow(run, RECORD)
    )


def archive_folder(spark: SparkSession) -> str:
    return shared_dir(spark, "llm", "warc", unique=True)
