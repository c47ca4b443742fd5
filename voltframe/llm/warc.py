"""WARC archives as seekable Zstandard bundles.

A bundle is one file: independent Zstandard frames of whole WARC records, a
skippable frame that maps record identifiers to (frame, offset in the frame,
length), and the footer seek table of the public seekable format (a skippable
frame with the sizes of all frames).  A reader finds a record with three small
reads: footer, identifier map, one frame.  Any Zstandard tool unpacks the file
to plain WARC.

Of records with equal payloads of at least ``min_payload_bytes`` bytes the one
with the smallest page_id is a response, the others are revisits that refer to
it.  Bundles are written by Spark's own file writer and so under its commit
protocol: a lost executor's half-written files never show up.

Defined results: null html is an empty payload, a null url leaves its header
out, a null page_id is an identifier of its own and is never referred to;
rows with the same smallest page_id and payload are all responses; an empty
table writes no bundle and reads back empty; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm.common import shared_dir, staged, text_of

#: Raw bytes of records after which a frame is closed, and compressed bytes for a bundle.
FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 4 * 1024 * 1024
RECORD_DATE = "2000-01-01T00:00:00Z"

SEEK_FRAME_MAGIC = 0x184D2A5E
SEEK_FOOTER_MAGIC = 0x8F92EAB1
ID_FRAME_MAGIC = 0x184D2A50
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The text writer ends each row with this separator, whose UTF-8 form is the last three
#: of the four bytes of the footer's magic number; the rows leave these bytes out.
TAIL = "꒏"
RECORD_COLUMNS = ("page_id bigint, url string, record_type string, refers_to bigint, "
                  "payload_bytes bigint, payload_digest string")


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _of_urn(urn: str) -> int | None:
    number = urn[len("<urn:page:"):-1]
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; ``refers_to`` makes it a revisit without the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {RECORD_DATE}"]
    if url is not None:  # a header is one line
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url))
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
             f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record in unpacked WARC data."""
    at = 0
    while at < len(raw):
        body = raw.index(b"\r\n\r\n", at) + 4
        lines = raw[at:body - 4].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        end = body + int(headers["Content-Length"])
        yield headers, raw[body:end]
        at = end + 4


class Bundle:
    """Collects records into frames and frames into one bundle."""

    def __init__(self) -> None:
        import zstandard
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frames: list[tuple[bytes, int]] = []
        self.ids: list[tuple[int | None, int, int, int]] = []
        self.open: list[bytes] = []
        self.open_bytes = self.packed_bytes = 0

    def add(self, page_id: int | None, raw: bytes) -> None:
        self.ids.append((page_id, len(self.frames), self.open_bytes, len(raw)))
        self.open.append(raw)
        self.open_bytes += len(raw)
        if self.open_bytes >= FRAME_BYTES:
            self._close_frame()

    def _close_frame(self) -> None:
        if self.open:
            packed = self.packer.compress(b"".join(self.open))
            self.frames.append((packed, self.open_bytes))
            self.packed_bytes += len(packed)
            self.open, self.open_bytes = [], 0

    def close(self) -> bytes:
        self._close_frame()
        ids = self.packer.compress(json.dumps(self.ids).encode())
        self.frames.append((struct.pack("<II", ID_FRAME_MAGIC, len(ids)) + ids, 0))
        table = b"".join(struct.pack("<II", len(f), n) for f, n in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEK_FOOTER_MAGIC)
        seek = struct.pack("<II", SEEK_FRAME_MAGIC, len(table) + len(footer)) + table + footer
        return b"".join([*(f for f, _ in self.frames), seek])


class BundleReader:
    """Reads a bundle by its footer."""

    def __init__(self, data: bytes) -> None:
        import zstandard
        self.unpacker = zstandard.ZstdDecompressor()
        self.data = memoryview(data)
        count, flags, magic = struct.unpack("<IBI", self.data[-9:])
        if magic != SEEK_FOOTER_MAGIC:
            raise ValueError("no seek table at the end of the bundle")
        entry = 12 if flags & 0x80 else 8
        at = len(data) - 9 - count * entry
        self.frames: list[tuple[int, int, int]] = []  # start, packed and raw size
        start = 0
        for k in range(count):
            packed, size = struct.unpack("<II", self.data[at + k * entry:at + k * entry + 8])
            self.frames.append((start, packed, size))
            start += packed

    def frame(self, k: int) -> bytes:
        start, packed, size = self.frames[k]
        return self.unpacker.decompress(self.data[start:start + packed], max_output_size=size)

    def ids(self) -> list[tuple[int | None, int, int, int]]:
        """(page_id, frame, offset in the frame, length) of each record."""
        start, packed, _ = self.frames[-1]
        return [tuple(x) for x in json.loads(self.unpacker.decompress(self.data[start + 8:start + packed]))]

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        for k in range(len(self.frames) - 1):
            yield from parse_records(self.frame(k))

    def find(self, page_id: int) -> tuple[dict[str, str], bytes]:
        """One record, unpacking only its frame."""
        for found, k, at, size in self.ids():
            if found == page_id:
                return next(parse_records(self.frame(k)[at:at + size]))
        raise KeyError(page_id)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row(data: bytes) -> pa.RecordBatch:
        return pa.record_batch([pa.array([data[:-len(TAIL.encode())]], pa.binary())], names=["value"])

    bundle = Bundle()
    for batch in batches:
        for page_id, url, html, digest, refers_to in zip(*batch.columns):
            payload = html.as_py().encode()
            name = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
            bundle.add(page_id.as_py(), record(page_id.as_py(), url.as_py(), payload, name, refers_to.as_py()))
            if bundle.packed_bytes >= BUNDLE_BYTES:
                yield row(bundle.close())
                bundle = Bundle()
    if bundle.ids:
        yield row(bundle.close())


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            out: list[tuple] = []
            for headers, block in BundleReader(content.as_py()).records():
                kind = headers["WARC-Type"]
                payload = block[block.index(b"\r\n\r\n") + 4:]
                if kind == "response":  # measured on what was read, not taken from the headers
                    size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if "sha1:" + digest != headers["WARC-Payload-Digest"]:
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
                else:
                    size, digest = int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"][5:]
                refers = headers.get("WARC-Refers-To")
                out.append((_of_urn(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind,
                            _of_urn(refers) if refers else None, size, digest))
            columns = list(zip(*out)) or [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, kinds)],
                                  names=["page_id", "url", "record_type", "refers_to", "payload_bytes",
                                         "payload_digest"])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(*batch.columns):
            reader = BundleReader(content.as_py())
            rows = [(path.as_py(), i, reader.frames[k][0], reader.frames[k][1], at, size)
                    for i, k, at, size in reader.ids()]
            columns = list(zip(*rows)) or [[]] * 6
            kinds = (pa.string(), *[pa.int64()] * 5)
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, kinds)],
                                  names=["path", "page_id", "frame_start", "frame_bytes", "offset", "length"])


def with_references(pages: DataFrame, min_payload_bytes: int = 0) -> DataFrame:
    """page_id, url, html, digest (hex SHA-1) and refers_to of each page."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        text_of("html").alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary"))) \
               .withColumn("_bytes", F.octet_length("html"))
    # Partial aggregation leaves one row a payload and task, however hot the payload.
    first = (rows.where(F.col("_bytes") >= min_payload_bytes)
             .groupBy("digest", "_bytes")
             .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("digest", "_bytes", "first_id"))
    # Written first: both sides of the join are then plain shuffles, which Spark splits where skewed,
    # and a small table is broadcast by its known size.
    joined = rows.join(staged(first, "warc-first"), ["digest", "_bytes"], "left")
    return joined.select("page_id", "url", "html", "digest",
                         F.when(F.col("page_id") > F.col("first_id"), F.col("first_id"))
                          .otherwise(F.when(F.col("page_id").isNull(), F.col("first_id"))).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, min_payload_bytes: int = 0) -> None:
    """Writes bundles of a WARC record per page below ``path``, one file each."""
    packed = with_references(pages, min_payload_bytes).mapInArrow(_pack, "value binary")
    (packed.select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", TAIL).option("maxRecordsPerFile", 1).text(path))


def _bundles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest of every record."""
    return _bundles(spark, path).select("content").mapInArrow(_unpack, RECORD_COLUMNS)


def record_index(spark: SparkSession, path: str) -> DataFrame:
    """Where each record lies: path, page_id, frame_start, frame_bytes, offset, length."""
    return _bundles(spark, path).select("path", "content").mapInArrow(
        _index, "path string, page_id bigint, frame_start bigint, frame_bytes bigint, offset bigint, length bigint")


def archive_and_read(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the archives (below the shared folder by default) and reads them back."""
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/llm-warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    return read_archives(spark, path)
