"""WARC archives as seekable Zstandard bundles.

A bundle is one file: independent frames, each holding a group of whole WARC records; a skippable frame with the record map
(record id -> frame, offset inside the frame's content, length); and, last, a skippable frame with the seek table of the seekable format
(compressed and plain size of every frame). Any zstd reader unpacks it to plain WARC; a reader that knows the footer gets at one record by unpacking one frame.

Bundles are rows of a DataFrame and are written by Spark's own writer, so tasks may fail and be repeated, and any file system that Spark
writes to will do: the text writer ends each row with its separator, which is set to the last four bytes of the seek table.

Of records with equal payloads of at least ``least_bytes``, that with the smallest page_id is the response and the others
are revisits that refer to it. A null payload is empty; a null url is left out; records without page_id never are the one referred to
unless no other is there, and then all are responses. Rows that agree in page_id and payload are written once each, under one record id, and of one type.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 16 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
SEEK_MAGIC = struct.pack("<I", 0x8F92EAB1)
SKIPPABLE = 0x184D2A50
SEEK_FRAME = 0x184D2A5E
READ = (
    "record_id string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
    "payload binary, bundle string, frame int, offset int, length int"
)
MAP = "record_id string, bundle string, frame int, offset int, length int"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id}:{digest}'.encode()).hexdigest())}>"


def _line(value: str) -> str:
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> tuple[str, bytes]:
    """(record id, bytes) of a response, or of a revisit if ``refers_to`` names another page."""
    name = record_id(page_id, digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_line(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    block = http + payload if refers_to is None else http
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return name, "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record's bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    response = fields["WARC-Type"] == "response"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if response and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload differs from its length or digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "record_id": fields["WARC-Record-ID"],
        "page_id": number("X-Page-ID"),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": number("X-Refers-To-Page"),
        "payload": payload if response else None,
    }


class Bundle:
    """A bundle being filled; ``finish`` gives its bytes without the magic number that the writer appends."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, write_checksum=True).compress
        self.frame_bytes = frame_bytes
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.map: list[tuple[str, int, int, int]] = []
        self.open = bytearray()
        self.size = 0

    def add(self, name: str, data: bytes) -> None:
        self.map.append((name, len(self.frames), len(self.open), len(data)))
        self.open += data
        if len(self.open) >= self.frame_bytes:
            self._close()

    def _close(self) -> None:
        if self.open:
            self.frames.append(self.pack(bytes(self.open)))
            self.sizes.append((len(self.frames[-1]), len(self.open)))
            self.size += len(self.frames[-1])
            self.open = bytearray()

    def finish(self) -> bytes:
        self._close()
        entries = b"".join(name.encode() + b"\n" + struct.pack("<III", *place) for name, *place in self.map)
        known = struct.pack("<II", SKIPPABLE, len(entries)) + entries
        sizes = [*self.sizes, (len(known), 0)]
        table = b"".join(struct.pack("<II", *s) for s in sizes)
        footer = struct.pack("<IB", len(sizes), 0)
        head = struct.pack("<II", SEEK_FRAME, len(table) + len(footer) + len(SEEK_MAGIC))
        return b"".join(self.frames) + known + head + table + footer


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of every frame, from the footer alone."""
    count, _, magic = struct.unpack("<IB4s", data[-9:])
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table at the end")
    at, out = 0, []
    table = data[-9 - 8 * count : -9]
    for i in range(count):
        packed, plain = struct.unpack_from("<II", table, 8 * i)
        out.append((at, packed, plain))
        at += packed
    return out


def record_map(data: bytes) -> list[tuple[str, int, int, int]]:
    """(record id, frame, offset in the frame's content, length) of every record, without unpacking a frame."""
    start, size, _ = seek_table(data)[-1]
    at, end, out = start + 8, start + size, []
    while at < end:
        stop = data.index(b"\n", at)
        out.append((data[at:stop].decode(), *struct.unpack_from("<III", data, stop + 1)))
        at = stop + 13
    return out


def bundles(pages: DataFrame, least_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """One row per bundle, ``value``: its bytes without the last four."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    groups = (
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy("sha")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select("sha", "first")
    )
    joined = rows.join(groups, "sha", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = lambda b: pa.RecordBatch.from_arrays([pa.array([b.finish()], pa.binary())], names=["value"])
        bundle = Bundle(frame_bytes)
        for batch in batches:
            for page, url, sha, data, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "sha", "payload", "refers"))):
                bundle.add(*record(page, url, data, base64.b32encode(bytes.fromhex(sha)).decode(), refers_to))
                if bundle.size >= bundle_bytes:
                    yield out(bundle)
                    bundle = Bundle(frame_bytes)
        if bundle.map:
            yield out(bundle)

    return joined.select("page_id", "url", "sha", "payload", refers.alias("refers")).mapInArrow(run, "value binary")


def write(rows: DataFrame, folder: str) -> None:
    """A file for each bundle; ``folder`` must not exist."""
    rows.select(F.col("value").cast("string").alias("value")).write.options(
        lineSep=SEEK_MAGIC.decode("latin-1"), encoding="ISO-8859-1", maxRecordsPerFile="1"
    ).text(folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).where(F.col("length") > 0).select("path", "content")


def read(spark: SparkSession, folder: str, wanted: DataFrame | None = None) -> DataFrame:
    """The records of all bundles, each taken from its frame by the record map; or only those of the ids in
    ``wanted`` (a column record_id), for which only frames that hold one of them are unpacked."""
    files = _files(spark, folder).withColumn("ids", F.lit(None).cast("array<string>"))
    if wanted is not None:
        places = record_index(spark, folder).join(wanted.select("record_id").distinct(), "record_id", "left_semi")
        asked = places.groupBy(F.col("bundle").alias("path")).agg(F.collect_set("record_id").alias("ids"))
        files = files.drop("ids").join(asked, "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        names = [f.split()[0] for f in READ.split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "int": pa.int32()}
        types = [kinds[f.split()[1]] for f in READ.split(", ")]
        for batch in batches:
            for path, data, ids in zip(*(batch.column(c) for c in ("path", "content", "ids"))):
                data, only = data.as_py(), None if ids.as_py() is None else set(ids.as_py())
                table = seek_table(data)
                rows, size, held, plain = [], 0, -1, b""
                for name, frame, offset, length in record_map(data):
                    if only is not None and name not in only:
                        continue
                    if frame != held:
                        start, packed, _ = table[frame]
                        held, plain = frame, unpack(data[start : start + packed])
                    found = parse(plain[offset : offset + length])
                    rows.append([*found.values(), path.as_py(), frame, offset, length])
                    size += length
                    if size >= BUNDLE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return files.select("path", "content", "ids").mapInArrow(run, READ)


def record_index(spark: SparkSession, folder: str) -> DataFrame:
    """record_id, bundle, frame, offset in the frame's content, length: from footers alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path"), batch.column("content")):
                rows = [(name, path.as_py(), *place) for name, *place in record_map(data.as_py())]
                kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["record_id", "bundle", "frame", "offset", "length"]
                )

    return _files(spark, folder).mapInArrow(run, MAP)
