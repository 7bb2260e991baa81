"""Seekable Zstandard bundles of WARC records.

A bundle is a file of independent Zstandard frames, each holding some whole records,
then a seek table in a skippable frame (the public seekable format: sizes and checksum
of every frame, footer last). So any reader of .warc.zst files can read it from the
start, and one that knows a record's place reads one frame. The index table maps a
record to bundle, frame, offset in the frame's decompressed bytes and length; it is
written by Spark's committer and names the bundles that count: what a lost task has
left behind is in no index and is never read.

Bundles go to any folder that Spark and pyarrow can write (file, hdfs, s3, ...).

Records: ``response`` holds the payload behind a small HTTP header; of records with
equal payloads of at least ``min_revisit_bytes`` the one with the largest page_id does,
the others are ``revisit`` records that refer to it and carry its digest and length.

Defined results: null html is an empty payload; a null url has no target URI; a record
with a null page_id is always a response and never referred to; rows that repeat the
largest page_id of a payload are all responses. An empty table has no bundle. Line ends
in an url are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored

FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 20, 1 << 28, 3
DATE = "1970-01-01T00:00:00Z"
#: Fixed values of the public formats.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id long, record_id string, bundle string, frame int, offset long, length long"
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, record_id string, bundle string, frame int, offset long, length long")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}:{digest}"


def _page_of(rid: str) -> int | None:
    page = rid.split(":")[2]
    return None if page == "none" else int(page)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> tuple[str, bytes]:
    """(record id, WARC record)."""
    digest = payload_digest(payload)
    rid = record_id(page_id, digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{rid}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{record_id(refers_to, digest)}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(body)}", "", ""]
    return rid, "\r\n".join(head).encode() + body + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record that begins at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"no WARC record at {at}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    start, n = end + 4, int(headers["Content-Length"])
    if data[start + n : start + n + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} isn't closed")
    return headers, data[start : start + n], start + n + 4


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


class BundleWriter:
    """Writes one bundle, a frame at a time."""

    def __init__(self, stream, level: int = LEVEL):
        import zstandard

        self.stream, self.table, self.size = stream, [], 0
        self.zstd = zstandard.ZstdCompressor(level=level, write_content_size=True)

    def frame(self, data: bytes) -> int:
        from xxhash import xxh64_intdigest

        packed = self.zstd.compress(data)
        self.stream.write(packed)
        self.table.append((len(packed), len(data), xxh64_intdigest(data) & 0xFFFFFFFF))
        self.size += len(packed)
        return len(self.table) - 1

    def close(self) -> None:
        body = b"".join(struct.pack("<III", *e) for e in self.table)
        body += struct.pack("<IBI", len(self.table), CHECKSUMS, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.stream.close()


class BundleReader:
    """Reads any frame of a bundle by its seek table."""

    def __init__(self, file):
        import zstandard

        self.file, self.zstd = file, zstandard.ZstdDecompressor()
        size = file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        entry = 12 if flags & CHECKSUMS else 8
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        raw = self._at(size - 9 - n * entry, n * entry)
        self.frames, at = [], 0
        for k in range(n):
            packed, plain, *check = struct.unpack_from("<III" if entry == 12 else "<II", raw, k * entry)
            self.frames.append((at, packed, plain, check[0] if check else None))
            at += packed

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(n)

    def frame(self, k: int) -> bytes:
        from xxhash import xxh64_intdigest

        at, packed, plain, check = self.frames[k]
        data = self.zstd.decompress(self._at(at, packed), max_output_size=plain)
        if check is not None and check != xxh64_intdigest(data) & 0xFFFFFFFF:
            raise ValueError(f"frame {k}: wrong checksum")
        return data


def write(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0,
          frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> tuple[str, DataFrame]:
    """Writes a record per row of ``pages`` (page_id, url, html); (folder, index table)."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "bundles")
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        body.alias("body"), F.sha1(body).alias("digest"))
    seen = stored(rows.select("page_id", "digest", F.length("body").alias("n")), "digests")
    heads = (seen.where(f"page_id IS NOT NULL AND n >= {min_revisit_bytes}").groupBy("digest")
             .agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("low")).where("low < refers_to"))
    revisits = stored(seen.join(heads, "digest").where("page_id < refers_to")
                      .select("page_id", "digest", "refers_to").distinct(), "revisits")
    rows = rows.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "body", "refers_to")

    def run(batches):
        yield from _write_partition(batches, folder, frame_bytes, bundle_bytes)

    return folder, stored(rows.mapInArrow(run, INDEX), "record_index")


def _write_partition(batches, folder: str, frame_bytes: int, bundle_bytes: int) -> Iterator:
    """Index rows of the bundles that this task writes; at most a frame and a record are in memory."""
    import pyarrow as pa

    filesystem, path = _filesystem(folder)
    filesystem.create_dir(path, recursive=True)
    writer, name, buffer, places = None, "", bytearray(), []

    def flush() -> pa.RecordBatch:
        frame = writer.frame(bytes(buffer))
        ids, rids, offsets, lengths = zip(*places, strict=True)
        buffer.clear()
        places.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(rids, pa.string()), pa.array([name] * len(ids), pa.string()),
             pa.array([frame] * len(ids), pa.int32()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
            names=["page_id", "record_id", "bundle", "frame", "offset", "length"])

    for batch in batches:
        for page_id, url, body, refers_to in zip(*(batch.column(k) for k in range(4)), strict=True):
            rid, data = record(page_id.as_py(), url.as_py(), body.as_py(), refers_to.as_py())
            if writer is None:
                name = f"{uuid.uuid4().hex}.warc.zst"
                writer = BundleWriter(filesystem.open_output_stream(f"{path}/{name}", compression=None))
            places.append((page_id.as_py(), rid, len(buffer), len(data)))
            buffer += data
            if len(buffer) >= frame_bytes:
                yield flush()
                if writer.size >= bundle_bytes:
                    writer.close()
                    writer = None
    if places:
        yield flush()
    if writer is not None:
        writer.close()


def read(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """All records of the bundles that the index names, decoded frame by frame. A frame is
    a row of work, so reading spreads over tasks whatever the number of bundles."""
    frames = index.select("bundle", "frame").distinct()

    def run(batches):
        yield from _read_frames(batches, folder)

    return frames.sortWithinPartitions("bundle", "frame").mapInArrow(run, RECORD)


def _read_frames(batches, folder: str) -> Iterator:
    import pyarrow as pa

    filesystem, path = _filesystem(folder)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()),
                        ("offset", pa.int64()), ("length", pa.int64())])
    name, reader = None, None
    for batch in batches:
        for bundle, frame in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if bundle != name:
                if reader is not None:
                    reader.file.close()
                name, reader = bundle, BundleReader(filesystem.open_input_file(f"{path}/{bundle}"))
            data, at, rows = reader.frame(frame), 0, []
            while at < len(data):
                headers, block, end = parse(data, at)
                rows.append((*_described(headers, block), bundle, frame, at, end - at))
                at = end
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    if reader is not None:
        reader.file.close()


def _described(headers: dict[str, str], block: bytes) -> tuple:
    rid, kind = headers["WARC-Record-ID"][1:-1], headers["WARC-Type"]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    n = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
    if kind == "response" and (payload_digest(payload) != told or len(payload) != n):
        raise ValueError(f"{rid}: the payload isn't what its digest says")
    refers = headers.get("WARC-Refers-To")
    return (_page_of(rid), headers.get("WARC-Target-URI"), n, told, kind, _page_of(refers[1:-1]) if refers else None, rid)


def fetch(folder: str, places: list[tuple[str, int, int, int]]) -> list[tuple[dict[str, str], bytes]]:
    """Headers and block of single records by their places (bundle, frame, offset, length)."""
    filesystem, path = _filesystem(folder)
    out = []
    for bundle, frame, offset, length in places:
        with filesystem.open_input_file(f"{path}/{bundle}") as file:
            headers, block, _ = parse(BundleReader(file).frame(frame)[offset : offset + length])
            out.append((headers, block))
    return out


def round_trip(pages: DataFrame, **how) -> DataFrame:
    """Writes the archives of ``pages`` and reads them back."""
    folder, index = write(pages, **how)
    return read(pages.sparkSession, folder, index)
