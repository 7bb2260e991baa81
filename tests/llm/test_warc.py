import base64
import hashlib
import io
import struct

import pytest
import zstandard
from pyarrow import fs

from pricelens.llm import warc

PAGES = [(1, "http://a/", "same", 0), (2, "http://b/\r\nX: y", "same", 0), (3, None, "same", 0), (4, "u", None, 0), (5, "u", "", 0),
         (6, "ü", "é" * 700_000, 0), (7, "u", "one", 0), (None, "u", "one", 0), (8, "http://c/", "WARC/1.1\r\n\r\n", 0),
         (3, None, "same", 0), (3, "x", "other", 0)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string, refers_to int")


def expected(min_bytes=0):
    out = []
    for page_id, _, html, _ in PAGES:
        body = (html or "").encode()
        ids = [p for p, _, h, _ in PAGES if (h or "") == (html or "") and p is not None]
        head = max(ids) if ids else None
        revisit = page_id is not None and len(body) >= min_bytes and page_id < head
        out.append((page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if revisit else "response", head if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 2])
def test_round_trip(pages, min_bytes):
    got = warc.round_trip(pages, min_revisit_bytes=min_bytes, frame_bytes=1000, bundle_bytes=2000)
    rows = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, rows), key=str) == expected(min_bytes)


def test_any_reader_and_single_records(spark, pages):
    folder, index = warc.write(pages.where("page_id < 9"), frame_bytes=50, bundle_bytes=10_000_000)
    filesystem, path = fs.FileSystem.from_uri(folder)
    bundles = {r["bundle"] for r in index.collect()}
    total = 0
    for bundle in bundles:
        with filesystem.open_input_file(f"{path}/{bundle}") as f:
            raw = f.read()
        data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        at = 0
        while at < len(data):
            _, _, at = warc.parse(data, at)
            total += 1
        n, flags, magic = struct.unpack("<IBI", raw[-9:])
        assert (flags, magic) == (0x80, 0x8F92EAB1) and n >= 1
        assert struct.unpack("<II", raw[-17 - 12 * n : -9 - 12 * n]) == (0x184D2A5E, 12 * n + 9)
    assert total == 10
    for row in index.collect():
        (headers, block), = warc.fetch(folder, [(row["bundle"], row["frame"], row["offset"], row["length"])])
        assert headers["WARC-Record-ID"] == f"<{row['record_id']}>"
        if row["page_id"] == 7:
            assert block.endswith(b"\r\n\r\none")


def test_damage_is_noticed(pages):
    folder, index = warc.write(pages)
    filesystem, path = fs.FileSystem.from_uri(folder)
    row = index.where("page_id = 6").first()
    with filesystem.open_input_file(f"{path}/{row['bundle']}") as f:
        raw = bytearray(f.read())
    raw[-12] ^= 1  # in the last checksum
    with filesystem.open_output_stream(f"{path}/bad") as f:
        f.write(bytes(raw))
    with filesystem.open_input_file(f"{path}/bad") as f:
        reader = warc.BundleReader(f)
        with pytest.raises(ValueError, match="checksum"):
            reader.frame(len(reader.frames) - 1)


def test_empty(spark, pages):
    assert warc.round_trip(pages.limit(0)).collect() == []
