import base64
import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from cartwheel.llm import warc


@pytest.fixture
def pages(spark):
    rows = [
        (3, "http://a/3", "<p>same</p>", "x"),
        (1, "http://a/1", "<p>same</p>", "x"),
        (2, "http://a/2\r\nWARC-Type: fake", "été 日本", "x"),
        (4, None, None, "x"),
        (5, "u", "", "x"),
        (6, "u", "line\r\n\r\nbreaks\r\n", "x"),
        (6, "u", "line\r\n\r\nbreaks\r\n", "x"),
        (None, "u", "<p>same</p>", "x"),
        (None, "u", "only without id", "x"),
        (7, "u", "long " * 200_000, "x"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string")


def brute(rows):
    first = {}
    for r in rows:
        p = (r.html or "").encode()
        if r.page_id is not None:
            first[p] = min(first.get(p, r.page_id), r.page_id)
    out = []
    for r in rows:
        p = (r.html or "").encode()
        to = first.get(p)
        revisit = to is not None and r.page_id != to
        out.append(
            (
                r.page_id,
                len(p),
                base64.b32encode(hashlib.sha1(p).digest()).decode(),
                "revisit" if revisit else "response",
                to if revisit else None,
            )
        )
    return sorted(out, key=str)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_round_trip(spark, pages, monkeypatch, limit):
    monkeypatch.setattr(warc, "BROADCAST_PAYLOADS", limit)
    index = warc.write(pages, warc.archive_folder(spark))
    records = warc.read(index).cache()
    assert sorted(map(tuple, records.select(COLUMNS).collect()), key=str) == brute(pages.collect())
    got = {r.page_id: r for r in records.where("page_id is not null").collect()}
    assert got[2].payload.decode() == "été 日本" and got[2].url == "http://a/2%0D%0AWARC-Type:%20fake"
    assert got[4].url is None and got[6].payload == b"line\r\n\r\nbreaks\r\n" and got[3].payload is None
    assert len(got[7].payload) == 1_000_000


def test_small_payloads_can_stay_responses(spark, pages):
    index = warc.write(pages, warc.archive_folder(spark), min_revisit_bytes=5)
    kinds = {(r.page_id, r.record_type) for r in warc.read(index).collect()}
    assert (5, "response") in kinds and (3, "revisit") in kinds


def test_random_access_and_format(spark, pages):
    index = warc.write(pages.coalesce(1), warc.archive_folder(spark))
    rows = index.orderBy("bundle", "frame", "start").collect()
    one = warc.read(index.where("page_id = 2")).collect()
    assert len(one) == 1 and one[0].record_id == rows[[r.page_id for r in rows].index(2)].record_id
    fs, path = warc.filesystem(rows[0].bundle)
    data = fs.open_input_file(path).read()
    frames, flags, magic = struct.unpack("<IBI", data[-9:])
    assert magic == 0x8F92EAB1 and flags == 0 and frames == max(r.frame for r in rows) + 1
    table = data[-9 - 8 * frames : -9]
    at, whole = 0, b""
    for i in range(frames):
        packed, size = struct.unpack_from("<II", table, 8 * i)
        frame = zstandard.ZstdDecompressor().decompress(data[at : at + packed])
        assert len(frame) == size
        whole, at = whole + frame, at + packed
    assert struct.unpack_from("<II", data, at) == (0x184D2A5E, len(data) - at - 8)
    # plain decompression of the file gives all records one after the other
    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == whole
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows)


def test_damaged_payload_is_noticed():
    _, record = warc.encode_record(1, "u", b"payload", None, False)
    assert warc.decode_record(record)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.decode_record(record.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"))


def test_empty_table(spark, pages):
    index = warc.write(pages.where(F.lit(False)), warc.archive_folder(spark))
    assert index.count() == 0 and warc.read(index).count() == 0
