import base64
import hashlib
import struct

import zstandard
from llm_helpers import by_value

from visitscope.llm import warc as W

PAGES = "page_id long, url string, html string, digest int, revisit string"


def b32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_archive_layout():
    records = [W.record_bytes(k, f"http://x/{k}", (f"<p>page {k} some common words of all pages</p>" * 20).encode(), None, False)
               for k in range(60)]
    archive = W.pack(records)
    magic, size = struct.unpack_from("<II", archive)
    assert magic == 0x184D2A5D
    dictionary = zstandard.ZstdCompressionDict(archive[8:8 + size])
    assert dictionary.dict_id()
    assert list(W.unpack(archive)) == records
    # Every record is a frame of its own: the second is read without the first.
    frames = archive[8 + size:]
    first = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
    first.decompress(frames)
    assert zstandard.ZstdDecompressor(dict_data=dictionary).decompress(first.unused_data, max_output_size=1 << 20) == records[1]


def test_few_records_have_no_dictionary():
    records = [W.record_bytes(1, None, b"", None, False)]
    assert list(W.unpack(W.pack(records))) == records
    assert list(W.unpack(b"")) == []


def test_round_trip_and_revisits(spark, monkeypatch):
    monkeypatch.setattr(W, "ARCHIVE_BYTES", 4000)
    body = "<html>é " + "word " * 300
    rows = [(5, "http://a b\r\n", body), (3, "u", body), (9, None, body), (None, "n", body), (4, "u", None), (6, "u", ""),
            (7, "u", "<p>own</p>"), (7, "u", "<p>own</p>"), (None, None, "lonely"), (None, None, "lonely"), (8, "", "x" * 30000)]
    pages = spark.createDataFrame([(i, u, h, 1, "r") for i, u, h in rows], PAGES).repartition(2)
    archives = W.archive_pages(pages)
    back = W.read_archives(archives).collect()
    want = []
    for i, _, h in rows:
        payload = (h or "").encode()
        first = min((j for j, _, g in rows if (g or "") == (h or "") and j is not None), default=None)
        response = first is None or i == first
        want.append((i, len(payload), b32(payload), "response" if response else "revisit", None if response else first))
    assert by_value((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back) == by_value(want)
    for r in back:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            assert b32(bytes(r.payload)) == r.payload_digest
    assert {r.url for r in back if r.page_id == 5} == {"http://a%20b%0D%0A"}


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "aa", 1, ""), (2, "u", "aa", 1, ""), (3, "u", "b" * 50, 1, ""), (4, "u", "b" * 50, 1, "")], PAGES)
    found = {r.page_id: r.record_type for r in W.read_archives(W.archive_pages(pages, revisit_from_bytes=10)).collect()}
    assert found == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table_and_export(spark, tmp_path):
    assert W.read_archives(W.archive_pages(spark.createDataFrame([], PAGES))).count() == 0
    pages = spark.createDataFrame([(k, "u", f"<p>{k}</p>", 1, "") for k in range(20)], PAGES).repartition(2)
    files = W.export(W.archive_pages(pages), f"file://{tmp_path}").collect()
    assert sum(r.records for r in files) == 20
    assert sum(len(list(W.unpack(open(r.path, "rb").read()))) for r in files) == 20
