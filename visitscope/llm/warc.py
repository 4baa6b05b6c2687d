"""Operator 7: dictionary-compressed WARC archives.

Each task packs its pages into archives of about `ARCHIVE_BYTES` of payload.
An archive trains a Zstandard dictionary on its own records, carries it in a
leading skippable frame and compresses every record as a frame of its own,
so one record can be read with the dictionary and its offset alone.

Archives are rows of a table (archive, records, content), which Spark's
writers commit in any store; `export` copies them to `.warc.zst` files.

Defined results: null html is the empty payload, null url leaves the target
header out; of rows with equal payloads those with the smallest non-null id
are responses (all of them, should a row repeat) and the others, null ids
included, revisit it; where all ids are null all are responses. Other columns
of the input are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, staged, text_or_empty

ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3

# Fixed values of the WARC/1.1 format and its Zstandard profile.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"

ARCHIVE_SCHEMA = "archive string, records long, content binary"
RECORD_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
                 "refers_to long, payload binary")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One uncompressed WARC record."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
             f"WARC-Date: {NO_DATE}"]
    if url is not None:
        target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {target}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def pack(records: list[bytes]) -> bytes:
    """An archive: dictionary frame, then a compressed frame for each record."""
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, records, k=256, d=8)
    except zstandard.ZstdError:  # too few or too short records to learn from
        trained = None
    head = b""
    if trained is not None:
        data = trained.as_bytes()
        head = struct.pack("<II", DICTIONARY_FRAME, len(data)) + data
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    return head + b"".join(compressor.compress(r) for r in records)


def unpack(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, decompressed one by one."""
    at, dictionary = 0, None
    if len(archive) >= 8 and struct.unpack_from("<I", archive)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", archive, 4)[0]
        dictionary = zstandard.ZstdCompressionDict(archive[8:8 + size])
        at = 8 + size
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    rest = memoryview(archive)[at:]
    while rest:
        reader = decompressor.decompressobj()
        record = reader.decompress(rest)
        yield record
        rest = rest[len(rest) - len(reader.unused_data):]


def parse(record: bytes) -> dict:
    """Fields of one record; the payload is None for a revisit."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")

    def page(name: str) -> int | None:
        number = fields.get(name, "")[len("<urn:page:"):-1]
        return int(number) if number else None

    return {"page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To"),
            "payload": None if revisit else payload}


def mark_revisits(pages: DataFrame, revisit_from_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """(page_id, url, html, refers_to, revisit): which pages repeat the payload of another."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        text_or_empty(html_col).alias("html")).withColumn("digest", F.sha1("html"))
    # Only payloads that occur again; mostly few, and then the join needs no shuffle of the pages.
    again = staged(rows.where(F.octet_length("html") >= revisit_from_bytes).groupBy("digest")
                   .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1 and first is not null").select("digest", "first"), "warc-again")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (rows.join(again, "digest", "left")
            .select("page_id", "url", "html", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit")))


def write_archives(marked: DataFrame) -> DataFrame:
    """(archive, records, content) of pages marked by `mark_revisits`."""
    small_batches(marked.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, records, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([f"pages-{part:06d}-{number:05d}"]), pa.array([len(records)], pa.int64()),
                 pa.array([pack(records)], pa.binary())], names=["archive", "records", "content"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page_id, url, html, refers_to, revisit = row
                records.append(record_bytes(page_id, url, html.encode(), refers_to, revisit))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    number, records, size = number + 1, [], 0
        if records:
            yield flush()

    return marked.mapInArrow(run, ARCHIVE_SCHEMA)


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of archives, each payload checked against its digest."""
    small_batches(archives.sparkSession)
    kept = T._parse_datatype_string(RECORD_SCHEMA).fields
    schema = T.StructType(kept if with_payload else kept[:-1])
    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                       ("payload", pa.binary())][:len(schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for record in unpack(content.as_buffer().to_pybytes()):
                    row = parse(record)
                    if not with_payload:
                        del row["payload"]
                    rows.append(row)
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return archives.select("content").mapInArrow(run, schema)


def export(archives: DataFrame, folder: str) -> DataFrame:
    """Write each archive to `folder` (a URI that all executors reach) as `<archive>.warc.zst`; (path, records)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for batch in batches:
            paths = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                path = f"{base}/{name}.warc.zst"
                attempt = f"{path}.{TaskContext.get().taskAttemptId()}"
                with store.open_output_stream(attempt) as f:
                    f.write(content.as_buffer())
                store.move(attempt, path)
                paths.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(paths), batch.column(1)], names=["path", "records"])

    return archives.mapInArrow(run, "path string, records long")


def archive_pages(pages: DataFrame, revisit_from_bytes: int = 0) -> DataFrame:
    """Archives of all pages, as a table in the shared folder."""
    return staged(write_archives(mark_revisits(pages, revisit_from_bytes)), "warc-archives")
