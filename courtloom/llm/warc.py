"""WARC archives with an index: write records, then read chosen ones back by sorted, coalesced byte ranges.

Every task writes archive files of its own under a fresh name and hands on one index row per record; the index is a
written table, so it only names files of tasks that ended well and a task that is run again leaves no trace in it.
Records are gzip members, each readable by itself from its offset and length.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtloom.llm.common import byte_batches
from courtloom.session import durable, work_path

FILE_BYTES = 256 << 20
READ_BYTES = 4 << 20
GAP_BYTES = 64 << 10
DATE = "2024-01-01T00:00:00Z"
INDEX_SCHEMA = "page_id long, url string, digest string, record_type string, file string, offset long, length long"
RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"


def uri(page: int | None) -> bytes:
    return b"<urn:x-page:%s>" % (b"" if page is None else str(page).encode())


def page_of(value: str) -> int | None:
    number = value.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, digest: str) -> bytes:
    """One WARC/1.1 record: a response with the payload, or a revisit that only names it."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "").encode()
    lines = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"revisit" if revisit else b"response"),
        b"WARC-Record-ID: " + uri(page),
        b"WARC-Date: " + DATE.encode(),
        b"WARC-Target-URI: " + target,
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    if revisit:
        lines += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: " + uri(refers_to)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one record."""
    top, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in top.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def filesystem(folder: str):
    """A file system that tasks can write to, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{re.sub('^file:', '', folder)}")


def decide(pages: DataFrame, least: int = 0) -> DataFrame:
    """Add digest, refers_to and revisit to pages.

    Of equal payloads of at least `least` bytes the one with the largest page_id is stored, the others revisit it.
    Only digests that occur twice are joined, and an adaptive plan splits a digest that many pages share.  Rows that
    repeat a page_id with its payload are all responses; rows without page_id count below any other.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long"), "url", F.col("html").cast("string"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n"))
    keys = rows.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies"), F.first("n").alias("size"))
    shared = keys.where((F.col("copies") > 1) & (F.col("size") >= least) & F.col("keeper").isNotNull()).select("digest", "keeper")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return rows.join(shared, "digest", "left").select("page_id", "url", "html", "digest", F.when(revisit, F.col("keeper")).alias("refers_to"), revisit.alias("revisit"))


def write(decided: DataFrame, folder: str) -> DataFrame:
    """Write the archives under `folder` and return their index."""
    byte_batches(decided.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for page, url, html, digest, refers_to, revisit in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                spelled = base64.b32encode(bytes.fromhex(digest)).decode()
                data = gzip_member(record(page, url, (html or "").encode(), refers_to, revisit, spelled))
                out.write(data)
                rows.append((page, url, spelled, "revisit" if revisit else "response", name, at, len(data)))
                at += len(data)
            yield arrow(rows, INDEX)
        if out is not None:
            out.close()

    return decided.mapInArrow(run, INDEX_SCHEMA)


INDEX = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_())])


def arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def coalesced(ranges: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Merge ranges sorted by file and offset into reads of about `READ_BYTES` that skip no gap over `GAP_BYTES`."""
    held: list[tuple[int, int]] = []
    file, start, end = "", 0, 0
    for name, offset, length in ranges:
        if held and (name != file or offset - end > GAP_BYTES or offset + length - start > READ_BYTES):
            yield file, start, end, held
            held = []
        if not held:
            file, start = name, offset
        held.append((offset, length))
        end = offset + length
    if held:
        yield file, start, end, held


def read(selected: DataFrame, folder: str) -> DataFrame:
    """Read the records of the index rows `selected` and check each stored payload against its digest."""
    # Sorted by place, so that each task reads its stretch of the archives front to back.
    sorted_ = selected.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        for batch in batches:
            for file, start, end, held in coalesced(list(zip(*[c.to_pylist() for c in batch.columns]))):
                with store.open_input_file(f"{base}/{file}") as source:
                    data = source.read_at(end - start, start)
                rows = []
                for offset, length in held:
                    headers, http, payload = parse(zlib.decompress(data[offset - start : offset - start + length], 31))
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = headers["WARC-Type"]
                    refers = headers.get("WARC-Refers-To")
                    intact = kind == "revisit" or base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest
                    rows.append((page_of(headers["WARC-Record-ID"]), int(http["Content-Length"]), digest, kind, page_of(refers) if refers else None, intact))
                yield arrow(rows, RECORD)

    return sorted_.mapInArrow(run, RECORD_SCHEMA)


def archive(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write pages as archives under `folder` and return the written index."""
    return durable(write(decide(pages, least), folder), "warc-index")


def op5_index_first(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Round trip of all pages: page_id, payload_bytes, payload_digest, record_type, refers_to, intact.

    A null html is an empty payload, which counts as equal to other empty ones.  A null url is written empty; blanks
    and control characters in it are percent-encoded.  Other columns are not looked at.
    """
    folder = work_path(spark, "warc")
    return read(archive(pages, folder), folder)
