"""WARC archives: one gzip member per record, read back one record at a time.

A record is a block of `name: value` header lines, an empty line, exactly Content-Length
bytes, and two line ends; each record is compressed as a gzip member of its own, so any
record can be read alone and a broken one does not spoil the others' framing. The reader
feeds a file to an incremental zlib decoder in small pieces, takes the length from the
header, and compares both digests with the bytes. It never holds more than one record.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.llm.words import encoded, posix_path
from hearthlake.session import Staging, work_dir

#: Payloads below this are always written out.
LEAST_SHARED = 1000
PIECE = 1 << 18
#: Rows per Arrow batch come in tens of thousands; results leave in batches of this size.
ROWS_OUT = 2048

# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"

_LENGTH = re.compile(rb"^[0-9]+$")


def digest(data: bytes) -> str:
    """`sha1:` and Base32, as archives write it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def bare(labelled: str) -> str:
    """Lower-case hex of a labelled digest."""
    return base64.b32decode(labelled.removeprefix("sha1:")).hex()


def record_id(page_id: int | None, place: str) -> str:
    """The page's URN, or one of its own for a page without id."""
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place)}>"


def page_of(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", name or "")
    return int(found[1]) if found else None


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, place: str) -> bytes:
    """A response record, or a revisit of page ``refers_to`` without the payload."""
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(len(payload)).encode() + b"\r\n\r\n"
    )
    block = http if refers_to is not None else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "urn:unknown")
    headers = [
        ("WARC-Type", "revisit" if refers_to is not None else "response"),
        ("WARC-Record-ID", record_id(page_id, place)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri.encode("utf-8", "replace").decode()),
        ("WARC-Payload-Digest", digest(payload)),
        ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, ""))]
    return member(headers, block)


def members(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The content of each gzip member, one after the other."""
    decoder, parts = zlib.decompressobj(31), []
    started = False
    for piece in pieces:
        while piece:
            started = True
            parts.append(decoder.decompress(piece))
            piece = decoder.unused_data
            if decoder.eof:
                yield b"".join(parts)
                decoder, parts, started = zlib.decompressobj(31), [], False
            else:
                piece = b""
    if started:
        raise ValueError("the archive ends within a record")


def parse_record(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block; a broken frame or digest raises."""
    head, found, rest = content.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/"):
        raise ValueError("no record header")
    headers = {k.strip().lower().decode(): v.strip().decode() for k, _, v in (line.partition(b":") for line in lines[1:])}
    length = headers.get("content-length", "").encode()
    if not _LENGTH.match(length) or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("the block is not as long as its header says")
    block = rest[:-4]
    if "warc-block-digest" in headers and digest(block) != headers["warc-block-digest"]:
        raise ValueError("the block does not have its digest")
    return headers, block


def read_page(content: bytes) -> dict:
    """What a page record says, with the payload's digest verified for a response."""
    headers, block = parse_record(content)
    http, _, payload = block.partition(b"\r\n\r\n")
    said = int(re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", http)[1])
    response = headers["warc-type"] == "response"
    if response and (len(payload) != said or digest(payload) != headers["warc-payload-digest"]):
        raise ValueError("the payload does not have its length or digest")
    return {
        "page_id": page_of(headers["warc-record-id"]),
        "payload_bytes": said,
        "payload_digest": bare(headers["warc-payload-digest"]),
        "record_type": headers["warc-type"],
        "refers_to": page_of(headers.get("warc-refers-to")),
        "url": headers["warc-target-uri"],
        "payload": payload if response else None,
    }


def pieces_of(path: str) -> Iterator[bytes]:
    with open(path, "rb") as file:
        while piece := file.read(PIECE):
            yield piece


def with_record_type(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with ``refers_to``: the response's page_id for a revisit, else NULL.

    Of equal payloads of at least ``LEAST_SHARED`` bytes the largest page_id is the
    response; a repeated row of that page is written out again. Pages without an id are
    below all others; where no page of a payload has one, all are written out. Only
    payloads that occur more than once are joined, by digest; the join side has one row
    per payload, and a payload shared by very many pages is split at run time.
    """
    payload: Column = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    keyed = pages.select("page_id", "url", "html", F.octet_length(payload).alias("_bytes"), F.sha1(payload).alias("_sha"))
    shared = (
        keyed.filter(F.col("_bytes") >= LEAST_SHARED)
        .groupBy("_sha", "_bytes")
        .agg(F.max("page_id").alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1 and _first is not null")
        .select(F.col("_sha").alias("_same"), "_first")
    )
    joined = keyed.join(shared, (keyed["_sha"] == shared["_same"]) & (keyed["_bytes"] >= LEAST_SHARED), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return joined.select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(typed: DataFrame, folder: str) -> DataFrame:
    """One archive per partition in ``folder``; a row (path, records) for each.

    The name is that of the partition and the file is moved into place when complete, so a
    task that is run again replaces its own file. Bounded memory: records are compressed
    and written one by one.
    """
    root = posix_path(folder)

    def write(batches):
        place = f"{root}/part-{TaskContext.get().partitionId():06d}"
        os.makedirs(root, exist_ok=True)
        own, count = f"{place}.{uuid.uuid4().hex}.tmp", 0
        with open(own, "wb") as file:
            for batch in batches:
                for page_id, url, html, refers_to in zip(*[batch.column(c).to_pylist() for c in range(4)], strict=True):
                    file.write(page_record(page_id, url, encoded(html), refers_to, f"{place}/{count}"))
                    count += 1
        os.replace(own, f"{place}.warc.gz")
        yield pa.RecordBatch.from_pydict({"path": [f"{place}.warc.gz"], "records": pa.array([count], pa.int64())})

    return typed.select("page_id", "url", "html", "refers_to").mapInArrow(write, "path string, records bigint")


RECORD = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
    ]
)


def read_archives(paths: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row per record of the archives in column ``path``; with ``with_payload`` also url and the payload.

    Archives are dealt to tasks one by one and read front to back. A broken frame or digest fails the job.
    """
    schema = T.StructType(RECORD.fields + ([T.StructField("url", T.StringType()), T.StructField("payload", T.BinaryType())] if with_payload else []))
    kinds = pa.schema([(f.name, {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in schema.fields])
    most = 16 if with_payload else ROWS_OUT

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for content in members(pieces_of(path)):
                    rows.append(read_page(content))
                    if len(rows) == most:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kinds)

    return paths.select("path").mapInArrow(read, schema)


def archive_round_trip(staging: Staging, pages: DataFrame) -> DataFrame:
    """Writes every page (page_id, url, html; any may be null, html then empty) and reads all back.

    Returns page_id, payload_bytes, payload_digest, record_type and refers_to per page, as
    the archives have them. An empty table gives no row.
    """
    written = staging.keep(write_archives(with_record_type(pages), work_dir(staging.spark, "warc")), "archives")
    spread = max(1, staging.spark.sparkContext.defaultParallelism * 2)
    return read_archives(written.filter("records > 0").repartition(spread))


SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), s AS (
  SELECT payload_digest, max(page_id) AS first_id FROM p WHERE payload_bytes >= 1000 GROUP BY ALL
)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN s ON p.payload_digest = s.payload_digest AND payload_bytes >= 1000
"""
