"""WARC archives: written as one gzip stream a file, normalised to a member per record.

A page becomes a response record; a page whose payload, of at least ``LEAST`` bytes, a
smaller page_id already has becomes a revisit that refers to it. An archive is first
written as a single gzip stream. The normaliser inflates such a stream once, a MiB at a
time, and writes each record as a gzip member of its own next to a sidecar index of
(offset, length, record id), through which single records are read back.

Nulls, empty texts, ties: a null html is an empty payload. Rows that repeat a page_id with
one payload are all responses. A page without an id is a response nothing refers to. An
empty table makes no files. Other columns are not looked at.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin, scratch_path
from .common import pieces
from .files import create, locate, open_file

LEAST = 100
LEVEL = 4
CHUNK = 1 << 20
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "path string, n bigint"
INDEXED = "path string, index string, n bigint"


def record(page_id: int | None, url: str | None, html: bytes, refers_to: int | None) -> bytes:
    """One record; a revisit has the payload's length and digest but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n"
    block = http.encode() + (b"" if refers_to is not None else html)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', url or '')}",
        f"WARC-Payload-Digest: sha256:{sha256(html).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head.insert(6, f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.insert(6, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_head(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def inflate(stream) -> Iterator[bytes]:
    """The content of a gzip file of one or many members, in order."""
    inflater = zlib.decompressobj(31)
    while data := stream.read(CHUNK):
        while data:
            out = inflater.decompress(data, CHUNK)
            if out:
                yield out
            data = inflater.unconsumed_tail
            if inflater.eof:
                data, inflater = inflater.unused_data, zlib.decompressobj(31)
    if rest := inflater.flush():
        yield rest


def normalise(source, out) -> Iterator[tuple[int, int, str]]:
    """Rewrite each record as its own member; yields (offset, length, record id).

    A record passes through in parts, so its size does not matter.
    """
    parts, buffer, at = inflate(source), b"", 0
    while True:
        while b"\r\n\r\n" not in buffer:
            part = next(parts, None)
            if part is None:
                if buffer.strip():
                    raise ValueError("the archive ends inside a record")
                return
            buffer += part
        head, _, buffer = buffer.partition(b"\r\n\r\n")
        fields = parse_head(head)
        left = int(fields["content-length"]) + 4
        member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        size = out.write(member.compress(head + b"\r\n\r\n")) or 0
        start = at
        while left:
            if not buffer:
                buffer = next(parts, b"")
                if not buffer:
                    raise ValueError("the archive ends inside a record")
            taken, buffer = buffer[:left], buffer[left:]
            left -= len(taken)
            size += out.write(member.compress(taken)) or 0
        size += out.write(member.flush()) or 0
        at += size
        yield start, size, fields["warc-record-id"]


def page_number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def read_record(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page_id, payload bytes, digest, type, refers_to) of one member; a payload is hashed anew."""
    content = zlib.decompress(data, 31)
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = parse_head(head)
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    size = int(parse_head(http)["content-length"])
    if fields["warc-type"] == "response" and (len(payload) != size or sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    return page_number(fields["warc-record-id"]), size, digest, fields["warc-type"], page_number(fields.get("warc-refers-to"))


def revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Rows ``(page_id, digest, refers_to)`` of pages whose payload a smaller page_id has."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    digests = pages.where("page_id IS NOT NULL").select(
        F.col("page_id").cast("bigint").alias("page_id"), F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("n")
    )
    digests = digests.where(F.col("n") >= least)
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
    known = digests.join(firsts.where("refers_to < last"), "digest").where("page_id > refers_to")
    return known.select("page_id", "digest", "refers_to").distinct()


def write(pages: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Write single-stream archives; rows ``(path, n)``."""

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, n = None, "", 0
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        for batch in pieces(batches, "html"):
            if out is None:
                path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                out = create(path)
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                out.write(packer.compress(record(*row)))
            n += batch.num_rows
        if out is not None:
            out.write(packer.flush())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n])], ["path", "n"])

    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", html.alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    marked = rows.join(revisits(pages, least).hint("merge"), ["page_id", "digest"], "left")
    return pin(marked.select("page_id", "url", "html", "refers_to").mapInArrow(put, MANIFEST), "archives")


def normalised(archives: DataFrame) -> DataFrame:
    """Rewrite every archive; rows ``(path, index, n)``."""

    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                target = f"{path.removesuffix('.warc.gz')}-{uuid.uuid4().hex}.warc.gz"
                index, n = f"{target}.index", 0
                system, place = locate(path)
                with system.open_input_stream(place, compression=None) as source, create(target) as out:
                    with create(index) as side:
                        for offset, length, name in normalise(source, out):
                            side.write(f"{offset}\t{length}\t{name}\n".encode())
                            n += 1
                yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([index]), pa.array([n])], ["path", "index", "n"])

    files = archives.count()
    return pin(archives.repartition(max(files, 1)).mapInArrow(rewrite, INDEXED), "normalised")


def read(archives: DataFrame) -> DataFrame:
    """Rows of all records, each read through the index."""

    def get(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for path, index in zip(batch.column("path").to_pylist(), batch.column("index").to_pylist(), strict=True):
                system, place = locate(index)
                with open_file(path) as file, system.open_input_stream(place, compression=None) as side:
                    entries = [line.split("\t") for line in side.read().decode().splitlines()]
                    for at in range(0, len(entries), 1000):
                        rows = [read_record(file.read_at(int(n), int(o))) for o, n, _ in entries[at : at + 1000]]
                        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                        yield pa.RecordBatch.from_arrays(columns, names)

    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return archives.repartition(max(archives.count(), 1)).mapInArrow(get, schema)


def archived(pages: DataFrame, folder: str | None = None, least: int = LEAST) -> DataFrame:
    """Write, normalise and read back all pages."""
    return read(normalised(write(pages, folder or scratch_path(pages.sparkSession, "warc"), least)))


SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
           FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= {LEAST} GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
