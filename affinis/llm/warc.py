"""WARC archives of pages: whole-file gzip streams, normalised to one member per record with an index.

``archived`` writes each task's records as one gzip stream. ``normalised`` inflates
such a stream once from beginning to end, writes every record again as a gzip member
of its own, and beside the archive a sidecar index of offsets. ``records`` reads
single records by the index. Files lie in a folder that all executors share; their
names are unique to a task's attempt and only the files that a successful task
reports are read, so a lost executor leaves at most files that nobody looks at.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.scratch import Scratch
from affinis.operators.joins import weighted_lookup

LEAST_REVISIT = 100  # bytes of payload from which an equal one is revisited
FILE_BYTES = 256 << 20  # of records in one archive
CHUNK = 1 << 20
LEVEL = 1
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, index string, n_records long"


def record(page_id: int | None, url: str | None, payload: bytes, length: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header with the full length, and no payload."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)


def record_bytes(buffer: bytearray, at: int) -> int | None:
    """Length of the record that begins at ``at``, or None while its end is not in the buffer."""
    gap = buffer.find(b"\r\n\r\n", at)
    if gap < 0:
        return None
    found = re.search(rb"\r\nContent-Length: (\d+)(?=\r\n|$)", bytes(buffer[at:gap]))
    length = gap + 4 - at + int(found[1]) + 4
    return length if at + length <= len(buffer) else None


def parsed(raw: bytes) -> dict:
    """A record's columns; the payload's digest is taken from the bytes of a response."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    named = headers(head)
    block = rest[: int(named["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(headers(http)["Content-Length"])
    response = named["WARC-Type"] == "response"
    digest = hashlib.sha256(payload).hexdigest() if response else named["WARC-Payload-Digest"].removeprefix("sha256:")
    if response and (len(payload) != length or f"sha256:{digest}" != named["WARC-Payload-Digest"]):
        raise ValueError(f"record {named['WARC-Record-ID']} is damaged")
    page, refers = named.get("X-Page-ID"), named.get("X-Refers-To-Page-ID")
    return {
        "page_id": int(page) if page else None, "url": named.get("WARC-Target-URI"), "payload": payload if response else None,
        "payload_bytes": length, "payload_digest": digest, "record_type": named["WARC-Type"], "refers_to": int(refers) if refers else None,
    }


def _opened(folder: str):
    return fs.FileSystem.from_uri(folder)


def _archive(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _opened(folder)
        out, sink, packer, size, count, path = [], None, None, 0, 0, None

        def close():
            sink.write(packer.flush())
            sink.close()
            out.append((path, None, count))

        for batch in batches:
            for page_id, url, html, length, digest, refers_to in zip(
                *(batch.column(c) for c in ("page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to")), strict=True
            ):
                if sink is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    sink, packer, size, count = files.open_output_stream(path, compression=None), zlib.compressobj(LEVEL, wbits=31), 0, 0
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                raw = record(page_id.as_py(), url.as_py(), payload, length.as_py(), digest.as_py(), refers_to.as_py())
                sink.write(packer.compress(raw))
                size, count = size + len(raw), count + 1
                if size >= FILE_BYTES:
                    close()
                    sink = None
        if sink is not None:
            close()
        yield manifest(out)

    return run


def manifest(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(3)], names=["path", "index", "n_records"])


def inflated(source, chunk: int = CHUNK) -> Iterator[bytes]:
    """The contents of a gzip file, whether one stream or several members, in pieces of ``chunk`` bytes at most."""
    unpacker = zlib.decompressobj(31)
    while data := source.read(chunk):
        while data:
            if unpacker.eof:
                unpacker = zlib.decompressobj(31)
            yield unpacker.decompress(data, chunk)
            data = unpacker.unused_data if unpacker.eof else unpacker.unconsumed_tail
    while not unpacker.eof and (piece := unpacker.decompress(b"", chunk)):  # what is inflated but not handed on
        yield piece
    if not unpacker.eof:
        raise ValueError("the gzip stream ends early")


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    buffer = bytearray()
    for piece in pieces:
        buffer += piece
        at = 0
        while at < len(buffer) and (length := record_bytes(buffer, at)) is not None:
            yield bytes(buffer[at : at + length])
            at += length
        del buffer[:at]
    if buffer:
        raise ValueError("the archive ends within a record")


def _normalise(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _opened(folder)
        for batch in batches:
            out = []
            for source in batch.column("path").to_pylist():
                path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                at = count = 0
                with files.open_input_stream(source, compression=None) as stream, files.open_output_stream(path, compression=None) as sink, files.open_output_stream(f"{path}.idx", compression=None) as index:
                    for raw in split_records(inflated(stream)):
                        packer = zlib.compressobj(LEVEL, wbits=31)
                        member = packer.compress(raw) + packer.flush()
                        sink.write(member)
                        page = headers(raw.partition(b"\r\n\r\n")[0]).get("X-Page-ID")
                        index.write(json.dumps([at, len(member), page and int(page)]).encode() + b"\n")
                        at, count = at + len(member), count + 1
                out.append((path, f"{path}.idx", count))
            yield manifest(out)

    return run


def _read(folder: str):
    names = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = _opened(folder)
        for batch in batches:
            for path, index in zip(batch.column("path").to_pylist(), batch.column("index").to_pylist(), strict=True):
                rows, size = [], 0
                with files.open_input_file(path) as archive, files.open_input_stream(index, compression=None) as places:
                    for line in places.read().splitlines():
                        at, length, _ = json.loads(line)
                        archive.seek(at)
                        rows.append(parsed(zlib.decompress(archive.read(length), 31)))
                        size += rows[-1]["payload_bytes"]
                        if size >= 4 * CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema=names)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=names)

    return run


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT, scratch: Scratch | None = None) -> DataFrame:
    """Add payload_bytes, payload_digest and refers_to: the smallest ``page_id`` with an equal payload, where that is another row's.

    Rows of a payload that very many pages have are spread over salts.
    """
    scratch = scratch or Scratch(pages.sparkSession, "revisits")
    payload: Column = F.coalesce("html", F.lit(""))
    full = pages.select("page_id", "url", "html", F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload.cast("binary"), 256).alias("payload_digest"))
    firsts = (
        full.filter(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    again = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first_page")), F.col("first_page"))
    known = weighted_lookup(full, scratch.written(firsts, "firsts"), ["payload_digest"], "n", "page_id", "left")
    return known.withColumn("refers_to", again).drop("first_page", "n")


def archived(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives of ``with_revisits(pages)``, one gzip stream each; returns their manifest."""
    columns = ["page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to"]
    return pages.select(F.col("page_id").cast("long"), *columns[1:-1], F.col("refers_to").cast("long")).mapInArrow(_archive(folder), MANIFEST)


def _dealt(archives: DataFrame) -> DataFrame:
    """A task for each archive: a manifest's rows are tiny, so adaptive execution would join them."""
    return archives.repartitionByRange(max(1, archives.count()), "path")


def normalised(archives: DataFrame, folder: str) -> DataFrame:
    """Write every archive again with a member for each record and a sidecar index; returns the new manifest."""
    return _dealt(archives).mapInArrow(_normalise(folder), MANIFEST)


def records(archives: DataFrame, folder: str) -> DataFrame:
    """Read the records of normalised archives by their indexes."""
    schema = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return _dealt(archives).mapInArrow(_read(folder), schema)


def round_trip(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Write the pages (page_id, url, html) to archives and read the records back.

    A null html is an empty payload. Payloads of at least ``least`` bytes that equal
    one of a smaller ``page_id`` are revisits of the smallest; rows that share the
    smallest id (repeated rows) are all responses, and a row without id revisits unless
    no equal row has one. Other columns are not archived; no pages give no records.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    whole = scratch.written(archived(with_revisits(pages, least, scratch), scratch.folder), "manifest")
    single = scratch.written(normalised(whole, scratch.folder), "normalised")
    counts = [df.agg(F.coalesce(F.sum("n_records"), F.lit(0))).first()[0] for df in (whole, single)]
    if counts[0] != counts[1]:
        raise ValueError(f"{counts[0]} records were written and {counts[1]} normalised")
    return records(single, scratch.folder)
