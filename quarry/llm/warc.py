"""WARC archives as chunked record tables.

Writing: each partition of pages streams into an archive of its own in the shared folder, one gzip
member for each record; only the archives that finished tasks name are read.  Reading: an archive
is decompressed as it is read and becomes rows of record number and chunk number, each with a
piece of the payload of bounded size and the SHA-1 of the payload so far; no record is ever held
whole.  Payloads seen before become revisit records, which keep length and digest but no payload.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, written

CHUNKS = "record_id string, chunk_no bigint, page_id bigint, record_type string, target_uri string, refers_to bigint, declared_digest string, payload_bytes bigint, data binary, digest_so_far string, last boolean"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


@dataclass(frozen=True)
class Warc:
    #: Payload bytes in a chunk row.
    chunk: int = 256 * 1024
    #: Smaller payloads are never revisits.
    min_payload: int = 0
    #: A fixed date keeps reruns alike.
    date: str = "2024-01-01T00:00:00Z"
    level: int = 6


def record_urn(page_id: object, uri: object) -> str:
    return f"urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id} {uri}')}"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def opened(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


def clean(value: str | None) -> str:
    return "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in value or "")


def writer(folder: str, w: Warc):
    """A function for mapInArrow: page_id, url, html, first_id to the path and number of records of an archive."""

    def record(out, page: int | None, url: str | None, payload: memoryview, first: int | None) -> None:
        digest = hashlib.sha1(payload).digest()
        visit = first is not None and first != page
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        head = [
            "WARC/1.1",
            f"WARC-Type: {'revisit' if visit else 'response'}",
            f"WARC-Record-ID: <{record_urn(page, url)}>",
            f"WARC-Date: {w.date}",
            f"WARC-Target-URI: {clean(url)}",
            f"WARC-Payload-Digest: sha1:{base32(digest)}",
            f"X-Page-Id: {'' if page is None else page}",
        ]
        if visit:
            head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-Id: {first}"]
        head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if visit else len(payload))}"]
        z = zlib.compressobj(w.level, wbits=31)
        out.write(z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + http))
        if not visit:
            for at in range(0, len(payload), w.chunk):
                out.write(z.compress(payload[at : at + w.chunk]))
        out.write(z.compress(b"\r\n\r\n") + z.flush())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(folder)
        name, n, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            html = batch.column(2).cast(pa.large_binary())
            for i in range(len(batch)):
                if out is None:
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                payload = html[i].as_buffer() if html[i].is_valid else pa.py_buffer(b"")
                record(out, batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), memoryview(payload), batch.column(3)[i].as_py())
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "n": pa.array([n], pa.int64())})

    return run


class Reader:
    """The records of one archive, in pieces: bytes are asked for and never more than a chunk is held."""

    def __init__(self, stream, chunk: int):
        self.stream, self.chunk, self.z, self.raw, self.plain = stream, chunk, zlib.decompressobj(31), b"", b""

    def fill(self) -> bool:
        """More plain bytes; False at the end of the archive."""
        while True:
            if self.z.eof:
                self.raw, self.z = self.z.unused_data, zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.stream.read(self.chunk)
                if not self.raw:
                    self.plain += (got := self.z.decompress(b"", self.chunk))
                    return bool(got)
            got = self.z.decompress(self.raw, self.chunk)
            self.raw = self.z.unconsumed_tail if not self.z.eof else b""
            if got:
                self.plain += got
                return True

    def line(self) -> bytes:
        while (end := self.plain.find(b"\r\n")) < 0:
            if not self.fill():
                raise ValueError("an archive ends within a record's head")
        out, self.plain = self.plain[:end], self.plain[end + 2 :]
        return out

    def some(self, most: int) -> bytes:
        if not self.plain and not self.fill():
            raise ValueError("an archive ends within a record")
        out, self.plain = self.plain[:most], self.plain[most:]
        return out

    def head(self) -> dict[str, str]:
        out = {}
        while line := self.line():
            key, _, value = line.decode().partition(":")
            out[key.strip().lower()] = value.strip()
        return out


def reader(folder: str, w: Warc):
    """A function for mapInArrow: paths of archives to rows of CHUNKS."""
    names = [x.split()[0] for x in CHUNKS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.bool_()]

    def records(r: Reader) -> Iterator[tuple]:
        number = lambda x: int(x) if x else None
        while r.plain or r.fill():
            if not r.line().startswith(b"WARC/"):
                raise ValueError("a record doesn't begin with its version")
            head = r.head()
            left = int(head["content-length"])
            r.line()  # of HTTP's status
            http = r.head()
            size = int(http["content-length"])
            left = size if head["warc-type"] == "response" else 0
            sha, no = hashlib.sha1(), 0
            while True:
                data = b""
                while left and len(data) < w.chunk:
                    piece = r.some(min(left, w.chunk - len(data)))
                    data, left = data + piece, left - len(piece)
                sha.update(data)
                yield (head["warc-record-id"].strip("<>"), no, number(head["x-page-id"]), head["warc-type"], head["warc-target-uri"], number(head.get("x-refers-to-page-id")), head["warc-payload-digest"].removeprefix("sha1:"), size, data, base32(sha.copy().digest()), not left)
                no += 1
                if not left:
                    break
            if r.line() or r.line():
                raise ValueError("a record doesn't end with two line ends")

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(folder)
        for paths in batches:
            for name in paths.column(0).to_pylist():
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    rows, held = [], 0
                    for row in records(Reader(stream, w.chunk)):
                        rows.append(row)
                        held += len(row[8])
                        if held > 8 * w.chunk or len(rows) >= 1000:
                            yield batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch(rows)

    return run


def write_archives(pages: DataFrame, w: Warc = Warc()) -> tuple[str, DataFrame]:
    """(folder, path and n of its archives).  pages: page_id, url, html; null htmls are empty payloads.

    Of equal payloads of at least min_payload bytes, that of the smallest page_id is the response
    and the others revisit it; rows of the same page_id and payload are all responses.  Rows with a
    null page_id are responses unless a page with an id has the payload.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    key = F.sha1(F.col("html").cast("binary"))
    long = F.octet_length("html") >= w.min_payload
    seen = p.filter(long).groupBy(key.alias("k")).agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1 AND first_id IS NOT NULL")
    # Written first, so that its size is known when the join is planned: it is usually small.
    seen = written(seen.select("k", "first_id"), "warc-seen")
    p = p.withColumn("k", F.when(long, key)).join(seen, "k", "left").select("page_id", "url", "html", "first_id")
    folder = f"{shared_dir(pages.sparkSession)}/quarry/warc-{uuid.uuid4().hex}"
    fs, base = opened(folder)
    fs.create_dir(base, recursive=True)
    return folder, written(p.mapInArrow(writer(folder, w), "path string, n bigint"), "warc-archives")


def read_archives(folder: str, archives: DataFrame, w: Warc = Warc()) -> DataFrame:
    """The chunk table of the archives."""
    paths = archives.select("path")
    n = max(1, paths.count())
    return paths.repartition(min(n, 4096)).mapInArrow(reader(folder, w), CHUNKS)


def record_table(chunks: DataFrame) -> DataFrame:
    """One row for each record, from its last chunk: the digest that the stream carried there must be the declared one."""
    last = chunks.filter("last")
    whole = F.when(F.col("record_type") == "response", F.col("digest_so_far")).otherwise(F.col("declared_digest"))
    good = F.when(whole == F.col("declared_digest"), whole).otherwise(F.raise_error(F.lit("a payload's digest isn't the declared one")).cast("string"))
    return last.select("page_id", "payload_bytes", good.alias("payload_digest"), "record_type", F.col("refers_to"))
