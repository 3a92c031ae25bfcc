"""WARC archives: write, normalise a monolithic gzip stream, read back.

Archives that hold one gzip stream for the whole file cannot be read from the
middle.  The normaliser inflates such a stream once, in blocks, rewrites every
record as its own gzip member and writes a sidecar index with offset and length
of each member, so that later readers fetch single records.

Files live in the shared folder and are opened with ``pyarrow.fs``, so any
store it knows will do.  Every task attempt writes files of its own name and
returns them as rows; only files listed in the written manifest are ever read,
so a lost executor or a repeated task leaves orphans, never wrong results.
Memory: one block of a record at a time in the normaliser, one record elsewhere.

Defined cases: null html is an empty payload, a null page id is written as
``null`` and refers to others but is never referred to, a null url is empty,
rows with the smallest page id of a payload are all responses, an empty table
gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.session import scratch_path, stored

from .common import small

BLOCK = 1 << 20
GZIP = 31  # zlib's window bits for a gzip wrapper
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:x-page:"


def _place(folder: str, name: str):
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    return fs, f"{path}/{name}"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record.  A revisit keeps the HTTP header, which states the full
    length, and leaves the payload out.  ``refers_to`` is None for a response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    name = "null" if page_id is None else page_id
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{URN}{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <{URN}{refers_to}>"]
    block = http if refers_to is not None else http + payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


MANIFEST = "path string, records long"


def _write(folder: str, roll_bytes: int):
    """(page_id, url, payload, sha1 hex, refers_to) -> monolithic gzip archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for page, url, payload, sha1, refers in zip(*(batch.column(i) for i in range(5))):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    fs, path = _place(folder, name)
                    out, deflate, records, size = fs.open_output_stream(path, compression=None), zlib.compressobj(6, zlib.DEFLATED, GZIP), 0, 0
                digest = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
                raw = record(page.as_py(), url.as_py(), payload.as_py(), digest, refers.as_py())
                out.write(deflate.compress(raw))
                records, size = records + 1, size + len(raw)
                if size >= roll_bytes:
                    out.write(deflate.flush())
                    out.close()
                    out = None
                    yield _manifest(name, records)
        if out is not None:
            out.write(deflate.flush())
            out.close()
            yield _manifest(name, records)

    return run


def _manifest(name: str, records: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], names=["path", "records"])


class Inflated:
    """The inflated bytes of a gzip file, of one member or many, in blocks."""

    def __init__(self, source):
        self.source, self.engine, self.buffer = source, zlib.decompressobj(GZIP), b""

    def more(self) -> bool:
        raw = self.engine.unconsumed_tail or self.engine.unused_data
        if self.engine.eof:
            raw = raw or self.source.read(BLOCK)
            if not raw:
                return False
            self.engine = zlib.decompressobj(GZIP)
        elif not raw:
            raw = self.source.read(BLOCK)
            if not raw:
                raise EOFError("gzip stream ends in the middle of a member")
        self.buffer += self.engine.decompress(raw, BLOCK)
        return True

    def head(self) -> bytes | None:
        """The next record's header block, or None at the end."""
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.buffer.strip():
                    raise EOFError("archive ends in the middle of a record header")
                return None
        head, self.buffer = self.buffer[: end + 4], self.buffer[end + 4 :]
        return head

    def take(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.buffer and not self.more():
                raise EOFError("archive ends in the middle of a record")
            part, self.buffer = self.buffer[:size], self.buffer[size:]
            size -= len(part)
            if part:
                yield part


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


def normalise(source, target) -> Iterator[dict]:
    """Rewrite the archive ``source`` into ``target``, one gzip member per
    record; yields an index entry per record."""
    stream, offset = Inflated(source), 0
    while (head := stream.head()) is not None:
        about = fields(head)
        deflate = zlib.compressobj(6, zlib.DEFLATED, GZIP)
        length = target.write(deflate.compress(head))
        for part in stream.take(int(about["content-length"]) + 4):
            length += target.write(deflate.compress(part))
        length += target.write(deflate.flush())
        yield {"offset": offset, "length": length, "id": about["warc-record-id"], "type": about["warc-type"]}
        offset += length


class _Counted:
    """A sink whose ``write`` returns the number of bytes written."""

    def __init__(self, sink):
        self.sink = sink

    def write(self, data: bytes) -> int:
        self.sink.write(data)
        return len(data)


def _normalise(folder: str, target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, path = _place(folder, name)
                new = f"{uuid.uuid4().hex}.warc.gz"
                out_fs, out_path = _place(target, new)
                records = 0
                with fs.open_input_stream(path, compression=None) as source, out_fs.open_output_stream(
                    out_path, compression=None
                ) as out, out_fs.open_output_stream(out_path + ".idx", compression=None) as index:
                    for entry in normalise(source, _Counted(out)):
                        index.write(json.dumps(entry).encode() + b"\n")
                        records += 1
                yield _manifest(new, records)

    return run


PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string"


def _page(urn: str) -> int | None:
    name = urn.strip("<>").removeprefix(URN)
    return None if name == "null" else int(name)


def _read(folder: str):
    """Records of normalised archives, each fetched by its indexed offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, path = _place(folder, name)
                rows = []
                with fs.open_input_file(path) as archive, fs.open_input_stream(path + ".idx", compression=None) as index:
                    for entry in _lines(index):
                        archive.seek(entry["offset"])
                        raw = zlib.decompress(archive.read(entry["length"]), GZIP)
                        head, _, block = raw.partition(b"\r\n\r\n")
                        about = fields(head)
                        http, _, payload = block[: int(about["content-length"])].partition(b"\r\n\r\n")
                        stated = about["warc-payload-digest"].removeprefix("sha1:")
                        if about["warc-type"] == "revisit":
                            size, digest, refers = int(fields(http)["content-length"]), stated, _page(about["warc-refers-to"])
                        else:
                            size, refers = len(payload), None
                            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                            if digest != stated:
                                raise ValueError(f"{name}: payload of {entry['id']} does not match its digest")
                        rows.append((_page(about["warc-record-id"]), size, digest, about["warc-type"], refers, about["warc-target-uri"]))
                        if len(rows) == 5000:
                            yield _pages(rows)
                            rows = []
                yield _pages(rows)

    return run


def _lines(index) -> Iterator[dict]:
    rest = b""
    while chunk := index.read(BLOCK):
        *whole, rest = (rest + chunk).split(b"\n")
        yield from map(json.loads, whole)


def _pages(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    columns = zip(*rows) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in PAGES.split(", ")])


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, sha1, refers_to) of the records whose payload a smaller page id
    has too.  Works on digests; a frequent payload is combined per task."""
    keys = pages.filter(F.length("payload") >= min_bytes).select("page_id", "sha1")
    first = keys.groupBy("sha1").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return (
        keys.join(first.drop("_n"), "sha1")
        .filter("refers_to IS NOT NULL AND NOT page_id <=> refers_to")
        .select("page_id", "sha1", "refers_to")
        .distinct()
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, roll_bytes: int = 64 << 20) -> DataFrame:
    """Manifest of monolithic archives in ``folder``, from pages (page_id, url, html)."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    again = stored(revisits(rows, min_bytes), "warc-revisits").select(
        F.col("page_id").alias("_p"), F.col("sha1").alias("_s"), "refers_to"
    )
    full = rows.join(small(again), F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("sha1") == F.col("_s")), "left")
    written = full.select("page_id", "url", "payload", "sha1", "refers_to").mapInArrow(_write(folder, roll_bytes), MANIFEST)
    return stored(written, "warc-written")


def _dealt(manifest: DataFrame) -> DataFrame:
    """One archive per task, more or less: a manifest row is a whole file."""
    return manifest.repartition(max(1, min(10_000, 2 * manifest.count())))


def normalise_archives(manifest: DataFrame, folder: str, target: str) -> DataFrame:
    """Manifest of the normalised archives in ``target``, each with its ``.idx``."""
    return stored(_dealt(manifest).mapInArrow(_normalise(folder, target), MANIFEST), "warc-normalised")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    return _dealt(manifest).mapInArrow(_read(folder), PAGES)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    spark = pages.sparkSession
    mono, members = scratch_path(spark, "warc-mono"), scratch_path(spark, "warc-members")
    written = write_archives(pages, mono, min_bytes)
    return read_archives(normalise_archives(written, mono, members), members)

