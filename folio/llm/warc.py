"""WARC archives: one gzip member per record, and a sequential reader.

Payloads are hashed in the JVM; of equal payloads of at least ``LEAST`` bytes the row with the largest id becomes
a ``response`` record and the others become ``revisit`` records that refer to it.  Tasks write archive files of about
``FILE_BYTES`` in the shared folder, under names that hold the task attempt; only attempts that succeed put their
files in the manifest, so a retried or speculative task does no harm.

The reader streams a file in chunks: incremental zlib decompression of one member at a time, framing by
Content-Length, and SHA-1 checks of block and payload.  It holds a chunk and a record's headers, not a payload,
unless payloads are asked for.

Defined cases: null html is an empty payload; a null id is written as such and read back as null, and is smaller
than any other id; rows equal in payload and in the largest id are all responses; a null URL becomes ``about:blank``,
and blanks or control characters in one are percent-encoded.  A damaged archive raises.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_path, stored

LEAST = 1000
FILE_BYTES = 64 << 20
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MOST_READERS = 10_000
_NO_ID = "<urn:page-none>"


class DamagedArchive(ValueError):
    pass


def _storage(uri: str):
    """File system and path of a URI; ``file:/x`` and plain paths are local to the shared mount."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return pa.fs.FileSystem.from_uri(uri)


def _digest(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def _record_id(id_) -> str:
    return _NO_ID if id_ is None else f"<urn:page:{quote(str(id_), safe='')}>"


def _page_id(record_id: str) -> str | None:
    return None if record_id == _NO_ID else unquote(record_id[len("<urn:page:"):-1])


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


def _record(id_, url: str | None, payload: bytes, sha1: bytes, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    revisit = refers_to is not None
    block = http if revisit else http + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(id_)), ("WARC-Date", DATE),
               ("WARC-Target-URI", uri), ("WARC-Payload-Digest", _digest(sha1)),
               ("WARC-Block-Digest", _digest(hashlib.sha1(block).digest()))]
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    return _member(headers + [("Content-Type", "application/http; msgtype=response")], block)


def _writer(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        fs, path = _storage(folder)
        name = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        out, seq, size, records, done = None, 0, 0, 0, []

        def close():
            nonlocal out, size, records
            out.close()
            done.append((f"{folder}/{name}-{seq:04d}.warc.gz", size, records))
            out, size, records = None, 0, 0

        for b in batches:
            for id_, url, html, sha1, refers in zip(*(b.column(k) for k in range(5))):
                if out is None:
                    seq += 1
                    out = fs.open_output_stream(f"{path}/{name}-{seq:04d}.warc.gz", compression=None)
                    info = _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                                    ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(info)
                    size = len(info)
                data = _record(id_.as_py(), url.as_py(), html.as_py().encode(), bytes.fromhex(sha1.as_py()), refers.as_py())
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= file_bytes:
                    close()
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["file", "bytes", "records"])
    return run


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST,
                   file_bytes: int = FILE_BYTES, folder: str | None = None) -> DataFrame:
    """Write the archives; the manifest (file, bytes, records) is itself a table in the shared folder."""
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    fs, path = _storage(folder)
    fs.create_dir(path, recursive=True)
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"), F.sha1(html).alias("sha1"))
    small = F.octet_length("html") < least  # never revisits, so they need not meet anything
    large = pages.select(F.col(id_col).alias("id"), F.octet_length(html).alias("n"), F.sha1(html).alias("same")).where(F.col("n") >= least)
    first = large.groupBy("same").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    first = stored(first, "payloads")  # so that the join stands on plain scans and Spark can split a payload with many copies
    met = rows.where(~small).join(first, F.col("sha1") == F.col("same"), "left")
    refers = F.when(~F.col("id").eqNullSafe(F.col("keep")), F.col("keep"))
    met = met.select("id", "url", "html", "sha1", refers.alias("refers"))
    alone = rows.where(small).select("id", "url", "html", "sha1", F.lit(None).cast(met.schema["refers"].dataType).alias("refers"))
    return stored(met.unionByName(alone).mapInArrow(
        _writer(folder, file_bytes), "file string, bytes long, records long"), "manifest")


class _Member:
    """One gzip member of a stream of chunks, decompressed piece by piece."""

    def __init__(self, source, rest: bytes):
        self.source, self.rest, self.z, self.buffer = source, rest, zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Decompress a little more; False at the member's end."""
        while not self.z.eof:
            data = self.z.unconsumed_tail or self.rest or self.source.read(CHUNK)
            self.rest = b""
            if not data:
                raise DamagedArchive("the file ends within a member")
            out = self.z.decompress(data, CHUNK)
            if out:
                self.buffer += out
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        while (at := self.buffer.find(mark)) < 0:
            if not self.more():
                raise DamagedArchive("a header does not end")
        head, self.buffer = self.buffer[:at], self.buffer[at + len(mark):]
        return head

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self.more():
                raise DamagedArchive("a record is shorter than its Content-Length")
            part, self.buffer = self.buffer[:n], self.buffer[n:]
            n -= len(part)
            yield part

    def close(self) -> bytes:
        """Check that only the record's end is left; returns what follows the member."""
        while self.more():
            if len(self.buffer) > 4:
                break
        if self.buffer != b"\r\n\r\n":
            raise DamagedArchive("a record is longer than its Content-Length")
        return self.z.unused_data


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode().split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def records(source, payloads: bool = False) -> Iterator[dict]:
    """The records of an open archive, in order, each checked against its digests."""
    rest = source.read(CHUNK)
    while rest:
        member = _Member(source, rest)
        version, fields = _fields(member.until(b"\r\n\r\n"))
        if not version.startswith("WARC/"):
            raise DamagedArchive(f"not a record: {version[:40]!r}")
        size = int(fields["content-length"])
        block, payload, kept, head, http = hashlib.sha1(), hashlib.sha1(), [], b"", None
        n = 0
        for part in member.take(size):
            block.update(part)
            if http is None and fields.get("content-type", "").startswith("application/http"):
                head += part
                if b"\r\n\r\n" not in head:
                    continue
                http, _, part = head.partition(b"\r\n\r\n")
            payload.update(part)
            n += len(part)
            if payloads:
                kept.append(part)
        rest = member.close() or source.read(CHUNK)
        if "warc-block-digest" in fields and fields["warc-block-digest"] != _digest(block.digest()):
            raise DamagedArchive(f"block digest of {fields.get('warc-record-id')}")
        kind = fields["warc-type"]
        if kind == "response" and fields["warc-payload-digest"] != _digest(payload.digest()):
            raise DamagedArchive(f"payload digest of {fields.get('warc-record-id')}")
        if kind in ("response", "revisit"):
            full = int(_fields(http)[1]["content-length"])
            if kind == "response" and full != n:
                raise DamagedArchive(f"payload length of {fields.get('warc-record-id')}")
            yield {"id": _page_id(fields["warc-record-id"]), "uri": fields["warc-target-uri"], "record_type": kind,
                   "payload_bytes": full, "payload_digest": base64.b32decode(fields["warc-payload-digest"][5:]).hex(),
                   "refers_to": _page_id(fields["warc-refers-to"]) if kind == "revisit" else None,
                   "payload": b"".join(kept) if payloads and kind == "response" else None}


_SCHEMA = pa.schema([("id", pa.string()), ("uri", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])


def _reader(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file in b.column(0).to_pylist():
                fs, path = _storage(file)
                with fs.open_input_stream(path, compression=None) as source:
                    some, size = [], 0
                    for r in records(source, payloads):
                        some.append(r)
                        size += len(r["payload"] or b"")
                        if len(some) >= 5000 or size >= 16 * CHUNK:
                            yield pa.RecordBatch.from_pylist(some, _SCHEMA)
                            some, size = [], 0
                    if some:
                        yield pa.RecordBatch.from_pylist(some, _SCHEMA)
    return run


def read_archives(manifest: DataFrame, payloads: bool = False, id_type: str = "long") -> DataFrame:
    """A row per response or revisit record: id, uri, record_type, payload_bytes and payload_digest (of the full
    payload, also for a revisit), refers_to, payload (of responses, if asked for)."""
    files = manifest.select("file")
    parts = max(1, min(files.count(), MOST_READERS))
    out = files.repartition(parts).mapInArrow(_reader(payloads), "id string, uri string, record_type string, payload_bytes long, "
                                                                 "payload_digest string, refers_to string, payload binary")
    return out.withColumns({"id": F.col("id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})


def round_trip(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """Write the pages and read them back: id, payload_bytes, payload_digest, record_type, refers_to."""
    kind = pages.schema[id_col].dataType.simpleString()
    read = read_archives(write_archives(pages, id_col, **options), id_type=kind)
    return read.select(F.col("id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
