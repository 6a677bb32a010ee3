"""WARC records in seekable Zstandard bundles: independent frames, a seek table, a map of record ids."""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import Batches, create_file, open_file, picked, raw_bytes, stored
from sluiceway.session import scratch_path

FRAME_BYTES = 256 << 10
LEVEL = 3
DATE = "2020-01-01T00:00:00Z"
#: Fixed values of the seekable format: skippable frames and the footer of its seek table.
_MAP_MAGIC, _SEEK_MAGIC, _SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_ENTRY, _FOOTER, _RECORD = struct.Struct("<II"), struct.Struct("<IBI"), struct.Struct("<IIII")
_SUMMARY = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def record_id(page_id: int | None, row: int) -> str:
    """A page's record; pages without id are named by their place."""
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:page:none:{row}>"


def base32(sha1: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1)).decode()


def record(name: str, url: str | None, payload: bytes, digest: str, refers_to: int | None, size: int) -> bytes:
    """One WARC/1.1 record. A revisit names the response and has no payload of its own."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    body = http + payload if refers_to is None else http
    target = "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in url or "")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to, 0)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


class Writer:
    """A bundle: records fill frames of about ``frame_bytes``, each compressed for itself."""

    def __init__(self, file, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        import zstandard

        self.file, self.frame_bytes = file, frame_bytes
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True).compress
        self.held, self.size, self.frames = [], 0, []
        self.records: list[tuple[str, int, int, int]] = []

    def add(self, name: str, data: bytes) -> None:
        self.records.append((name, len(self.frames), self.size, len(data)))
        self.held.append(data)
        self.size += len(data)
        if self.size >= self.frame_bytes:
            self._frame()

    def _frame(self) -> None:
        packed = self.compress(b"".join(self.held))
        self.file.write(packed)
        self.frames.append((len(packed), self.size))
        self.held, self.size = [], 0

    def close(self) -> None:
        """The map of records, then the seek table, both in frames that other readers skip."""
        if self.held:
            self._frame()
        rows = []
        for name, frame, offset, size in self.records:
            key = name.encode()
            rows.append(_RECORD.pack(len(key), frame, offset, size) + key)
        index = b"".join(rows)
        self.file.write(_ENTRY.pack(_MAP_MAGIC, len(index)) + index)
        table = b"".join(_ENTRY.pack(*f) for f in [*self.frames, (8 + len(index), 0)])
        table += _FOOTER.pack(len(self.frames) + 1, 0, _SEEKABLE)
        self.file.write(_ENTRY.pack(_SEEK_MAGIC, len(table)) + table)
        self.file.close()


class Bundle:
    """A bundle read by its seek table: any frame, or the record of an id, without the rest."""

    def __init__(self, file):
        import zstandard

        self.file, size = file, file.seek(0, io.SEEK_END) or file.tell()
        self.decompress = zstandard.ZstdDecompressor().decompress
        n, _, magic = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if magic != _SEEKABLE:
            raise ValueError("not a seekable bundle")
        table = self._at(size - _FOOTER.size - n * _ENTRY.size, n * _ENTRY.size)
        self.frames, at = [], 0
        for packed, plain in _ENTRY.iter_unpack(table):
            self.frames.append((at, packed, plain))
            at += packed

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def frame(self, i: int) -> bytes:
        at, packed, plain = self.frames[i]
        return self.decompress(self._at(at, packed), max_output_size=plain) if plain else b""

    def records(self) -> Iterator[tuple[str, int, int, int]]:
        """(record id, frame, offset in the frame, bytes) in the order of writing."""
        at, packed, _ = self.frames[-1]
        data, at = self._at(at, packed), 8
        while at < len(data):
            length, frame, offset, size = _RECORD.unpack_from(data, at)
            at += _RECORD.size + length
            yield data[at - length : at].decode(), frame, offset, size

    def get(self, name: str) -> bytes:
        for found, frame, offset, size in self.records():
            if found == name:
                return self.frame(frame)[offset : offset + size]
        raise KeyError(name)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """A record's fields and payload (that of a revisit is empty)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def _write(folder: str, frame_bytes: int, batches: Batches) -> Batches:
    task, writer, row = TaskContext.get(), None, 0
    name = f"{folder}/bundle-{task.partitionId():06d}-{task.taskAttemptId()}.warc.zst"
    for batch in batches:
        writer = writer or Writer(create_file(name), frame_bytes)
        ids, urls, refers = (batch.column(c).to_pylist() for c in ("page_id", "url", "refers_to"))
        digests, sizes = batch.column("digest").to_pylist(), batch.column("size").to_pylist()
        for page, url, html, digest, refer, size in zip(ids, urls, raw_bytes(batch.column("html")), digests, refers, sizes):
            key = record_id(page, row)
            writer.add(key, record(key, url, html, base32(digest), refer, size))
            row += 1
    if writer:
        writer.close()
        yield pa.record_batch({"path": [name], "records": pa.array([row], pa.int64())})


def _read(batches: Batches) -> Batches:
    def number(name: str) -> int | None:
        found = name.removeprefix("<urn:page:").removesuffix(">")
        return None if found.startswith("none:") else int(found)

    for batch in batches:
        for path in batch.column("path").to_pylist():
            with open_file(path) as file:
                bundle, rows, at, frame = Bundle(file), [], -1, b""
                for _, i, offset, size in bundle.records():
                    if i != at:
                        at, frame = i, bundle.frame(i)
                    fields, payload = parse(frame[offset : offset + size])
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response":
                        made = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if made != digest or len(payload) != int(fields["X-Payload-Length"]):
                            raise ValueError(f"{fields['WARC-Record-ID']} in {path} is damaged")
                    refers = number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None
                    rows.append((number(fields["WARC-Record-ID"]), int(fields["X-Payload-Length"]), digest, kind, refers))
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))


def write_warc(
    pages: DataFrame, *, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
    least_bytes: int = 0, frame_bytes: int = FRAME_BYTES, folder: str | None = None,
) -> DataFrame:
    """Write one record per row into bundles; a stored row ``(path, records)`` per bundle.

    Of records with equal payloads of at least ``least_bytes``, the one with the largest id is the
    response and the others revisit it. Payloads are compared by SHA-1 (the records' own digest):
    the largest id per digest is an aggregate with partial reduction, and a digest that a third of
    all pages share is a skewed join key that Spark splits. Revisits leave their payload before the
    writer. Null html is an empty payload. Null ids come before all others; without any other id
    they are all responses, and so are repeated rows of the largest id. An empty table writes
    nothing. Each attempt of a task writes its own file; only those in the returned table count.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    pages = picked(pages, page_id=id_column, url=url_column, html=html_column)
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("html"))
    pages = pages.withColumns({"digest": F.sha1("html"), "size": F.octet_length("html").cast("bigint")})
    responses = pages.where(F.col("size") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("response"))
    joined = pages.join(responses, "digest", "left")
    refers = F.when(F.col("response") != F.coalesce("page_id", F.col("response") - 1), F.col("response"))
    named = joined.withColumn("refers_to", refers).withColumn("html", F.when(F.col("refers_to").isNull(), F.col("html")))
    written = named.select("page_id", "url", "html", "digest", "size", "refers_to").mapInArrow(
        lambda batches: _write(folder, frame_bytes, batches), "path string, records bigint"
    )
    return stored(written, "warc-bundles")


def read_warc(bundles: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` per record of the bundles.

    Payloads of responses are checked against their digest; a damaged one is an error. Records without a
    payload and repeated ones come as they were written; without bundles the result is empty.
    """
    files = max(bundles.count(), 1)
    return bundles.select("path").repartitionByRange(files, "path").mapInArrow(_read, _SUMMARY)
