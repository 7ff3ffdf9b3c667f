"""WARC archives: one gzip member per record, written and read by Spark tasks."""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.shared import stored

READ_BYTES = 1 << 18
_DATE = "2000-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

RECORD = (
    "page_id long, record_type string, refers_to long, url string, "
    "payload_bytes long, payload_digest string, payload binary"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    text = name[len("<urn:x-page:") : -1]
    return int(text) if text else None


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool
) -> bytes:
    """One record as a gzip member. A revisit holds HTTP headers, no payload."""
    http = _HTTP + b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {_DATE}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~' + chr(39))}")
    if revisit:
        lines.append(f"WARC-Refers-To: {_name(refers_to)}")
        lines.append(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


class _Members:
    """Bytes of an archive, decompressed member by member as they are asked for."""

    def __init__(self, source):
        self.source, self.unused = source, b""
        self.inflater, self.ready = None, bytearray()

    def _more(self) -> bool:
        """Inflate some bytes of the current member; False at its end."""
        if self.inflater.eof:
            self.unused = self.inflater.unused_data
            return False
        data = self.inflater.unconsumed_tail or self.unused or self.source.read(READ_BYTES)
        self.unused = b""
        if not data:
            raise ValueError("archive ends within a record")
        self.ready += self.inflater.decompress(data, READ_BYTES)
        return True

    def opened(self) -> bool:
        """Start the next member; False at the end of the archive."""
        self.unused = self.unused or self.source.read(READ_BYTES)
        if not self.unused:
            return False
        self.inflater, self.ready = zlib.decompressobj(31), bytearray()
        return True

    def line(self) -> bytes:
        while (end := self.ready.find(b"\r\n")) < 0:
            if not self._more():
                raise ValueError("record header without an end")
        found = bytes(self.ready[:end])
        del self.ready[: end + 2]
        return found

    def exactly(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise ValueError("record is shorter than its Content-Length")
        found = bytes(self.ready[:n])
        del self.ready[:n]
        return found

    def closed(self) -> None:
        if self.exactly(4) != b"\r\n\r\n" or self.ready:
            raise ValueError("record is longer than its Content-Length")
        while self._more():
            if self.ready:
                raise ValueError("record is longer than its Content-Length")


def read_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of a binary stream.

    Framing and block digests are verified; faults raise ``ValueError``.
    """
    members = _Members(source)
    while members.opened():
        if not members.line().startswith(b"WARC/"):
            raise ValueError("no WARC version line")
        headers = {}
        while line := members.line():
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        block = members.exactly(int(headers["content-length"]))
        members.closed()
        _verified(headers.get("warc-block-digest"), block)
        yield headers, block


def _verified(digest: str | None, data: bytes) -> None:
    if digest and digest.removeprefix("sha1:") != base32_sha1(data):
        raise ValueError(f"digest {digest} does not fit")


def read_pages(source) -> Iterator[tuple]:
    """``RECORD`` rows of an archive that this module wrote."""
    for headers, block in read_records(source):
        http, _, payload = block.partition(b"\r\n\r\n")
        revisit = headers["warc-type"] == "revisit"
        digest = headers["warc-payload-digest"]
        if not revisit:
            _verified(digest, payload)
        length = next(
            int(x.split(b":")[1])
            for x in io.BytesIO(http)
            if x.lower().startswith(b"content-length:")
        )
        yield (
            _page(headers["warc-record-id"]),
            headers["warc-type"],
            _page(headers["warc-refers-to"]) if revisit else None,
            headers.get("warc-target-uri"),
            length,
            digest.removeprefix("sha1:"),
            None if revisit else payload,
        )


def revisit_targets(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``digest`` and ``target`` of payloads that several rows share.

    The target is the largest ``page_id``. Rows are counted before the shuffle, so
    a payload that a third of all pages share is one row of each task.
    """
    html = F.coalesce("html", F.lit(""))
    return (
        pages.where(F.octet_length(html) >= min_bytes)
        .groupBy(F.sha1(F.encode(html, "utf-8")).alias("digest"))
        .agg(F.count("*").alias("n"), F.max("page_id").alias("target"))
        .where("n > 1")
        .select("digest", "target")
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write one archive per task below ``folder`` (a URI all executors share).

    ``pages`` has ``page_id``, ``url``, ``html``; other columns are left out. Of rows
    with equal payloads of at least ``min_bytes`` bytes the one with the largest
    page_id is the response and the others revisit it; if several rows have that
    page_id, each of them is a response. A null html is an empty payload; a null url
    gives no target URI; a null page_id is the smallest of all, and if no copy has
    one, all are responses.

    Returns the ``path`` of every archive. Names carry a fresh id per attempt and only
    the paths that the finished tasks report are returned, so a task that ran twice
    leaves an extra file but no extra record.
    """
    targets = stored(revisit_targets(pages, min_bytes), "revisits")
    html = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select("page_id", "url", html.alias("payload"))
    # both sides are read from files: broadcast if the targets are small, else
    # a sort-merge join that adaptive execution splits where a payload is hot
    rows = rows.join(targets, F.sha1("payload") == F.col("digest"), "left").select(
        "page_id",
        "url",
        "payload",
        "target",
        (F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target"))).alias("revisit"),
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        path = f"{base}/part-{TaskContext.get().partitionId():05d}-{uuid4().hex}.warc.gz"
        count = 0
        with store.open_output_stream(path, compression=None) as out:
            for batch in batches:
                for page, url, payload, target, revisit in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True
                ):
                    out.write(record_bytes(page, url, payload, target, revisit))
                    count += 1
        if count:
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [count]})

    return stored(rows.mapInArrow(written, "path string, records long"), "archives")


def read_archives(archives: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """``RECORD`` rows of the archives, each read from start to end by one task."""
    files = max(1, archives.count())

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path, compression=None) as source:
                    held, size = [], 0
                    for row in read_pages(source):
                        held.append(row if with_payload else (*row[:-1], None))
                        size += len(held[-1][-1] or b"") + 200
                        if size > 16_000_000:
                            yield _batch(held)
                            held, size = [], 0
                    if held:
                        yield _batch(held)

    return archives.select("path").repartition(files, "path").mapInArrow(opened, RECORD)


_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
_NAMES = [f.split()[0] for f in RECORD.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES
    )
