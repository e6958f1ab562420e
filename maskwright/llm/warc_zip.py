"""WARC records in ZIP packages: writing, and reading by ranges without extraction.

A package is a ZIP file with two stored (uncompressed) members: ``archive/data.warc.gz``, one gzip
member per record, and ``indexes/index.jsonl``, a line per record with its offset and length.
The reader parses the end record and the central directory (with their ZIP64 forms), finds the
stored members, and reads single records as byte ranges of the package.

Packages lie in a folder that all executors reach; pyarrow's file systems open it (local paths,
hdfs, s3, gcs).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import chunks, column, fits, small_batches, stored
from maskwright.sources.shared import shared_path

ARCHIVE = "archive/data.warc.gz"
INDEX = "indexes/index.jsonl"
# A task begins a new package when the records of one exceed this many bytes.
PACKAGE_BYTES = 256 * 1024 * 1024
GZIP_LEVEL = 4
# Digests with several pages that are broadcast at most; more of them are joined by shuffle.
BROADCAST_ROWS = 200_000
# Signatures and marks of the ZIP format.
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
CENTRAL, LOCAL = b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
STORED, EXTRA64 = 0, 1

MANIFEST_SCHEMA = "path string, records bigint, bytes bigint"
RECORD_SCHEMA = (
    "page_id bigint, uri string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, payload binary"
)


class Member(NamedTuple):
    """An entry of a central directory; ``at`` is where its data begins in the package."""

    name: str
    method: int
    at: int
    size: int


class PackageReader:
    """Random access to the stored members of a ZIP package; no member is extracted."""

    def __init__(self, source, size: int) -> None:
        self.source, self.size = source, size
        self.members = {m.name: m for m in self._directory()}

    def read_at(self, at: int, length: int) -> bytes:
        if at < 0 or length < 0 or at + length > self.size:
            raise ValueError("the range lies outside the package")
        self.source.seek(at)
        data = self.source.read(length)
        if len(data) != length:
            raise ValueError("the package is truncated")
        return data

    def _end(self) -> tuple[int, int, int]:
        """Entries, size and offset of the central directory."""
        tail_at = max(0, self.size - 22 - FULL16)
        tail = self.read_at(tail_at, self.size - tail_at)
        found = tail.rfind(END)
        while found >= 0:
            if found + 22 <= len(tail):
                fields = struct.unpack("<4s4H2LH", tail[found:found + 22])
                if found + 22 + fields[7] == len(tail):  # the comment ends the file
                    break
            found = tail.rfind(END, 0, found)
        if found < 0:
            raise ValueError("not a ZIP package: no end record")
        entries, size, at = fields[4], fields[5], fields[6]
        locator_at = tail_at + found - 20
        if (entries == FULL16 or FULL32 in (size, at)) and locator_at >= 0:
            mark, _, end_at, _ = struct.unpack("<4sLQL", self.read_at(locator_at, 20))
            if mark == LOCATOR64:
                end = struct.unpack("<4sQ2H2L4Q", self.read_at(end_at, 56))
                if end[0] != END64:
                    raise ValueError("the ZIP64 end record is damaged")
                entries, size, at = end[7], end[8], end[9]
        return entries, size, at

    def _directory(self) -> Iterator[Member]:
        entries, size, at = self._end()
        data = self.read_at(at, size)
        p = 0
        for _ in range(entries):
            if data[p:p + 4] != CENTRAL:
                raise ValueError("the central directory is damaged")
            (flags, method, packed, full, n, extra, comment, local) = struct.unpack(
                "<8xHH8xLL3H8xL", data[p:p + 46]
            )
            name = data[p + 46:p + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
            fields = data[p + 46 + n:p + 46 + n + extra]
            wide = self._wide(fields)
            # The ZIP64 field holds, in this order, those values that did not fit.
            if full == FULL32:
                full = next(wide)
            if packed == FULL32:
                packed = next(wide)
            if local == FULL32:
                local = next(wide)
            if flags & 1:
                raise ValueError(f"the member {name!r} is encrypted")
            yield Member(name, method, self._data_at(local), packed)
            p += 46 + n + extra + comment

    @staticmethod
    def _wide(fields: bytes) -> Iterator[int]:
        p = 0
        while p + 4 <= len(fields):
            kind, length = struct.unpack("<HH", fields[p:p + 4])
            if kind == EXTRA64:
                body = fields[p + 4:p + 4 + length]
                for i in range(0, len(body) - 7, 8):
                    yield struct.unpack("<Q", body[i:i + 8])[0]
            p += 4 + length

    def _data_at(self, local: int) -> int:
        head = self.read_at(local, 30)
        if head[:4] != LOCAL:
            raise ValueError("a local header is damaged")
        n, extra = struct.unpack("<26xHH", head)
        return local + 30 + n + extra

    def stored_member(self, name: str) -> Member:
        member = self.members.get(name)
        if member is None:
            raise ValueError(f"the package has no member {name!r}")
        if member.method != STORED:
            raise ValueError(f"the member {name!r} is compressed: ranges of it cannot be read")
        return member

    def read_range(self, member: Member, offset: int, length: int) -> bytes:
        if offset < 0 or length < 0 or offset + length > member.size:
            raise ValueError("the range lies outside the member")
        return self.read_at(member.at + offset, length)


def digest_of(payload: bytes) -> str:
    """The bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(value: str) -> str:
    """One line: control characters and percent signs as percent escapes."""
    return re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _plain_value(value: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def make_record(
    page_id: int | None, uri: str | None, payload: bytes, digest: str,
    refers_to: int | None, is_revisit: bool,
) -> bytes:
    """A WARC/1.1 response, or a revisit without the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if not is_revisit:
        block += payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_header_value(uri)}")
    if is_revisit:
        lines.append(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
        lines.append(f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _page(urn: str | None) -> int | None:
    number = (urn or "")[len("<urn:page:"):-1]
    return int(number) if number else None


def parse_record(data: bytes) -> tuple:
    """The row of one record; the digest and length of a response are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    length = int(fields["WARC-Payload-Length"])
    if kind == "response" and (digest_of(payload) != digest or len(payload) != length):
        raise ValueError("a payload differs from its digest")
    uri = fields.get("WARC-Target-URI")
    return (
        _page(fields["WARC-Record-ID"]), None if uri is None else _plain_value(uri), kind,
        _page(fields.get("WARC-Refers-To")), length, digest,
        payload if kind == "response" else None,
    )


class PackageWriter:
    """A package written front to back; the index is kept until the end."""

    def __init__(self, stream, archive: str = ARCHIVE, index: str = INDEX) -> None:
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)
        self.archive = self.zip.open(archive, "w", force_zip64=True)
        self.index_name, self.lines, self.at = index, [], 0

    def add(self, page_id: int | None, record: bytes) -> None:
        packed = gzip.compress(record, GZIP_LEVEL, mtime=0)
        self.archive.write(packed)
        line = {"page_id": page_id, "offset": self.at, "length": len(packed)}
        self.lines.append(json.dumps(line))
        self.at += len(packed)

    def close(self) -> None:
        self.archive.close()
        with self.zip.open(self.index_name, "w") as index:
            index.write(("\n".join(self.lines) + "\n").encode())
        self.zip.close()


class _Counting(io.RawIOBase):
    """A write-only stream that cannot seek, over an output stream of a file system."""

    def __init__(self, stream) -> None:
        self.stream, self.size = stream, 0

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.stream.write(data)
        self.size += len(data)
        return len(data)

    def flush(self) -> None:
        pass


def first_copies(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(digest, first) of every payload held by several rows: its smallest (page_id, row).

    Pages are reduced to digests before the shuffle and combined in each task, so a payload held
    by a third of all pages is one row per task.
    """
    return (
        pages.filter(F.col("payload_length") >= min_bytes)
        .groupBy("digest")
        .agg(
            F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row"))
            .alias("first"),
            F.count("*").alias("copies"),
        )
        .filter("copies > 1")
        .select("digest", "first")
    )


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
    package_bytes: int = PACKAGE_BYTES,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Write a record per row into packages below ``folder``: rows (path, records, bytes).

    Of equal payloads of at least ``min_bytes`` bytes, the row with the smallest id (null last,
    then the first row) becomes the response and the others revisits of it; shorter payloads are
    all responses.  ``pages`` is read once and written with its row numbers; its html is never
    shuffled unless more than ``broadcast_rows`` payloads have copies.

    A null html is an empty payload, a null url leaves the target out.  Repeated rows are copies
    of each other.  No rows give no packages.  Other columns are ignored.  A retried task writes
    packages under new names; only those of the attempt that succeeded are listed.
    """
    spark = pages.sparkSession
    small_batches(spark)
    target = folder or shared_path(spark, "warc")
    payload = F.encode(F.coalesce(column(html_col), F.lit("")), "UTF-8")
    rows = stored(pages.select(
        column(id_col).cast("bigint").alias("page_id"),
        F.monotonically_increasing_id().alias("row"),
        column(url_col).alias("url"),
        F.coalesce(column(html_col), F.lit("")).alias("html"),
        F.sha1(payload).alias("digest"),
        F.length(payload).alias("payload_length"),
    ), "warc_rows")
    copies = stored(first_copies(rows, min_bytes), "warc_copies")
    small = fits(copies, broadcast_rows)
    joined = rows.join(F.broadcast(copies) if small else copies, "digest", "left")
    is_copy = (F.col("payload_length") >= min_bytes) & F.col("first").isNotNull() & (
        F.col("first.row") != F.col("row")
    )
    judged = joined.select(
        "page_id", "url", "html", F.col("first.page_id").alias("first_id"), is_copy.alias("copy")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        context = TaskContext.get()
        files, base = fs.FileSystem.from_uri(target)
        files.create_dir(base, recursive=True)
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}"
        done, writer = [], None

        def finish() -> None:
            writer.close()
            stream.stream.close()
            done.append((path, len(writer.lines), stream.size))

        for batch, texts in chunks(batches, "html"):
            ids, urls, firsts, copied = (
                batch.column(i).to_pylist() for i in (0, 1, 3, 4)
            )
            for page_id, url, html, first, copy in zip(
                ids, urls, texts, firsts, copied, strict=True
            ):
                if writer is None:
                    path = f"{base}/{name}-{len(done):04d}.wacz"
                    stream = _Counting(files.open_output_stream(path))
                    writer = PackageWriter(stream)
                content = html.encode()
                writer.add(page_id, make_record(
                    page_id, url, content, digest_of(content), first if copy else None, copy
                ))
                if writer.at >= package_bytes:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _, _ in done], pa.string()),
                    pa.array([n for _, n, _ in done], pa.int64()),
                    pa.array([b for _, _, b in done], pa.int64()),
                ],
                names=["path", "records", "bytes"],
            )

    manifest = stored(judged.mapInArrow(run, MANIFEST_SCHEMA), "warc_manifest")
    prefix = re.match(r"^[a-z0-9]+://[^/]*", target)
    return manifest.select(
        F.concat(F.lit(prefix[0] if prefix else ""), "path").alias("path"), "records", "bytes"
    )


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the packages in column ``path``, each read as a range by its index.

    Yields (page_id, uri, record_type, refers_to, payload_bytes, payload_digest, payload); a
    revisit has no payload of its own, but the length and digest of the one it refers to.  A
    damaged package is an error that names what is wrong.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                files, path = fs.FileSystem.from_uri(uri)
                size = files.get_file_info(path).size
                with files.open_input_file(path) as source:
                    reader = PackageReader(source, size)
                    archive = reader.stored_member(ARCHIVE)
                    index = reader.stored_member(INDEX)
                    lines = reader.read_range(index, 0, index.size).decode().splitlines()
                    rows: list[tuple] = []
                    held = 0
                    for line in lines:
                        entry = json.loads(line)
                        packed = reader.read_range(archive, entry["offset"], entry["length"])
                        row = parse_record(zlib.decompress(packed, 31))
                        rows.append(row if with_payload else (*row[:6], None))
                        held += len(rows[-1][6] or b"")
                        if len(rows) == 2048 or held > 4 * 1024 * 1024:
                            yield _records(rows)
                            rows, held = [], 0
                    if rows:
                        yield _records(rows)

    return (
        archives.select("path").repartition(archives.sparkSession.sparkContext.defaultParallelism)
        .mapInArrow(run, RECORD_SCHEMA)
    )


def _records(rows: list[tuple]) -> pa.RecordBatch:
    ints, text = pa.int64(), pa.string()
    kinds = (ints, text, text, ints, ints, text, pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)],
        names=[
            "page_id", "uri", "record_type", "refers_to", "payload_bytes", "payload_digest",
            "payload",
        ],
    )
