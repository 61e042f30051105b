"""Records of WARC and ARC archives: one archive is one task's unit; it is opened in the task and read record by record.

A record that can't be handled is skipped; where an archive itself breaks off, what was read before stays. Either leaves
a row with the record type `failed record` or `failed archive` (`failed download` if it couldn't be fetched) and no
payload, so that losses can be counted.
"""

from __future__ import annotations

import io
import os
import tempfile
import urllib.request
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "archive_name string, offset long, format string, record_type string, target_url string, ts14 string, mime string, content_encoding string, http_status string, payload binary"
HTTP = ("application/http; msgtype=response", "application/http;msgtype=response")
MODES = ("PERMISSIVE", "FAILFAST")
FAILED, FAILED_ARCHIVE, FAILED_DOWNLOAD = "failed record", "failed archive", "failed download"
CONNECT_S, TRIES = 60, 3
NAMES = ("*arc.gz", "*.warc", "*.arc")
ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "timestamp_ntz": pa.timestamp("us")}
#: Rows and bytes that a Python worker gathers before it hands them on.
LOT_ROWS, LOT_BYTES = 200, 1 << 22


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, ARROW[t]) for n, t in (c.split() for c in ddl.split(", "))])


def arrow_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def lots(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows that end with bytes, in small batches whatever archives they are from."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"")
        if len(held) >= LOT_ROWS or size >= LOT_BYTES:
            yield arrow_batch(held, schema)
            held, size = [], 0
    if held:
        yield arrow_batch(held, schema)


def archive_list(spark: SparkSession, path: str, per_task: int = 1) -> DataFrame:
    """Archives named in a text file, one path or URL per line; blank lines are skipped."""
    rows = spark.read.text(path).select(F.trim("value").alias("path")).filter("path <> ''")
    return rows.repartition(max(1, -(-rows.count() // per_task)))


def archives_under(spark: SparkSession, path: str) -> DataFrame:
    """Archives under a folder of any file system, by name; their contents are not read here."""
    found = [spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", n).load(path).select("path") for n in NAMES]
    paths = found[0].union(found[1]).union(found[2]).distinct()
    return paths.repartition(max(1, paths.count()), "path")


def fetched(url: str, folder: str) -> str:
    """Downloads an archive, again if what came isn't as long as announced; the path of the local copy."""
    to = os.path.join(folder, url.rsplit("/", 1)[-1])
    for left in range(TRIES - 1, -1, -1):
        try:
            with urllib.request.urlopen(url, timeout=CONNECT_S) as answer, open(to, "wb") as out:
                size = answer.headers.get("Content-Length")
                while block := answer.read(1 << 20):
                    out.write(block)
            if size is None or int(size) == os.path.getsize(to):
                return to
            error: Exception = OSError(f"{url}: {os.path.getsize(to)} bytes of {size}")
        except OSError as e:
            error = e
        if not left:
            raise error
    raise AssertionError


def _opened(path: str):
    path = "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path
    system, at = fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))
    return system.open_input_stream(at, compression=None, buffer_size=1 << 20)


def archive_format(name: str) -> str:
    return "warc" if name.endswith(("warc.gz", "warc")) else "arc"


def _headers(stream) -> dict[str, str]:
    out = {}
    while (line := stream.readline().strip()):
        key, _, value = line.decode("latin-1").partition(":")
        out[key.strip().lower()] = value.strip()
    return out


def split_http(data: bytes) -> tuple[str, dict[str, str], bytes]:
    """Status, headers (lower-case, the last of a name) and body."""
    stream = io.BytesIO(data)
    status = stream.readline().decode("latin-1").split()
    headers = _headers(stream)
    return status[1] if len(status) > 1 else "", headers, stream.read()


def decoded(body: bytes, encoding: str) -> bytes | None:
    """Brotli bodies need the brotli module; without it the record has failed. A body that isn't what its header says is taken as it is."""
    if "br" in encoding:
        try:
            import brotli
        except ImportError:
            return None
        try:
            return brotli.decompress(body)
        except brotli.error:
            return body
    return body


def _record(at: int, read) -> tuple | None:
    """What read returns, or the row of a failed record."""
    try:
        return read()
    except (ValueError, IndexError, zlib.error):
        return (at, FAILED, None, None, None, "", "", None)


def warc_records(stream) -> Iterator[tuple[int, str, str, str, str, str, str, bytes | None]]:
    while (line := stream.readline()):
        if not line.strip():
            continue
        at = stream.tell() - len(line)
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at {at}")
        head = _headers(stream)
        block = stream.read(int(head.get("content-length", "0")))

        def read(at=at, head=head, block=block) -> tuple | None:
            kind = head.get("warc-type", "")
            url = head.get("warc-target-uri", "").strip("<>")
            date = head.get("warc-date", "")
            ts14 = "".join(c for c in date[:19] if c.isdigit()) if date.endswith("Z") and len(date) >= 20 else None
            if kind == "response" and head.get("content-type", "") in HTTP:
                status, headers, body = split_http(block)
                encoding = headers.get("content-encoding", "")
                payload = decoded(body, encoding)
                return (at, kind if payload is not None else FAILED, url, ts14, headers.get("content-type"), encoding, status, payload)
            if kind.lower() == "resource":
                return at, "resource", url, ts14, head.get("content-type"), "", "", block
            return at, kind or "unknown", url, ts14, None, "", "", None

        yield _record(at, read)


def arc_records(stream) -> Iterator[tuple[int, str, str, str, str, str, str, bytes | None]]:
    while (line := stream.readline()):
        if not line.strip():
            continue
        at = stream.tell() - len(line)
        parts = line.decode("latin-1").split()
        block = stream.read(int(parts[-1]))  # without a length there is no next record
        if len(block) < int(parts[-1]):
            raise EOFError(f"record cut off at {at}")
        if parts[0].startswith("filedesc:"):
            continue

        def read(at=at, parts=parts, block=block) -> tuple:
            url, ts14, mime = parts[0], parts[2], parts[3]
            if len(parts) < 5:
                raise ValueError("fields of the record line are missing")
            if block.startswith(b"HTTP"):
                status, headers, body = split_http(block)
                return at, "response", url, ts14, mime, headers.get("content-encoding", ""), status, body
            return at, "response", url, ts14, mime, "", "", block

        yield _record(at, read)


class _Plain(io.RawIOBase):
    """Bytes of a source of which `start` has been read, with the place in it."""

    def __init__(self, source, start: bytes):
        self.source, self.ready, self.at = source, start, 0

    def readable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def readinto(self, into) -> int:
        if not self.ready:
            self.ready = self.source.read(len(into))
        n = min(len(into), len(self.ready))
        into[:n], self.ready = self.ready[:n], self.ready[n:]
        self.at += n
        return n


class _Members(io.RawIOBase):
    """Bytes of a gzip file, member by member. What was decompressed before a fault is given out before it is raised."""

    def __init__(self, source, start: bytes):
        self.source, self.inflate, self.fault = source, zlib.decompressobj(31), None
        self.rest, self.ready, self.at = start, b"", 0

    def tell(self) -> int:
        return self.at

    def readable(self) -> bool:
        return True

    def _more(self) -> bytes:
        block = self.rest or self.source.read(1 << 16)
        self.rest = b""
        if self.inflate.eof:
            self.inflate = zlib.decompressobj(31)
        elif not block:
            raise EOFError("archive cut off")
        out = self.inflate.decompress(block)
        if self.inflate.eof:
            self.rest = self.inflate.unused_data.lstrip(b"\0")
        return out

    def readinto(self, into) -> int:
        while not self.ready:
            if self.fault:
                raise self.fault
            if self.inflate.eof and not self.rest:
                self.rest = self.source.read(1 << 16)
                if not self.rest:
                    return 0
            try:
                self.ready = self._more()
            except (zlib.error, EOFError, OSError) as e:
                self.fault = e
        n = min(len(into), len(self.ready))
        into[:n], self.ready = self.ready[:n], self.ready[n:]
        self.at += n
        return n


def read_records(name: str, stream, mode: str = "PERMISSIVE") -> Iterator[tuple]:
    """Rows of SCHEMA from an open archive (or its bytes); PERMISSIVE marks broken records and archives, FAILFAST raises."""
    kind, short = archive_format(name), name.rsplit("/", 1)[-1]
    source = io.BytesIO(stream) if isinstance(stream, bytes) else stream
    start = source.read(2)
    members = start == b"\x1f\x8b"
    stream = io.BufferedReader(_Members(source, start) if members else _Plain(source, start), 1 << 16)
    try:
        for at, record, *rest in (warc_records if kind == "warc" else arc_records)(stream):
            if record == FAILED and mode == "FAILFAST":
                raise ValueError(f"{short}: broken record at {at}")
            yield (short, at, kind, record, *rest)
    except (ValueError, IndexError, EOFError, OSError, zlib.error):
        if mode == "FAILFAST":
            raise
        yield (short, -1, kind, FAILED_ARCHIVE, None, None, None, "", "", None)


def read_listed(paths: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """All records of the archives whose paths or URLs are given in a column `path`, a task for each partition."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")

    def of_one(path: str) -> Iterator[tuple]:
        try:
            if path.startswith(("http://", "https://")):
                with tempfile.TemporaryDirectory() as folder, open(fetched(path, folder), "rb", buffering=0) as local:
                    yield from read_records(path, local, mode)
                return
            opened = _opened(path)
        except OSError:
            if mode == "FAILFAST":
                raise
            yield (path.rsplit("/", 1)[-1], -1, archive_format(path), FAILED_DOWNLOAD, None, None, None, "", "", None)
            return
        with opened:
            yield from read_records(path, opened, mode)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from lots((row for part in parts for path in part["path"] for row in of_one(path.as_py())), arrow_schema(SCHEMA))

    return paths.select("path").mapInArrow(run, SCHEMA)


def read_contents(archives: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """All records of archives that are rows themselves: name and content."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from lots((row for part in parts for name, content in zip(part["name"], part["content"]) for row in read_records(name.as_py(), content.as_py(), mode)), arrow_schema(SCHEMA))

    return archives.mapInArrow(run, SCHEMA)


def read_archives(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """All records of the archives under path."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    return read_listed(archives_under(spark, path), mode)


def is_image() -> Column:
    return F.col("mime").contains("image") & F.col("payload").isNotNull()


def is_html() -> Column:
    """In ARC archives a record is an image or a page, in WARC archives it can be both."""
    return F.col("mime").contains("html") & F.col("payload").isNotNull() & ((F.col("format") == "warc") | ~F.col("mime").contains("image"))


def image_records(records: DataFrame) -> DataFrame:
    return records.filter(is_image())


def html_records(records: DataFrame) -> DataFrame:
    return records.filter(is_html())
