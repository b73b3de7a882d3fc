"""Pages in web archives (WARC response records), written by Spark, read by a data source of its own.

``spark.read.format("page_archive").load(path)`` and ``spark.readStream`` of the same give pages as
:data:`PAGE_SCHEMA` has them, once :func:`register` has been called. A file is a partition; it is
read as a stream of records and never held whole. A stream's offset is the time and name of the newest file it has
seen, so files have to arrive whole, as by a rename, and in the order of their times.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from millrace.sources.pages import PAGE_SCHEMA, with_response

#: Records are put together to files of about so many bytes before compression.
FILE_BYTES = 16 << 20
STAMP = "%Y-%m-%dT%H:%M:%SZ"


# --- writing ------------------------------------------------------------------


def record(url: str, status: int, content_type: str, html: str, fetched_at: datetime | None) -> bytes:
    """A response record of one page."""
    body = html.encode("utf-8", "surrogatepass")
    line = lambda text: text.replace("\r", " ").replace("\n", " ")
    block = f"HTTP/1.1 {status} -\r\nContent-Type: {line(content_type)}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
    date = f"WARC-Date: {fetched_at.strftime(STAMP)}\r\n" if fetched_at is not None else ""
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: {line(url)}\r\n{date}Content-Length: {len(block)}\r\n\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, mode: str = "append") -> None:
    """Pages (url, html; status, content_type and fetched_at where they have them) as gzipped archives."""
    if "fetched_at" not in pages.columns:
        pages = pages.withColumn("fetched_at", F.lit(None).cast("timestamp"))

    def files(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, size = [], 0
        for frame in frames:
            for url, status, kind, html, at in frame.itertuples(index=False):
                when = None if pd.isna(at) else at.to_pydatetime()
                parts.append(record(url or "", 200 if pd.isna(status) else int(status), kind or "", html or "", when))
                size += len(parts[-1])
                if size >= FILE_BYTES:
                    yield pd.DataFrame({"file": [b"".join(parts)]})
                    parts, size = [], 0
        if parts:
            yield pd.DataFrame({"file": [b"".join(parts)]})

    columns = ("url", "status", "content_type", "html", "fetched_at")
    made = with_response(pages).select(*columns).mapInPandas(files, "file binary")
    text = made.select(F.col("file").cast("string").alias("value"))
    gz = {"maxRecordsPerFile": 1, "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    text.write.mode(mode).options(**gz).text(path)


# --- reading ------------------------------------------------------------------


def _headers(file: io.BufferedIOBase) -> dict[str, str]:
    found = {}
    while (line := file.readline().rstrip(b"\r\n")):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _number(text: str) -> int:
    return int(text) if text.isascii() and text.isdigit() else -1


def parse(file: io.BufferedIOBase) -> Iterator[tuple]:
    """Pages of the response records of an open archive. What stands behind a damaged record, or
    inside one that is cut off, is not read."""
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            return
        head = _headers(file)
        length = _number(head.get("content-length", ""))
        block = file.read(length) if length >= 0 else b""
        if len(block) != length:
            return
        if head.get("warc-type") != "response" or not block.startswith(b"HTTP/"):
            continue
        inner = io.BytesIO(block)
        first = inner.readline().split()
        answer = _headers(inner)
        try:
            when = datetime.strptime(head.get("warc-date", ""), STAMP).replace(tzinfo=UTC)
        except ValueError:
            when = None
        status = _number(first[1].decode("ascii", "replace")) if len(first) > 1 else -1
        html = inner.read().decode("utf-8", "replace")
        yield head.get("warc-target-uri", ""), status, answer.get("content-type", ""), html, when


@dataclass(frozen=True)
class _File(InputPartition):
    path: str


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    """Any file system that Arrow knows by the path's scheme; the local one without a scheme."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pafs.LocalFileSystem(), path


def _files(path: str) -> list[tuple[int, str]]:
    """(time, name) of the archives under ``path``, in this order; names that begin with ``_`` or ``.`` are skipped."""
    system, root = _system(path)
    found = system.get_file_info(pafs.FileSelector(root, recursive=True))
    inside = lambda info: info.path.removeprefix(root).strip("/").split("/")
    return sorted(
        (info.mtime_ns or 0, info.path) for info in found
        if info.type == pafs.FileType.File and not any(part[:1] in "_." for part in inside(info))
    )


def _pages(root: str, partition: _File) -> Iterator[tuple]:
    system, _ = _system(root)
    with system.open_input_stream(partition.path, compression=None) as raw:
        buffered = io.BufferedReader(raw, 1 << 20)
        packed = buffered.peek(2)[:2] == b"\x1f\x8b"
        yield from parse(io.BufferedReader(gzip.GzipFile(fileobj=buffered), 1 << 20) if packed else buffered)


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[_File]:
        return [_File(name) for _, name in _files(self.path)]

    def read(self, partition: _File) -> Iterator[tuple]:
        # A folder without archives is read as one partition of nothing.
        if isinstance(partition, _File):
            yield from _pages(self.path, partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def initialOffset(self) -> dict:
        return {"time": -1, "name": ""}

    def latestOffset(self) -> dict:
        time, name = max(_files(self.path), default=(-1, ""))
        return {"time": time, "name": name}

    def partitions(self, start: dict, end: dict) -> list[_File]:
        after, last = (start["time"], start["name"]), (end["time"], end["name"])
        return [_File(f[1]) for f in _files(self.path) if after < f <= last]

    def read(self, partition: _File) -> Iterator[tuple]:
        yield from _pages(self.path, partition)

    def commit(self, end: dict) -> None:
        """Nothing is kept: files stay where they are."""


class PageArchive(DataSource):
    """Pages of the archives under the option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "page_archive"

    def schema(self) -> str:
        return PAGE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the format ``page_archive`` known to the session."""
    spark.dataSource.register(PageArchive)
