"""Legacy web archives (ARC) to WARC.

``read_arc`` parses ARC files of version 1 and 2 by the field names that their
version block declares and by each record's declared length. ``arc_to_warc``
makes WARC records of them: identifiers, timestamps, types and digests that ARC
does not have are derived from what it has, so a second run gives the same.
Archives are written and read through Spark, as files of bounded size.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.sizing import store

#: Records are put together to files of about so many bytes; a larger record has its own.
FILE_BYTES = 8 << 20
#: Equal payloads below this size are stored again rather than referred to.
LEAST_REVISIT = 100
DATE = "20240101000000"
V1_FIELDS = "URL IP-address Archive-date Content-type Archive-length"
V2_FIELDS = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
_RECORD = "url string, ip string, date string, mime string, block binary, whole boolean"


# --- ARC ------------------------------------------------------------------


def arc_head(version: int, date: str = DATE, origin: str = "millrace") -> bytes:
    """The version block that opens an ARC file."""
    fields = V2_FIELDS if version == 2 else V1_FIELDS
    body = f"{version} 0 {origin}\n{fields}\n".encode()
    if version == 2:
        line = f"filedesc://archive.arc 0.0.0.0 {date} text/plain 200 - - 0 archive.arc {len(body)}"
    else:
        line = f"filedesc://archive.arc 0.0.0.0 {date} text/plain {len(body)}"
    return line.encode() + b"\n" + body


def arc_record(version: int, url: str, ip: str, date: str, mime: str, block: bytes, offset: int = 0) -> bytes:
    url = re.sub(r"[\r\n\0]", "", url) or "-"
    extra = f" 200 - - {offset} archive.arc" if version == 2 else ""
    line = f"{url} {ip} {date} {mime.replace(' ', '') or 'no-type'}{extra} {len(block)}"
    return b"\n" + line.encode("utf-8", "surrogatepass") + b"\n" + block


def _declared(line: bytes, names: list[str]) -> dict[str, str] | None:
    """The fields of a header line, split from the right, as a URL may hold spaces; none if it has
    too few or a length that is no number."""
    parts = line.rstrip(b"\r").decode("utf-8", "surrogatepass" if _is_utf8(line) else "replace").rsplit(" ", len(names) - 1)
    found = dict(zip(names, parts, strict=False))
    return found if len(parts) == len(names) and found.get("Archive-length", "").isdecimal() else None


def _is_utf8(line: bytes) -> bool:
    try:
        line.decode("utf-8", "surrogatepass")
    except UnicodeDecodeError:
        return False
    return True


def parse_arc(data: bytes) -> Iterator[tuple[str, str, str, str, bytes, bool]]:
    """(url, ip, date, mime, block, whole) of every record but the version block.

    A file without a readable version block has no records. One that ends inside a block gives what
    it has of it, and ``whole`` is false. Behind a header line that is cut off, lacks fields or has
    no length, records cannot be told apart, so the file ends there.
    """
    top, _, rest = data.partition(b"\n")
    length = top.rsplit(b" ", 1)[-1].strip()
    lines = rest[: int(length)].split(b"\n") if length.isdigit() and len(length) < 10 else []
    names = lines[1].decode("ascii", "replace").strip().split(" ") if len(lines) > 1 else []
    if not {"URL", "IP-address", "Archive-date", "Content-type", "Archive-length"} <= set(names):
        return
    at = len(top) + 1 + int(length)
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        end = data.find(b"\n", at)
        found = _declared(data[at:end], names) if end >= 0 else None
        if found is None:
            return
        length = int(found["Archive-length"])
        block = data[end + 1 : end + 1 + length]
        yield found["URL"], found["IP-address"], found["Archive-date"], found["Content-type"], block, len(block) == length
        at = end + 1 + length


def _files(records: Iterator[bytes], head: bytes) -> Iterator[bytes]:
    parts, size = [head], len(head)
    for record in records:
        if len(parts) > 1 and size + len(record) > FILE_BYTES:
            yield b"".join(parts)
            parts, size = [head], len(head)
        parts.append(record)
        size += len(record)
    if len(parts) > 1:
        yield b"".join(parts)


def _write(files: DataFrame, path: str) -> None:
    """One file a row. The text writer takes the bytes as they are and adds one line break. At its
    default level, gzip costs three times what all the rest does."""
    text = files.select(F.col("file").cast("string").alias("value"))
    gzip = {"maxRecordsPerFile": 1, "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    text.write.options(**gzip).text(path)


def write_arc(records: DataFrame, path: str, version: int = 1) -> None:
    """Records (url, ip, date, mime, block) as gzipped ARC files under ``path``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for f in frames for r in f.itertuples(index=False))
        made = (
            arc_record(version, r.url or "-", r.ip or "0.0.0.0", r.date or DATE, r.mime or "no-type", r.block or b"")
            for r in rows
        )
        for file in _files(made, arc_head(version)):
            yield pd.DataFrame({"file": [file]})

    _write(records.select("url", "ip", "date", "mime", "block").mapInPandas(run, "file binary"), path)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def unzip(data: bytes) -> bytes:
    """All members of a gzip file; other bytes as they are."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out) if out else data


def _batched(rows: Iterator[tuple], columns: list[str], most: int = FILE_BYTES) -> Iterator[pd.DataFrame]:
    """Frames of rows whose field ``block`` sums up to about ``most``."""
    out, size, block = [], 0, columns.index("block")
    for row in rows:
        out.append(row)
        size += len(row[block] or b"")
        if size > most or len(out) >= 4096:
            yield pd.DataFrame(out, columns=columns)
            out, size = [], 0
    if out:
        yield pd.DataFrame(out, columns=columns)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records (url, ip, date, mime, block, whole) of ARC files of either version, gzipped or not;
    damaged files as :func:`parse_arc` has it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for f in frames for data in f["content"] for r in parse_arc(unzip(data)))
        yield from _batched(rows, ["url", "ip", "date", "mime", "block", "whole"])

    return _archives(spark, path).mapInPandas(run, _RECORD)


# --- HTTP blocks ----------------------------------------------------------


def http_block(headers: list[tuple[str, str]], payload: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return f"HTTP/1.1 200 OK\r\n{lines}\r\n".encode() + payload


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Head, up to and with the empty line, and payload; no head if the block is not HTTP."""
    if block[:5] != b"HTTP/":
        return b"", block
    ends = [(i, i + len(e)) for e in (b"\r\n\r\n", b"\n\n") if (i := block.find(e)) >= 0]
    end = min(ends)[1] if ends else len(block)
    return block[:end], block[end:]


def header(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*(.*?)\r?$", head)
    return found[1].decode() if found else None


# --- WARC -----------------------------------------------------------------


def warc_date(date: str) -> str:
    """``yyyymmddhhmmss``, or its first digits, as a WARC date."""
    digits = re.sub(r"\D", "", date)[:14]
    digits += "19700101000000"[len(digits) :]
    d = digits
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(url: str, date: str, digest: str, key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{url} {date} {digest} {key}')}>"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    top = f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n"
    return top.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(head, block) of every record, by its declared length."""
    at = data.find(b"WARC/")
    while at >= 0:
        end = data.index(b"\r\n\r\n", at) + 4
        head = data[at:end]
        length = int(header(head, "Content-Length"))
        yield head, data[end : end + length]
        at = end + length
        while data[at : at + 1] in (b"\r", b"\n"):
            at += 1
        if at >= len(data):
            return


def arc_to_warc(arc: DataFrame, key: str, path: str) -> None:
    """Write the ARC records as WARC records under ``path``.

    ``key`` is the HTTP header that names a record with a number. Of records with
    equal payloads of at least 100 bytes the one with the smallest number becomes a
    response and the others revisits of it, without payload. Records without a
    number are responses. Records that repeat number and payload fare alike. A record cut off in the
    ARC file is marked as truncated.
    """

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for block in frame["block"]:
                head, payload = split_http(block)
                out.append((header(head, key), hashlib.sha256(payload).hexdigest(), len(payload)))
            found = pd.DataFrame(out, columns=["key", "digest", "size"])
            yield pd.concat([found, frame.reset_index(drop=True)], axis=1)

    records = arc.mapInPandas(digests, f"key string, digest string, size bigint, {_RECORD}")
    # Stored without blocks: these are read once more from the archive.
    narrow = store(records.select(F.col("key").cast("bigint").alias("key"), "digest", "size", "url", "date"))
    large = narrow.where(F.col("size") >= LEAST_REVISIT)
    named = large.where("key IS NOT NULL")
    first = store(named.groupBy("digest").agg(F.min(F.struct("key", "url", "date")).alias("first")))
    keys = named.select("key", "digest").distinct()
    again = store(keys.join(first, "digest").where("key != first.key").select(F.col("key").cast("string").alias("key"), "digest", "first"))
    marked = records.join(again, ["key", "digest"], "left")

    def convert(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[bytes]:
            for frame in frames:
                for r in frame.itertuples(index=False):
                    first = None if r.first_key is None else (r.first_key, r.first_url, r.first_date)
                    yield _converted(r.key, r.digest, first, r.url, r.ip, r.date, r.block, r.whole)

        for file in _files(rows(), _info()):
            yield pd.DataFrame({"file": [file]})

    firsts = [F.col(f"first.{c}").cast("string").alias(f"first_{c}") for c in ("key", "url", "date")]
    columns = ["key", "digest", *firsts, "url", "ip", "date", "block", "whole"]
    _write(marked.select(*columns).mapInPandas(convert, "file binary"), path)


def _info() -> bytes:
    """The record that says what a file is."""
    block = b"software: millrace\r\nformat: WARC File Format 1.1\r\ndescription: converted from ARC\r\n"
    when = warc_date(DATE)
    headers = [
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("warcinfo:", when, hashlib.sha256(block).hexdigest(), "")),
        ("WARC-Date", when), ("Content-Type", "application/warc-fields"),
    ]
    return warc_record(headers, block)


def _converted(key, digest, first, url, ip, date, block, whole=True) -> bytes:
    when = warc_date(date)
    head, _ = split_http(block)
    headers = [
        ("WARC-Type", "revisit" if first is not None else "response"),
        ("WARC-Record-ID", record_id(url, when, digest, key or "")),
        ("WARC-Date", when),
        ("WARC-Target-URI", url),
        ("WARC-IP-Address", ip),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if first is not None:
        number, first_url, first_date = first
        headers += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(first_url, warc_date(first_date), digest, number)),
            ("WARC-Refers-To-Target-URI", first_url),
            ("WARC-Refers-To-Date", warc_date(first_date)),
            ("WARC-Refers-To-Number", number),
        ]
        block = head
    if not whole:
        headers.append(("WARC-Truncated", "unspecified"))
    headers.append(("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"))
    return warc_record(headers, block)


def read_warc(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Records (key, record_id, type, date, url, payload_bytes, payload_digest, refers_to, block).

    The digest of a response is worked out from its payload; a revisit, which has
    none, tells the digest and length of the payload that it stands for.
    """
    columns = ["key", "record_id", "type", "date", "url", "payload_bytes", "payload_digest", "refers_to", "block"]

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for frame in frames:
            for data in frame["content"]:
                for head, block in parse_warc(unzip(data)):
                    http, payload = split_http(block)
                    kind = header(head, "WARC-Type")
                    if kind == "warcinfo":
                        continue
                    if kind == "revisit":
                        size, digest = int(header(http, "Content-Length") or 0), header(head, "WARC-Payload-Digest")[7:]
                    else:
                        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    refers = header(head, "WARC-Refers-To-Number")
                    yield (
                        header(http, key), header(head, "WARC-Record-ID"), kind, header(head, "WARC-Date"),
                        header(head, "WARC-Target-URI"), size, digest, refers, block,
                    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _batched(rows(frames), columns)

    return _archives(spark, path).mapInPandas(
        run,
        "key string, record_id string, type string, date string, url string, payload_bytes bigint, "
        "payload_digest string, refers_to string, block binary",
    )


def page_records(pages: DataFrame, key: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """ARC records of pages: an HTTP answer with the HTML in UTF-8 (null: empty) as payload."""
    given = pages.select(
        F.col(page_id).cast("string").alias("key"), F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("html"),
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            blocks = [
                http_block(
                    [("Content-Type", "text/html; charset=UTF-8"), ("Content-Length", str(len(html)))]
                    + ([(key, number)] if number is not None else []),
                    html,
                )
                for number, html in zip(frame["key"], frame["html"], strict=True)
            ]
            yield pd.DataFrame(
                {"url": frame["url"], "ip": "0.0.0.0", "date": DATE, "mime": "text/html", "block": blocks, "whole": True}
            )

    return given.mapInPandas(run, _RECORD)
