"""WARC archives with a two-level capture index.

Writing: pages are dealt into archive files; each task writes its own file (one gzip member for each record, so a
record can be read by its byte range alone) into the shared folder, under a name that no other attempt of the task
uses, and returns one capture line for each record. Only the lines of attempts that succeeded are in the capture
table, so files of lost attempts are never read.

Index: capture lines are sorted by reversed-host URL key (range partitions) and cut into blocks of BLOCK_LINES lines,
each compressed; tasks write the blocks to files of their own. The sparse directory is a table with one row for each
block: its first and last key and its byte range. Reading goes through the directory: block range, lines, record
ranges. A look-up bisects the keys of each part of the directory, reads only the blocks that it finds, bisects their
lines, and then reads the records' ranges; parts are searched by tasks of their own, and nothing is collected.

Payloads of DEDUP_BYTES bytes or more that are equal (SHA-1 and length) are stored once, with the largest page_id;
the other captures are revisit records, which carry headers only and name the response's URL, page and digest (its
record's id isn't known to the task that writes the revisit). A look-up resolves them.

Each archive begins with a warcinfo record. A record's id is made of its archive's name, which no other has, and its
place there, so repeated rows and null ids have ids of their own. The date is when the archive was begun, unless the
pages' capture time is given.

A null html is an empty payload and a null url an empty key. Payloads of any length are whole; equal keys stand in the
order of their ids and places. Repeated rows are records of their own; if they share the largest page_id of an equal
payload, all of them are responses. Empty tables give empty archives, and other columns than id, url and html, whatever
their names, aren't read.
"""

from __future__ import annotations

import bisect
import gzip
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.common import materialise, trimmed, work_path

DEDUP_BYTES = 1000
BLOCK_LINES = 2000
CAPTURE = "surt string, page_id long, file string, start long, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target string"


def surt(url: str) -> str:
    """Reversed-host key of a URL: com,example)/path?query"""
    parts = urlsplit(url.strip())
    host = (parts.hostname or "").removeprefix("www.")
    try:
        port = f":{parts.port}" if parts.port and parts.port not in (80, 443) else ""
    except ValueError:
        port = ""
    query = "?" + "&".join(sorted(parts.query.lower().split("&"))) if parts.query else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path.lower() or "/") + query


def safe_surt(url: str) -> str:
    try:
        return surt(url)
    except ValueError:
        return ")" + url


def open_store(uri: str):
    """(file system, path) of a shared folder's URI, by whatever Arrow can open; Hadoop's names of S3 are Arrow's s3."""
    from pyarrow import fs

    uri = re.sub("^s3[an]://", "s3://", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def record_id(archive: str, place: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{place}')}>"


def member(head: list[str], body: bytes) -> bytes:
    """A record as a gzip member of its own."""
    return gzip.compress("\r\n".join(["WARC/1.1", *head, f"Content-Length: {len(body)}"]).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", 4, mtime=0)


def info(archive: str, date: str) -> bytes:
    """The warcinfo record that an archive begins with."""
    body = b"software: quillstream\r\nformat: WARC File Format 1.1\r\n"
    return member(["WARC-Type: warcinfo", f"WARC-Record-ID: {record_id(archive, 0)}", f"WARC-Date: {date}", f"WARC-Filename: {archive}", "Content-Type: application/warc-fields"], body)


def record(name: str, date: str, page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, refers_to_url: str | None, revisit: bool) -> bytes:
    """One WARC/1.1 record as a gzip member; name: the record's id."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http if revisit else http + payload
    head = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name}",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To-Target-URI: {' '.join((refers_to_url or '').split())}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    return member([*head, "Content-Type: application/http; msgtype=response"], body)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers, and its payload (what follows the HTTP header)."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def plan(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", captured: str | None = None) -> DataFrame:
    """Each page with its digest, its record type, what it refers to and its date; captured: a column of timestamps."""
    date = F.date_format(F.to_utc_timestamp(captured, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'") if captured else F.lit(None).cast("string")
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8")
    told = pages.select(F.col(key).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("size"), F.coalesce(F.col(html), F.lit("")).alias("html"), date.alias("date"))
    large = told.where(F.col("size") >= DEDUP_BYTES)
    first = large.groupBy("digest", "size").agg(F.max("page_id").alias("first"), F.max_by("url", F.struct("page_id", "url")).alias("first_url"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # narrow rows decide; the texts move once, by their ids
    decided = materialise(large.select("page_id", "digest", "size").join(first, ["digest", "size"]).where("page_id is distinct from first").select(F.col("page_id").alias("revisit_id"), F.col("digest").alias("revisit_digest"), "first", "first_url").distinct(), "revisits")
    same = F.col("page_id").eqNullSafe(F.col("revisit_id")) & (F.col("digest") == F.col("revisit_digest"))
    joined = told.join(decided, same, "left")
    return joined.withColumn("revisit", F.col("first").isNotNull()).drop("revisit_id", "revisit_digest")


def write(planned: DataFrame, folder: str) -> DataFrame:
    """Writes the archives; the capture table (surt, page_id, file, start, length), stored in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        store.create_dir(path, recursive=True)
        name = f"pages-{uuid.uuid4().hex}.warc.gz"
        began = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        at, out = 0, None
        try:
            for batch in batches:
                lines = []
                for page_id, url, digest, html, first, first_url, revisit, date in zip(*[batch.column(i).to_pylist() for i in range(8)], strict=True):
                    if out is None:
                        out = store.open_output_stream(f"{path}/{name}", compression=None)
                        head = info(name, began)
                        out.write(head)
                        at = len(head)
                    body = record(record_id(name, at), date or began, page_id, url, html.encode(), digest, first, first_url, revisit)
                    out.write(body)
                    lines.append((safe_surt(url), page_id, name, at, len(body)))
                    at += len(body)
                yield pa.RecordBatch.from_pylist([dict(zip(("surt", "page_id", "file", "start", "length"), x, strict=True)) for x in lines], schema=pa.schema([("surt", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))
        finally:
            if out is not None:
                out.close()

    return materialise(planned.select("page_id", "url", "digest", "html", "first", "first_url", "revisit", "date").mapInArrow(trimmed(run), CAPTURE), "captures")


DIRECTORY = "first_key string, last_key string, n_lines long, file string, start long, length long"


def index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Writes the blocks to the folder; the directory, stored in the shared folder, in the keys' order within and between its parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        store.create_dir(path, recursive=True)
        name = f"captures-{uuid.uuid4().hex}.blocks"
        at, out = 0, None
        waiting: list[tuple] = []

        def written(lines: list[tuple]) -> pa.RecordBatch:
            nonlocal at, out
            if out is None:
                out = store.open_output_stream(f"{path}/{name}", compression=None)
            body = zlib.compress("\n".join(f"{k} {'' if p is None else p} {f} {s} {n}" for k, p, f, s, n in lines).encode())
            out.write(body)
            at += len(body)
            row = [lines[0][0], lines[-1][0], len(lines), name, at - len(body), len(body)]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["first_key", "last_key", "n_lines", "file", "start", "length"])

        try:
            for batch in batches:
                waiting += zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True)
                while len(waiting) >= block_lines:
                    yield written(waiting[:block_lines])
                    waiting = waiting[block_lines:]
            if waiting:
                yield written(waiting)
        finally:
            if out is not None:
                out.close()

    # blanks would part a line's fields; the id and place keep equal keys apart, so that ranges can split a common URL
    keyed = captures.withColumn("surt", F.regexp_replace("surt", r"\s", "%20"))
    ordered = keyed.repartitionByRange("surt", "page_id", "file", "start").sortWithinPartitions("surt", "page_id", "file", "start")
    return materialise(ordered.mapInArrow(trimmed(run), DIRECTORY), "capture-directory")


def lines_of(block: bytes) -> list[tuple[str, int | None, str, int, int]]:
    out = []
    for line in zlib.decompress(block).decode().split("\n"):
        k, p, f, s, n = line.rsplit(" ", 4)
        out.append((k, int(p) if p else None, f, int(s), int(n)))
    return out


class Ranges:
    """Range reads of a folder's files, one of which stays open."""

    def __init__(self, folder: str) -> None:
        self.store, self.path = open_store(folder)
        self.name, self.file = None, None

    def read(self, name: str, start: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.file = name, self.store.open_input_file(f"{self.path}/{name}")
        return self.file.read_at(length, start)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _records(entries: list[tuple], ranges: Ranges) -> Iterator[tuple[tuple, dict[str, str], bytes]]:
    """(capture line, headers, payload): file by file, in the order of the places."""
    for line in sorted(entries, key=lambda e: (e[2], e[3])):
        yield line, *parse(ranges.read(*line[2:]))


def _over_directory(directory: DataFrame, folder: str, chosen: Callable, row: Callable, schema: str) -> DataFrame:
    """Rows of row(line, headers, payload) of the capture lines that chosen(first keys, last keys) finds: (block's number, lines' choice) pairs for a part of the directory."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, ranges = Ranges(folder), Ranges(folder)
        types = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in schema.split(", ")])
        for batch in batches:
            first, last, file, start, length = (batch.column(i).to_pylist() for i in range(5))
            for i, choice in chosen(first, last):
                lines = choice(lines_of(blocks.read(file[i], start[i], length[i])))
                waiting, size = [], 0
                for x in _records(lines, ranges):
                    waiting.append(dict(zip(names, row(*x), strict=True)))
                    size += len(x[2])
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_pylist(waiting, schema=types)
                        waiting, size = [], 0
                yield pa.RecordBatch.from_pylist(waiting, schema=types)
        blocks.close(), ranges.close()

    return directory.select("first_key", "last_key", "file", "start", "length").mapInArrow(trimmed(run), schema)


def read(directory: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives, by the directory: digest and length are taken from the payload where there is one."""
    import hashlib

    def row(_: tuple, f: dict[str, str], payload: bytes) -> tuple:
        response = f["WARC-Type"] == "response"
        return (
            int(f["X-Page-ID"]) if f["X-Page-ID"] else None, len(payload) if response else int(f["X-Payload-Length"]), hashlib.sha1(payload).hexdigest() if response else f["WARC-Payload-Digest"].removeprefix("sha1:"),
            f["WARC-Type"], None if response else int(f["X-Refers-To-Page"]), f["WARC-Target-URI"],
        )

    return _over_directory(directory, folder, lambda first, last: [(i, list) for i in range(len(first))], row, RECORD)


CAPTURED = "surt string, page_id long, record_type string, payload_digest string, refers_to long, refers_to_url string, payload binary"


def search(directory: DataFrame, folder: str, keys: list[str]) -> DataFrame:
    """CAPTURED rows of the captures with the given keys: each part of the directory is bisected for each key, then the blocks found are."""
    asked = sorted(set(keys))

    def chosen(first: list[str], last: list[str]) -> Iterator[tuple[int, Callable]]:
        of: dict[int, list[str]] = {}
        for key in asked:
            for i in range(bisect.bisect_left(last, key), bisect.bisect_right(first, key)):
                of.setdefault(i, []).append(key)
        for i, own in of.items():
            yield i, lambda lines, own=own: [x for k in own for x in lines[bisect.bisect_left(lines, k, key=lambda e: e[0]) : bisect.bisect_right(lines, k, key=lambda e: e[0])]]

    def row(line: tuple, f: dict[str, str], payload: bytes) -> tuple:
        revisit = f["WARC-Type"] == "revisit"
        return line[0], line[1], f["WARC-Type"], f["WARC-Payload-Digest"].removeprefix("sha1:"), int(f["X-Refers-To-Page"]) if revisit else None, f["WARC-Refers-To-Target-URI"] if revisit else None, None if revisit else payload

    return _over_directory(directory, folder, chosen, row, CAPTURED)


#: Keys that one search takes.
KEYS_AT_ONCE = 10_000


def key_of(url: str) -> str:
    return re.sub(r"\s", "%20", safe_surt(url))


def lookup(directory: DataFrame, folder: str, urls: list[str]) -> DataFrame:
    """surt, page_id, record_type, refers_to, payload of the captures of some URLs. A revisit's payload is that of the response it refers to, by a look-up of its own."""
    found = materialise(search(directory, folder, [key_of(u) for u in urls]), "found")
    originals = None
    keys: list[str] = []

    def more() -> DataFrame:
        own = search(directory, folder, keys).where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload").alias("original"))
        return own if originals is None else originals.unionByName(own)

    for r in found.where("refers_to is not null").select("refers_to_url").distinct().toLocalIterator():
        keys.append(key_of(r.refers_to_url))
        if len(keys) == KEYS_AT_ONCE:
            originals, keys = more(), []
    originals = more().dropDuplicates(["refers_to", "payload_digest"])
    return found.join(originals, ["refers_to", "payload_digest"], "left").select("surt", "page_id", "record_type", "refers_to", F.coalesce("payload", "original").alias("payload"))


def archive(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """Writes the archives and their index: (directory, folder)."""
    folder = folder or work_path(pages.sparkSession, "warc")
    return index(write(plan(pages), folder), folder), folder


def round_trip(pages: DataFrame) -> DataFrame:
    directory, folder = archive(pages)
    return read(directory, folder)
