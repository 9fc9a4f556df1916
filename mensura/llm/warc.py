"""WARC archives with a two-level capture index.

Archives hold one gzip member per record.  Captures are sorted by reversed-host
URL key and record number into index files of compressed blocks; at the end of
each index file stands its block directory, one entry for a block's first key.
A lookup searches the list of index files (one row each), then binary-searches
a file's directory, reads one block by its range, and with the line found there
one record by its range.

Files go to the shared folder through ``pyarrow.fs`` (any store it knows).  A
task that is repeated writes files of new names; only those that the written
lists name are ever read.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_path, staged, table

#: Payloads of fewer bytes are always stored whole.
LEAST_REVISIT = 100
BLOCK_LINES = 300
#: Captures in an index file, requests in a lookup task, about; beyond
#: ``MAX_TASKS`` of either, more go to each, so that the list of index files,
#: which every task holds, stays short.
FILE_CAPTURES, TASK_LOOKUPS, MAX_TASKS = 200_000, 4_000, 20_000
#: Bytes of payloads that a task hands on at a time (or one payload).
SLICE_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"


def url_key(url: Column) -> Column:
    """Reversed host, then the rest: ``org,example,www:8080)/path?q``.

    Scheme and user are left out, the host is in small letters; a null or
    hostless URL has the key of an empty host.
    """
    url = F.coalesce(url, F.lit(""))
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?(.*)$"
    host = F.lower(F.regexp_extract(url, pattern, 1))
    rest = F.when(F.rlike(url, F.lit(pattern)), F.regexp_extract(url, pattern, 3)).otherwise(url)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.regexp_extract(url, pattern, 2), F.lit(")"), rest)


def filesystem(path: str):
    """(pyarrow file system, path in it) of a folder as Spark names it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, digest: str, date: str = DATE) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit."""
    url = "".join(c for c in url if c not in "\r\n")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Target-URI: {url}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http; msgtype=response"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = http if refers_to is not None else http + payload
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of a record: page_id, type, refers_to, digest, bytes, payload
    (of a revisit: None; digest and bytes are those it states)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    page, digest = fields["WARC-Record-ID"][len("<urn:page:"):-1], fields["WARC-Payload-Digest"][len("sha256:"):]
    refers = fields.get("WARC-Refers-To")
    if refers is None and (len(payload) != stated or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of page {page} is not the one written")
    return {"page_id": int(page) if page else None, "type": fields["WARC-Type"], "refers_to": int(refers[len("<urn:page:"):-1]) if refers else None,
            "digest": digest, "bytes": stated, "payload": None if refers else payload}


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, first): pages whose payload a smaller page_id holds."""
    marks = staged(pages.select("page_id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("n")), "op7-digests")
    long = marks.where(F.col("n") >= LEAST_REVISIT)
    shared = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1 AND first IS NOT NULL")
    return (long.join(shared.select(F.col("digest").alias("d"), "first"), F.col("digest") == F.col("d"))
            .where(~F.col("page_id").eqNullSafe(F.col("first"))).select("page_id", "digest", "first").distinct())


def write_archives(pages: DataFrame) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, payload binary) and
    return the captures: key, page_id, file, offset, length."""
    folder = shared_path(pages.sparkSession, "op7-archives")
    again = revisits(pages).select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "first")
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), "payload", url_key(F.col("url")).alias("key"), F.sha2("payload", 256).alias("digest"))
    rows = rows.join(again, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left").select("page_id", "url", "payload", "digest", "first", "key")
    names = ["key", "page_id", "file", "offset", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        name, out, at = f"{root}/{uuid.uuid4().hex}.warc.gz", None, 0
        for rb in batches:
            if not rb.num_rows:
                continue
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(name, compression=None)
            where = []
            for i in range(rb.num_rows):  # one payload in Python at a time
                page, url, payload, digest, first = (c[i].as_py() for c in rb.columns[:5])
                member = gzip.compress(record(page, url, payload, first, digest), 6, mtime=0)
                out.write(member)
                where.append((at, len(member)))
                at += len(member)
            offset, length = (pa.array(x, pa.int64()) for x in zip(*where))
            yield pa.RecordBatch.from_arrays([rb.column(5), rb.column(0), pa.array([name] * rb.num_rows), offset, length], names)
        if out is not None:
            out.close()

    return staged(rows.mapInArrow(run, "key string, page_id long, file string, offset long, length long"), "op7-captures")


def _order(key: str, page: int | None) -> tuple[str, int]:
    """Captures in Spark's order: key, then page_id, null first."""
    return key, -2**63 if page is None else page


def _tasks(rows: int, each: int) -> int:
    return min(MAX_TASKS, max(1, -(-rows // each)))


def write_index(captures: DataFrame) -> DataFrame:
    """Sort the captures into index files; return their list: file, first and
    last (key and page_id), place and length of the directory."""
    folder = shared_path(captures.sparkSession, "op7-index")
    names = ["file", "first", "last", "offset", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        name, out, at, lines, directory, last = f"{root}/{uuid.uuid4().hex}.idx.gz", None, 0, [], [], None

        def flush() -> None:
            nonlocal at, lines
            block = gzip.compress("\n".join(lines).encode(), 6, mtime=0)
            directory.append([*json.loads(lines[0])[:2], at, len(block)])
            out.write(block)
            at, lines = at + len(block), []

        for rb in batches:
            for row in zip(*(c.to_pylist() for c in rb.columns)):
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(name, compression=None)
                lines.append(json.dumps(row))
                last = row[:2]
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is not None:
            if lines:
                flush()
            trailer = gzip.compress(json.dumps(directory).encode(), 6, mtime=0)
            out.write(trailer)
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([json.dumps(directory[0][:2])]), pa.array([json.dumps(last)]),
                                              pa.array([at], pa.int64()), pa.array([len(trailer)], pa.int64())], names)

    ordered = (captures.select("key", "page_id", "file", "offset", "length")
               .repartitionByRange(_tasks(captures.count(), FILE_CAPTURES), "key", "page_id").sortWithinPartitions("key", "page_id"))
    return staged(ordered.mapInArrow(run, "file string, first string, last string, offset long, length long"), "op7-index-files")


class Reader:
    """Finds captures by key and page_id and reads their records; keeps the
    directory and block it read last."""

    def __init__(self, folder: str, files: list[tuple[str, tuple, tuple, int, int]]):
        self.store, _ = filesystem(folder)
        self.files = sorted(files, key=lambda f: f[1])
        self.lasts = [f[2] for f in self.files]
        self.kept: dict[str, tuple] = {}
        self.open_file: tuple[str, object] = ("", None)

    def range(self, file: str, offset: int, length: int) -> bytes:
        if self.open_file[0] != file:
            self.open_file = (file, self.store.open_input_file(file))
        return gzip.decompress(self.open_file[1].read_at(length, offset))

    def _once(self, level: str, *place) -> list:
        if self.kept.get(level, (None,))[0] != place:
            data = self.range(*place).decode()
            self.kept[level] = (place, json.loads(data) if level == "directory" else [json.loads(x) for x in data.split("\n")])
        return self.kept[level][1]

    def find(self, key: str, page: int | None) -> Iterator[bytes]:
        """Records of all captures under a key and page_id."""
        want = _order(key, page)
        for f in range(bisect_left(self.lasts, want), len(self.files)):
            file, first, _, offset, length = self.files[f]
            if first > want:
                return
            directory = self._once("directory", file, offset, length)
            starts = [_order(*d[:2]) for d in directory]
            for b in range(max(0, bisect_left(starts, want) - 1), len(directory)):
                if starts[b] > want:
                    return
                lines = self._once("block", file, *directory[b][2:])
                own = [_order(*x[:2]) for x in lines]
                for line in lines[bisect_left(own, want):]:
                    if _order(*line[:2]) != want:
                        break
                    yield self.range(*line[2:])


def lookup(requests: DataFrame, index: DataFrame) -> DataFrame:
    """Records under the requested (key, page_id): page_id, payload_bytes,
    payload_digest, record_type, refers_to, payload (null for a revisit).

    Requests are sorted like the index, so that a task reads a block once, and
    dealt out by their number: a request is short, its range read is not.
    """
    files = [(r["file"], _order(*json.loads(r["first"])), _order(*json.loads(r["last"])), r["offset"], r["length"]) for r in index.collect()]
    folder = shared_path(requests.sparkSession, "op7-any")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(folder, files)
        for rb in batches:
            found, held = [], 0
            for key, page in zip(*(c.to_pylist() for c in rb.columns)):
                for x in reader.find(key, page):
                    found.append(parse(x))
                    held += len(x)
                    if held >= SLICE_BYTES:
                        yield batch(found)
                        found, held = [], 0
            yield batch(found)

    def batch(found: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in
                                           zip(("page_id", "bytes", "digest", "type", "refers_to", "payload"), types)], names)

    asked = staged(requests.select("key", "page_id").distinct(), "op7-requests")
    ordered = asked.repartitionByRange(_tasks(asked.count(), TASK_LOOKUPS), "key", "page_id").sortWithinPartitions("key", "page_id")
    return ordered.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """Write all pages, index them, and read every record back by its key.

    A null html is an empty payload, a null url an empty one; repeated rows
    have a record each; an empty table has no archives and no rows.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    captures = write_archives(pages)
    index = write_index(captures)
    return lookup(captures.select("key", "page_id"), index).drop("payload")


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT *, octet_length(encode(html)) AS n, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM g
"""
