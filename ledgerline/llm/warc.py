"""WARC archives with a two-level capture index.

Writing: every page becomes a record in a gzip member of its own. Of pages with equal
payloads the smallest ``page_id`` is a response, the others are revisits that refer to
it and carry no payload. Tasks write archives of about ``ROLL_BYTES`` into the shared
folder under names of their own attempt; only the captures that Spark commits name them.

Index: captures are range-partitioned and sorted by (reversed-host URL key, page id).
Each partition writes one index file: compressed blocks of ``BLOCK_LINES`` lines, then
the sparse directory of the blocks' first keys. The first key of every file is the upper
level. A lookup picks the file by binary search, then the block, reads that one range,
and finds the captures in it; records are then read by range, in file order.

Rows: a null html counts as empty and is a payload like others; a null url has the empty
key; a null ``page_id`` is larger than any other, so its record is a response only where
no page with an id has the payload, and ``refers_to`` is then null; rows that repeat id
and payload are all of the type of the first; an empty table gives no rows; only
``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, settled, slices, written

ROLL_BYTES = 64 << 20
BLOCK_LINES = 512
#: Neighbouring records read in one range, at most.
READ_BYTES = 4 << 20
GZIP_LEVEL = 4
#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_URN = "urn:page:"


def url_key(url: str | None) -> str:
    """Reversed-host key: ``https://www.a.org:443/x#y`` becomes ``org,a,www)/x``."""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url or "").partition("#")[0]
    m = re.match(r"(?:[^/?]*@)?([^/?]*)(.*)", rest, re.S)
    host = re.sub(r":(80|443)?$", "", m[1].lower())
    name, _, port = host.partition(":")
    key = ",".join(reversed(name.split("."))) + (f":{port}" if port else "")
    return re.sub(r"[\x00-\x20\x7f]", lambda c: quote(c[0]), f"{key}){m[2] or '/'}") if rest else ""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Date", DATE),
            ("WARC-Payload-Digest", "sha1:" + payload_digest(payload)),
            ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    if page is not None:
        head.insert(1, ("WARC-Record-ID", f"<{_URN}{quote(page, safe='')}>"))
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    if revisit:
        head.append(("WARC-Profile", REVISIT_PROFILE))
        if refers_to is not None:
            head.append(("WARC-Refers-To", f"<{_URN}{quote(refers_to, safe='')}>"))
    raw = VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Record headers, HTTP head and payload of one gzip member."""
    raw = zlib.decompress(member, 31)
    if not raw.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, http, payload


def _page(headers: dict[str, str], name: str) -> str | None:
    value = headers.get(name)
    return None if value is None else unquote(value[1 + len(_URN):-1])


def _filesystem(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root if "://" in root or not root.startswith("file:") else root.replace("file:", "file://", 1))


def _folder(root: str) -> tuple[fs.FileSystem, str]:
    store, path = _filesystem(root)
    store.create_dir(path, recursive=True)
    return store, path


CAPTURE = "key string, page string, file string, offset long, length long"


def write_archives(spark: SparkSession, pages: DataFrame, root: str, least_bytes: int = 0) -> DataFrame:
    """Write the pages' records under ``root``; returns their captures (committed, read back).

    Payloads of fewer than ``least_bytes`` bytes are always responses.
    """
    src = pages.select(F.col("page_id"), F.col("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    src = src.withColumn("sha", F.sha2("html", 256))
    first = src.where(F.octet_length("html") >= least_bytes).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    rows = src.join(first.select("sha", "first"), "sha", "left").select(
        F.col("page_id").cast("string").alias("page"), "url", "html", F.col("first").cast("string").alias("first"),
        (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"))

    def run(batches):
        store, folder = _folder(root)
        ctx = TaskContext.get()
        out, name, at, turn = None, "", 0, 0
        try:
            for b in slices(batches, "html"):
                found = {k: [] for k in ("key", "page", "file", "offset", "length")}
                for page, url, html, first_page, revisit in zip(*(c.to_pylist() for c in b.columns)):
                    if out is None:
                        name, at = f"part-{ctx.partitionId():05d}-{ctx.taskAttemptId()}-{turn:05d}.warc.gz", 0
                        out, turn = store.open_output_stream(f"{folder}/{name}", compression=None), turn + 1
                    member = record(page, url, html.encode("utf-8", "replace"), first_page, revisit)
                    out.write(member)
                    for k, v in zip(found, (url_key(url), page or "", name, at, len(member))):
                        found[k].append(v)
                    at += len(member)
                    if at >= ROLL_BYTES:
                        out.close()
                        out = None
                yield pa.RecordBatch.from_pydict(found, pa.schema([("key", pa.string()), ("page", pa.string()), ("file", pa.string()),
                                                                   ("offset", pa.int64()), ("length", pa.int64())]))
        finally:
            if out is not None:
                out.close()

    return written(spark, rows.mapInArrow(run, CAPTURE), "captures")


def build_index(spark: SparkSession, captures: DataFrame, root: str) -> list[tuple[tuple[str, str], str]]:
    """Write the sorted index files; returns the upper level: first key and name of each file.

    One entry a file (at most as many as shuffle partitions), so it is small enough to be sent to every task.
    """
    ordered = captures.repartitionByRange("key", "page").sortWithinPartitions("key", "page", "file", "offset")

    def run(batches):
        store, folder = _folder(root)
        ctx = TaskContext.get()
        name = f"index-{ctx.partitionId():05d}-{ctx.taskAttemptId()}.cdx"
        out, at, lines, directory = None, 0, [], []

        def flush():
            nonlocal at, lines
            if lines:
                data = zlib.compress("\n".join(json.dumps(x) for x in lines).encode(), 6)
                directory.append([*lines[0][:2], at, len(data)])
                out.write(data)
                at += len(data)
                lines = []

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    out = store.open_output_stream(f"{folder}/{name}", compression=None)
                lines.append(row)
                if len(lines) >= BLOCK_LINES:
                    flush()
        if out is None:
            return
        flush()
        data = zlib.compress(json.dumps(directory).encode(), 6)
        out.write(data + len(data).to_bytes(8, "big"))
        out.close()
        yield pa.RecordBatch.from_pydict({"key": [directory[0][0]], "page": [directory[0][1]], "file": [name]})

    files = written(spark, ordered.mapInArrow(run, "key string, page string, file string"), "index-files")
    return sorted(((r["key"], r["page"]), r["file"]) for r in files.collect())


class IndexFile:
    """One index file: its block directory, and lookups by range reads of single blocks."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_input_file(path)
        size = self.file.size()
        n = int.from_bytes(self.file.read_at(8, size - 8), "big")
        self.directory = json.loads(zlib.decompress(self.file.read_at(n, size - 8 - n)))
        self.first = [tuple(d[:2]) for d in self.directory]
        self.held, self.rows, self.keys = -1, [], []

    def block(self, k: int) -> None:
        if k != self.held:
            self.held = k
            data = zlib.decompress(self.file.read_at(self.directory[k][3], self.directory[k][2]))
            self.rows = [json.loads(line) for line in data.decode().split("\n")]
            self.keys = [tuple(r[:2]) for r in self.rows]

    def find(self, key: tuple[str, str]) -> Iterator[list]:
        """All captures of the key."""
        k = max(0, bisect_left(self.first, key) - 1)      # captures of one key may begin in the block before
        while k < len(self.first) and self.first[k] <= key:
            self.block(k)
            yield from self.rows[bisect_left(self.keys, key):bisect_right(self.keys, key)]
            k += 1


def lookup(wanted: DataFrame, index: list[tuple[tuple[str, str], str]], root: str) -> DataFrame:
    """Captures of the distinct (``url``, ``page``) pairs of ``wanted``, found through the index under ``root``."""
    bounds = [k for k, _ in index]

    def shards(batches):
        for b in batches:
            keys = [(url_key(u), p or "") for u, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            # captures of one key may begin at the end of the file before
            last = [bisect_right(bounds, k) - 1 for k in keys]
            first = [max(0, bisect_left(bounds, k) - 1) for k in keys]
            rows = [(s, *k) for k, a, z in zip(keys, first, last) for s in range(a, z + 1)]
            yield pa.RecordBatch.from_pydict({"shard": pa.array([r[0] for r in rows], pa.int32()),
                                              "key": pa.array([r[1] for r in rows], pa.string()),
                                              "page": pa.array([r[2] for r in rows], pa.string())})

    def find(batches):
        store, folder = _folder(root)
        held, file = None, None
        for b in batches:
            found = {k: [] for k in ("key", "page", "file", "offset", "length")}
            for shard, key, page in zip(*(c.to_pylist() for c in b.columns)):
                if shard != held:
                    held, file = shard, IndexFile(store, f"{folder}/{index[shard][1]}")
                for row in file.find((key, page)):
                    for k, v in zip(found, row):
                        found[k].append(v)
            yield pa.RecordBatch.from_pydict(found, pa.schema([("key", pa.string()), ("page", pa.string()), ("file", pa.string()),
                                                               ("offset", pa.int64()), ("length", pa.int64())]))

    spread = wanted.select("url", "page").mapInArrow(shards, "shard int, key string, page string").distinct()
    return spread.repartition("shard").sortWithinPartitions("shard", "key", "page").mapInArrow(find, CAPTURE)


def read_records(captures: DataFrame, root: str) -> DataFrame:
    """The captures' records, read by range in file order; payload sizes and digests are those of the payload read."""
    def run(batches):
        store, folder = _folder(root)
        held, file, start, data = None, None, 0, b""
        for b in batches:
            rows = list(zip(*(b.column(k).to_pylist() for k in range(3))))
            out = {k: [] for k in ("page", "payload_bytes", "payload_digest", "record_type", "refers_to")}
            for n, (name, offset, length) in enumerate(rows):
                if name != held:
                    held, file, data = name, store.open_input_file(f"{folder}/{name}"), b""
                if not (start <= offset and offset + length <= start + len(data)):
                    end = offset + length
                    for other, o, size in rows[n + 1:]:          # adjacent records come with this one
                        if other != name or o != end or o + size - offset > READ_BYTES:
                            break
                        end = o + size
                    start, data = offset, file.read_at(end - offset, offset)
                headers, http, payload = parse(data[offset - start:offset - start + length])
                kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response":
                    size = len(payload)
                    if payload_digest(payload) != digest:
                        raise ValueError(f"{name} at {offset}: payload digest differs")
                else:
                    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                for k, v in zip(out, (_page(headers, "WARC-Record-ID"), size, digest, kind, _page(headers, "WARC-Refers-To"))):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, pa.schema([
                ("page", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                ("record_type", pa.string()), ("refers_to", pa.string())]))

    placed = captures.select("file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset")
    return placed.mapInArrow(run, "page string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write archives and index, look every page up, and read its record back: one row per page."""
    root = scratch(spark, "warc")
    _folder(root)
    index = build_index(spark, write_archives(spark, pages, root), root)
    kind = pages.schema["page_id"].dataType
    wanted = pages.select("url", F.col("page_id").cast("string").alias("page"))
    found = settled(spark, lookup(wanted, index, root))
    return read_records(found, root).select(
        F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))
