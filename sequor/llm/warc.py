"""Operator 2, WARC archives with a two-level capture index.

Writing: every page becomes one gzip member of a WARC file (one file per task, in
the shared folder). Pages whose payload equals that of a page with a larger id are
revisit records without the payload. Every record gives a capture row (reversed-host
URL key, page, payload digest, file, offset, length).

Index: the captures are range-partitioned and sorted by key; each task writes them
as compressed blocks of ``BLOCK_LINES`` lines to one block file, and beside it the
sparse directory of that file (first key, offset and length of each block).

Reading: a lookup finds the block file by its first key (one key per file is all
that is broadcast: as many as the index has partitions), binary-searches that
file's directory, range-reads one block, binary-searches its lines, and range-reads
the record. A revisit is followed to its response by a second lookup.

Files get a new name per attempt and only the rows that name them count, so a
repeated task or a lost executor leaves orphans, never doubled records.

Defined cases. Null html: empty payload. Null or malformed URL: the key is the URL
as its header holds it, line breaks as blanks and none at the ends (null: empty). Null
page ids are never responses to others. Rows alike in id, URL and payload each get a
record of the same kind. Payloads under ``MIN_REVISIT`` bytes are all responses. Extra
input columns are ignored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored

MIN_REVISIT = 1000
BLOCK_LINES = 512
LEVEL = 3
_DATE = "2020-01-01T00:00:00Z"  # fixed value: the pages carry no time


def _one_line(value: object) -> str:
    """A value as a header holds it and ``parse`` returns it."""
    return str(value).replace("\r", " ").replace("\n", " ").strip()


def surt(url: str | None) -> str:
    """The reversed-host key of a URL: ``com,example,www)/path?query``. It is that of the URL
    as a header holds it, so a key made from a header is the capture's."""
    url = _one_line(url or "")
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url
    if not host:
        return url
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (parts.path or "/")
    return key + (f"?{parts.query}" if parts.query else "")


def _header(fields: list[tuple[str, object]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {_one_line(v)}\r\n" for k, v in fields if v is not None) + "\r\n").encode()


def record(page, url, payload: bytes, digest: str, refers: dict | None) -> bytes:
    """One gzip member: a resource-like response, or a revisit that names the response."""
    body = b"" if refers else payload
    fields = [
        ("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", f"<urn:page:{page}:{digest}>"),
        ("WARC-Date", _DATE), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Page-ID", page), ("Content-Type", "text/html; charset=utf-8"),
    ]
    if refers:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", f"<urn:page:{refers['page']}:{digest}>"), ("WARC-Refers-To-Target-URI", refers["url"])]
    return gzip.compress(_header([*fields, ("Content-Length", len(body))]) + body + b"\r\n\r\n", LEVEL, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of a record."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    return fields, rest[: int(fields["content-length"])]


def _open(folder: str):
    """Filesystem and path of a folder; a path without a scheme is taken as Spark's checkpoint folder names it."""
    return fs.FileSystem.from_uri(folder)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the WARC files and returns their captures: key, page, digest, file, offset, length."""
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"),
                        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.select("page", "url", "payload", F.sha1("payload").alias("digest"))
    narrow = rows.filter(F.octet_length("payload") >= MIN_REVISIT).select("page", "url", "digest")
    keeper = narrow.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page", "url")).alias("of"))
    keeper = keeper.filter("n > 1").select("digest", F.col("of.page").alias("r_page"), F.col("of.url").alias("r_url"))
    revisits = narrow.join(keeper, "digest").filter(~F.col("page").eqNullSafe(F.col("r_page")))
    revisits = revisits.select(F.col("page").alias("p"), F.col("digest").alias("d"), "r_page", "r_url").distinct()
    rows = rows.join(revisits, F.col("page").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left")
    kind = rows.schema["page"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        name, out, at = f"archive-{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                got = []
                for r in batch.slice(lo, 256).to_pylist():
                    out = out or store.open_output_stream(f"{base}/{name}", compression=None)
                    refers = {"page": r["r_page"], "url": r["r_url"]} if r["d"] is not None else None
                    data = record(r["page"], r["url"], r["payload"], r["digest"], refers)
                    out.write(data)
                    got.append((surt(r["url"]), r["page"], r["digest"], name, at, len(data)))
                    at += len(data)
                cols = list(zip(*got, strict=True))
                kinds = [pa.string(), batch.schema.field("page").type, pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                 names=["key", "page", "digest", "file", "offset", "length"])
        if out:
            out.close()

    rows = rows.select("page", "url", "payload", "digest", "d", "r_page", "r_url")
    return rows.mapInArrow(run, f"key string, page {kind}, digest string, file string, offset long, length long")


def _sort_key(key: str, page, digest: str) -> list:
    return [key, "" if page is None else str(page), digest]


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Writes block files and their directories; one row per block file: first (key), file, blocks."""
    rows = captures.withColumn("page_key", F.coalesce(F.col("page").cast("string"), F.lit("")))
    rows = rows.repartitionByRange("key", "page_key", "digest").sortWithinPartitions("key", "page_key", "digest")
    rows = rows.select("key", "page_key", "digest", "file", "offset", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        name, directory, lines, at, out = f"index-{uuid.uuid4().hex}", [], [], 0, None

        def flush() -> None:
            nonlocal at, out
            out = out or store.open_output_stream(f"{base}/{name}.blocks", compression=None)
            data = zlib.compress("\n".join(map(json.dumps, lines)).encode(), 6)
            out.write(data)
            directory.append([lines[0][:3], at, len(data)])
            at += len(data)
            lines.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines.append(list(row))
                if len(lines) == BLOCK_LINES:
                    flush()
        if lines:
            flush()
        if out:
            out.close()
            with store.open_output_stream(f"{base}/{name}.directory", compression=None) as f:
                f.write(zlib.compress(json.dumps(directory).encode()))
            yield pa.RecordBatch.from_pylist([{"first": json.dumps(directory[0][0]), "file": name, "blocks": len(directory)}])

    return rows.mapInArrow(run, "first string, file string, blocks long")


class _Recent(OrderedDict):
    """The last ``most`` values made, by key."""

    def __init__(self, most: int, drop: Callable = lambda x: None):
        super().__init__()
        self.most, self.drop = most, drop

    def get_or(self, key, make: Callable):
        if key in self:
            self.move_to_end(key)
        else:
            self[key] = make()
            if len(self) > self.most:
                self.drop(self.popitem(last=False)[1])
        return self[key]


class CaptureIndex:
    """Lookups by the two-level index, with small caches of what was read last."""

    def __init__(self, folder: str, tops: list[tuple[list, str]]):
        self.store, self.base = _open(folder)
        self.firsts, self.files = [t[0] for t in tops], [t[1] for t in tops]
        self.directories, self.blocks = _Recent(8), _Recent(32)
        self.archives = _Recent(32, lambda f: f.close())
        self.reads = 0

    def _directory(self, name: str) -> list:
        with self.store.open_input_file(f"{self.base}/{name}.directory") as f:
            return json.loads(zlib.decompress(f.read()))

    def _range(self, path: str, offset: int, length: int) -> bytes:
        self.reads += 1
        f = self.archives.get_or(path, lambda: self.store.open_input_file(f"{self.base}/{path}"))
        return f.read_at(length, offset)

    def find(self, key: list) -> list | None:
        """The capture line of exactly this (key, page, digest)."""
        i = bisect.bisect_right(self.firsts, key) - 1
        if i < 0:
            return None
        name = self.files[i]
        directory = self.directories.get_or(name, lambda: self._directory(name))
        b = bisect.bisect_right(directory, key, key=lambda e: e[0]) - 1
        if b < 0:
            return None
        _, offset, length = directory[b]
        lines = self.blocks.get_or((name, b), lambda: [
            json.loads(x) for x in zlib.decompress(self._range(f"{name}.blocks", offset, length)).decode().split("\n")])
        j = bisect.bisect_left(lines, key, key=lambda e: e[:3])
        return lines[j] if j < len(lines) and lines[j][:3] == key else None

    def read(self, key: list) -> tuple[dict[str, str], bytes] | None:
        line = self.find(key)
        return line and parse(self._range(line[3], line[4], line[5]))


def read_back(captures: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """Every capture looked up in the index and read from its archive: page, payload_bytes,
    payload_digest (computed from the payload read), record_type, refers_to."""
    tops = sorted((json.loads(r["first"]), r["file"]) for r in index.select("first", "file").collect())
    kind = captures.schema["page"].dataType.simpleString()
    keys = captures.select("key", "page", "digest").repartitionByRange("key", "page", "digest").sortWithinPartitions("key", "page", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, responses = CaptureIndex(folder, tops), _Recent(256)
        for batch in batches:
            pages, got = batch.column("page"), []
            for key, page, digest in zip(batch.column("key").to_pylist(), pages.to_pylist(), batch.column("digest").to_pylist(), strict=True):
                fields, body = found.read(_sort_key(key, page, digest))
                refers = None
                if fields["warc-type"] == "revisit":
                    refers = fields["warc-refers-to"].split(":")[2]
                    target = _sort_key(surt(fields.get("warc-refers-to-target-uri")), refers, digest)

                    def follow(target=target):
                        body = found.read(target)[1]
                        return len(body), hashlib.sha1(body).hexdigest()

                    size, sha = responses.get_or(tuple(target), follow)
                else:
                    size, sha = len(body), hashlib.sha1(body).hexdigest()
                got.append((size, sha, fields["warc-type"], refers))
            sizes, shas, types, refers = zip(*got, strict=True) if got else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pages, pa.array(sizes, pa.int64()), pa.array(shas, pa.string()), pa.array(types, pa.string()),
                 pa.array(refers, pa.string())], names=["page", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    out = keys.mapInArrow(run, f"page {kind}, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return out.withColumn("refers_to", F.col("refers_to").cast(kind))


def round_trip(pages: DataFrame) -> DataFrame:
    """The digest of query op2: archives and index written, every page read back."""
    folder = scratch_path(pages.sparkSession, "warc")
    store, base = _open(folder)
    store.create_dir(base, recursive=True)
    captures = stored(write_archives(pages, folder), "warc-captures")
    index = stored(write_index(captures, folder), "warc-index")
    return read_back(captures, index, folder).withColumnRenamed("page", "page_id")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
k AS (SELECT payload_digest, max(page_id) AS keeper FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT d.page_id, payload_bytes, d.payload_digest,
  CASE WHEN keeper IS NULL OR keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM d LEFT JOIN k ON d.payload_digest = k.payload_digest AND d.payload_bytes >= 1000
"""
