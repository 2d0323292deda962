"""WARC archives with a two-level capture index.

``write_archives`` writes one gzip member per record.  Of records with equal
payloads (of at least ``min_bytes``) the one with the smallest id is the
``response``; the others are ``revisit`` records that refer to it and keep only
the HTTP header.

``build_index`` sorts the captures by reversed-host URL key (``com,example)/path``)
into range partitions.  Each becomes one index file: compressed blocks of
``BLOCK_LINES`` sorted lines, then a sparse directory with the first key and
place of every block, then the directory's place.  ``lookup`` binary-searches
the files' key ranges, a file's directory and one block before any record is
touched; ``read_records`` fetches records by range reads, in file order, so
neighbouring records share a read.

Files are written under names that are unique to the task attempt and only the
names in the committed manifest belong to the archive, so a lost or repeated
task leaves at most an unreferenced file.  The folder must be reachable from
all executors by its URI (``file:``, ``hdfs:``, ``s3:``, ``gs:``).

Cases: a null payload is empty (0 bytes); a null URL has the empty key and no
target header; a null id never is the smallest and its record refers to the
response of its payload if there is one, else it is a response; rows with equal
id and payload have the same role; a key may have any number of captures, over
several blocks and files; an empty table makes an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import quoted, read_table
from tessera.llm.urls import host_of
from tessera.session import scratch_path

BLOCK_LINES = 2048
MAX_FILE_BYTES = 1 << 30
READ_AHEAD = 1 << 20
SEGMENT_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "key string, record_id string, file string, offset long, length long"


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def url_key(url: Column) -> Column:
    """Reversed host, ``)``, then all that follows the host; empty for null or without ``://``."""
    rest = F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([\s\S]*)$", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host_of(url), r"\.", -1)), ","), F.lit(")"), rest)
    return F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, key).otherwise(F.lit(""))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(record_id: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC/1.1 record; ``refers_to`` makes it a revisit without its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-record:{'' if record_id is None else record_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
    ]
    if url is not None:
        # Line breaks cannot stand in a header; percent-encode them.
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-record:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, body) of one record, names lower-cased."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    return warc, _headers(http), body


def _headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(": ")
        out[name.lower()] = value
    return out


def _urn(value: str | None) -> str | None:
    return value.removeprefix("<urn:x-record:").removesuffix(">") or None if value else None


def roles(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Add ``refers_to``: the response's id for revisits, else null.  Columns: record_id, url, payload (binary)."""
    known = pages.withColumn("digest", F.sha1("payload"))
    # Pre-aggregated per digest; only payloads that occur twice come back, so a hot payload is one row here.
    first = (
        known.where(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("record_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .select("digest", "first_id")
    )
    joined = known.join(first, "digest", "left")
    return joined.select(
        "record_id", "url", "payload", F.when(~F.col("first_id").eqNullSafe(F.col("record_id")), F.col("first_id")).alias("refers_to")
    )


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0
) -> DataFrame:
    """Write the archives under ``folder``; returns the committed manifest: ``key, record_id, file, offset, length``."""
    rows = pages.select(
        quoted(id_col).alias("record_id"),
        quoted(url_col).alias("url"),
        F.coalesce(quoted(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    )
    ready = roles(rows, min_bytes).select(
        F.col("record_id").cast("string"), "url", "payload", F.col("refers_to").cast("string"), url_key(F.col("url")).alias("key")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        out = name = None
        at = 0
        try:
            for batch in batches:
                done: list[tuple] = []
                for rid, url, payload, refers, key in zip(*batch.columns, strict=True):
                    if out is None or at >= MAX_FILE_BYTES:
                        if out is not None:
                            out.close()
                        else:
                            fs.create_dir(f"{base}/warc", recursive=True)
                        name, at = f"warc/{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = pack.compress(record(rid.as_py(), url.as_py(), payload.as_py(), refers.as_py())) + pack.flush()
                    out.write(member)
                    done.append((key.as_py(), rid.as_py(), name, at, len(member)))
                    at += len(member)
                yield _batch(done, MANIFEST_ARROW)
        finally:
            if out is not None:
                out.close()

    path = f"{folder}/manifest"
    ready.mapInArrow(write, MANIFEST).write.parquet(path)
    return pages.sparkSession.read.schema(MANIFEST).parquet(path)


MANIFEST_ARROW = pa.schema([("key", pa.string()), ("record_id", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
SHARDS = "file string, first string, last string, lines long"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def build_index(manifest: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the index files; returns the committed table of files: ``file, first, last, lines`` (one row per file)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        out, directory, lines, total, at, last = None, [], [], 0, 0, None
        name = f"index/{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.idx"

        def flush() -> None:
            nonlocal at
            block = zlib.compress(json.dumps(lines, ensure_ascii=False, separators=(",", ":")).encode())
            out.write(block)
            directory.append((lines[0][0], at, len(block)))
            at += len(block)
            lines.clear()

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if out is None:
                    fs.create_dir(f"{base}/index", recursive=True)
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                lines.append(row)
                last = row[0]
                total += 1
                if len(lines) >= block_lines:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        packed = zlib.compress(json.dumps(directory, ensure_ascii=False).encode())
        out.write(packed + struct.pack("<QQ", at, len(packed)))
        out.close()
        yield pa.RecordBatch.from_pydict({"file": [name], "first": [directory[0][0]], "last": [last], "lines": pa.array([total], pa.int64())})

    order = ["key", "record_id", "file", "offset"]
    path = f"{folder}/shards"
    manifest.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, SHARDS).write.parquet(path)
    return manifest.sparkSession.read.schema(SHARDS).parquet(path)


class IndexFile:
    """One index file: its directory in memory, one decompressed block at a time."""

    def __init__(self, fs: pafs.FileSystem, path: str) -> None:
        self.source = fs.open_input_file(path)
        size = self.source.size()
        at, length = struct.unpack("<QQ", self.source.read_at(16, size - 16))
        self.directory = json.loads(zlib.decompress(self.source.read_at(length, at)))
        self.firsts = [d[0].encode() for d in self.directory]
        self.held, self.lines, self.keys = -1, [], []

    def block(self, k: int) -> None:
        if k != self.held:
            _, at, length = self.directory[k]
            self.lines = json.loads(zlib.decompress(self.source.read_at(length, at)))
            self.keys = [x[0].encode() for x in self.lines]
            self.held = k

    def find(self, key: bytes) -> Iterator[list]:
        """All lines of a key: from the last block that starts before it, while blocks start at or before it."""
        k = max(0, bisect_left(self.firsts, key) - 1)
        while k < len(self.firsts) and self.firsts[k] <= key:
            self.block(k)
            i = bisect_left(self.keys, key)
            while i < len(self.keys) and self.keys[i] == key:
                yield self.lines[i]
                i += 1
            k += 1


def lookup(keys: DataFrame, shards: DataFrame, folder: str) -> DataFrame:
    """The captures of every distinct ``key``: ``key, record_id, file, offset, length``.

    The table of index files (one row per file) is the only thing shipped to
    the tasks.  Keys are range-partitioned and sorted, so a task reads few
    files and each block once, however the keys are spread.
    """
    files = sorted((r["first"].encode(), r["last"].encode(), r["file"]) for r in shards.collect())
    shared = keys.sparkSession.sparkContext.broadcast(files)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        table = shared.value
        firsts = [x[0] for x in table]
        open_name, index = None, None
        found: list[tuple] = []
        for batch in batches:
            for key in batch.column(0).cast(pa.binary()).to_pylist():
                # Files are in key order: the first that can hold the key, then on while they start at or before it.
                k = max(0, bisect_left(firsts, key) - 1)
                for first, last, name in table[k : bisect_right(firsts, key)]:
                    if not first <= key <= last:
                        continue
                    if name != open_name:
                        open_name, index = name, IndexFile(fs, f"{base}/{name}")
                    for line in index.find(key):
                        found.append(tuple(line))
                        if len(found) >= 8192:
                            yield _batch(found, MANIFEST_ARROW)
                            found = []
        if found:
            yield _batch(found, MANIFEST_ARROW)

    wanted = keys.select("key").where("key IS NOT NULL").distinct().repartitionByRange("key").sortWithinPartitions("key")
    return wanted.mapInArrow(search, MANIFEST)


RECORDS = pa.schema(
    [
        ("record_id", pa.string()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.string()),
        ("payload", pa.binary()),
    ]
)


def read_records(captures: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Read captures by range: ``record_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]``.

    A revisit's payload is null; its size and digest are those its headers
    state for the full payload.  A response whose payload does not have the
    stated digest fails the read.
    """
    schema = RECORDS if with_payload else RECORDS.remove(6)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        name = source = None
        start, buffer = 0, b""
        for batch in batches:
            out: list[tuple] = []
            for file, offset, length in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if file != name:
                    name, source, start, buffer = file, fs.open_input_file(f"{base}/{file}"), 0, b""
                if not start <= offset <= offset + length <= start + len(buffer):
                    start, buffer = offset, source.read_at(max(length, READ_AHEAD), offset)
                member = buffer[offset - start : offset - start + length]
                warc, http, body = parse_record(zlib.decompress(member, 31))
                digest = warc["warc-payload-digest"].removeprefix("sha1:")
                revisit = warc["warc-type"] == "revisit"
                if not revisit and base32_sha1(body) != digest:
                    raise ValueError(f"payload digest mismatch in {file} at {offset}")
                row = (
                    _urn(warc["warc-record-id"]),
                    warc.get("warc-target-uri"),
                    int(http["content-length"]) if revisit else len(body),
                    digest,
                    warc["warc-type"],
                    _urn(warc.get("warc-refers-to")),
                )
                out.append((*row, None if revisit else body) if with_payload else row)
            yield _batch(out, schema)

    # A stretch of a file per group: tasks read forward and none holds a whole large file's records.
    segment = F.floor(F.col("offset") / SEGMENT_BYTES)
    near = captures.repartition("file", segment).sortWithinPartitions("file", "offset").select("file", "offset", "length")
    ddl = "record_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    return near.mapInArrow(read, ddl + (", payload binary" if with_payload else ""))


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = scratch_path(spark, "warc")
    manifest = write_archives(pages, folder)
    shards = build_index(manifest, folder)
    captures = lookup(pages.select(url_key(F.col("url")).alias("key")), shards, folder)
    back = read_records(captures, folder, with_payload=False)
    return back.select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to")
    )


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT page_id, body, h, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(strpos('0123456789abcdef', substr(h, i, 1)) - 1), 4, '0')), '') AS bits FROM p),
f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT)
    + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT) + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM b JOIN f USING (h)
"""
