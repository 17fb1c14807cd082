"""WARC archives of pages with a two-level capture index.

Archives hold one gzip member per record; equal payloads are stored once and
revisited.  The index sorts captures by reversed-host URL keys into compressed
blocks; each index file ends with a sparse directory of its blocks.  A look-up
binary-searches the files' first keys, then one file's directory, then one block,
and reads the records' byte ranges.  Many urls are looked up as a join with the index:
their keys are dealt to the files that may hold them and searched there in order.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import groupby, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import dealt_evenly, file_system, saved, scan_tasks, text_slices, write_file

#: Payloads of fewer bytes are always stored.
LEAST_REVISIT = 100
#: Captures in a block of the index.
BLOCK_LINES = 2000
#: Compression of records and blocks.
LEVEL = 1
TAIL = "<QI4s"
MAGIC = b"CIDX"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- records -----------------------------------------------------------------

def _line(value: str) -> str:
    """A header value: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, compressed as a gzip member of its own; a revisit has no payload."""
    kind = "response" if refers_to is None else "revisit"
    block = HTTP + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}",
             f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {digest}')}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}",
             f"X-Payload-Bytes: {len(payload)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {_line(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page: {refers_to}",
                  f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{refers_to} {digest}')}>"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a compressed record; a response's payload is verified."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(headers["Content-Length"])]
    payload = block[block.index(b"\r\n\r\n") + 4:]
    if headers["WARC-Type"] == "response" and f"sha256:{sha256(payload).hexdigest()}" != headers["WARC-Payload-Digest"]:
        raise ValueError("a payload does not have its digest")
    return headers, payload


def url_key(url: str | None) -> str:
    """The host's labels in reverse, then path and query; no scheme, no fragment."""
    rest = (url or "").split("://", 1)[-1].split("#", 1)[0]
    cut = min((rest.index(c) for c in "/?" if c in rest), default=len(rest))
    host = rest[:cut].lower()
    return _line(",".join(reversed(host.split("."))) + ")" + (rest[cut:] or "/"))


class ArchiveWriter:
    """A part file that gets its name when it is whole."""

    def __init__(self, path: str):
        self.store, self.name = file_system(path)
        self.store.create_dir(self.name.rsplit("/", 1)[0], recursive=True)
        self.part = f"{self.name}.{uuid.uuid4().hex}.part"
        self.out, self.at = self.store.open_output_stream(self.part), 0

    def add(self, member: bytes) -> int:
        begin = self.at
        self.out.write(member)
        self.at += len(member)
        return begin

    def close(self) -> None:
        self.out.close()
        self.store.move(self.part, self.name)


# --- writing -----------------------------------------------------------------

def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row; gives ``key, page_id, archive, begin, size``."""
    text = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", text.alias("text"), F.sha2(text, 256).alias("digest"),
                        F.octet_length(text).alias("bytes"))
    seen = rows.select("page_id", "digest", "bytes").distinct()
    first = (seen.filter(F.col("bytes") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first")))
    role = (seen.join(first, "digest", "left")
            .select(F.col("page_id").alias("id"), F.col("digest").alias("of"),
                    F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")))
    role = saved(role, "warc-roles")
    placed = (rows.join(role, rows.page_id.eqNullSafe(role.id) & (rows.digest == role.of))
              .select("page_id", "url", "text", "digest", "refers_to")
              .sortWithinPartitions(F.asc_nulls_first("page_id"), "digest", "url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, writer = TaskContext.get().partitionId(), None
        for batch in text_slices(batches):
            keys, begins, sizes = [], [], []
            for r in batch.to_pylist():
                writer = writer or ArchiveWriter(f"{folder}/pages-{number:06d}.warc.gz")
                member = record(r["page_id"], r["url"], r["text"].encode(), r["digest"], r["refers_to"])
                keys.append(url_key(r["url"]))
                begins.append(writer.add(member))
                sizes.append(len(member))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), batch.column("page_id"), pa.array([number] * len(keys), pa.int32()),
                 pa.array(begins, pa.int64()), pa.array(sizes, pa.int64())],
                ["key", "page_id", "archive", "begin", "size"])
        if writer:
            writer.close()

    return saved(placed.mapInArrow(run, "key string, page_id long, archive int, begin long, size long"), "warc-captures")


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write the index files; gives ``number, first_key, path, blocks`` of each."""
    tasks = scan_tasks(captures)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        data, directory, lines, at = [], [], [], 0

        def flush():
            nonlocal at, lines
            if lines:
                packed = zlib.compress("\n".join(json.dumps(x) for x in lines).encode(), LEVEL)
                directory.append((lines[0][0], at, len(packed)))
                data.append(packed)
                at += len(packed)
                lines = []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                lines.append(row)
                if len(lines) == BLOCK_LINES:
                    flush()
        flush()
        if directory:
            packed = zlib.compress(json.dumps(directory).encode(), LEVEL)
            path = f"{folder}/index-{number:06d}.cidx"
            write_file(path, b"".join([*data, packed, struct.pack(TAIL, at, len(packed), MAGIC)]))
            yield pa.RecordBatch.from_pydict({"number": pa.array([number], pa.int32()), "first_key": [directory[0][0]],
                                              "path": [path], "blocks": pa.array([len(directory)], pa.int32())})

    ordered = (captures.select("key", "page_id", "archive", "begin", "size")
               .repartitionByRange(tasks, "key", "page_id", "begin").sortWithinPartitions("key", "page_id", "begin"))
    return saved(ordered.mapInArrow(run, "number int, first_key string, path string, blocks int"), "warc-index")


def write_warc(pages: DataFrame, folder: str | None = None) -> tuple[str, DataFrame]:
    """Archives and index of ``pages`` (``page_id, url, html``) below ``folder``; gives the
    folder and the index files' table.

    Among records of equal payloads of at least 100 bytes the one of the least
    ``page_id`` is the response and the others revisit it; rows that repeat that id
    are responses too; a null id is never referred to.  Null html is an empty payload; a
    null url has the key of an empty one; texts of any length are written; an empty
    table writes nothing; other columns are not read.
    """
    folder = folder or scratch_path(pages.sparkSession, "llm/warc")
    return folder, write_index(write_archives(pages, folder), folder)


# --- reading -----------------------------------------------------------------

class Bytes:
    """Range reads of one file."""

    def __init__(self, path: str):
        store, name = file_system(path)
        self.file = store.open_input_file(name)

    def read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def directory(self) -> list[list]:
        end = self.file.size()
        at, size, magic = struct.unpack(TAIL, self.read(end - struct.calcsize(TAIL), struct.calcsize(TAIL)))
        if magic != MAGIC:
            raise ValueError("not an index file")
        return json.loads(zlib.decompress(self.read(at, size)))

    def block(self, entry: list) -> list[list]:
        return [json.loads(x) for x in zlib.decompress(self.read(entry[1], entry[2])).decode().split("\n")]


def searched(file: Bytes, keys: Iterable[str]) -> Iterator[list]:
    """The lines of one index file with any of the ascending distinct ``keys``: each is
    looked for in the directory and then in the blocks from there on; the block at hand
    is kept for the next key."""
    directory = file.directory()
    firsts = [e[0] for e in directory]
    held, lines, names = -1, [], []
    for key in keys:
        for number in range(max(0, bisect_left(firsts, key) - 1), len(directory)):
            if firsts[number] > key:
                break
            if number != held:
                held, lines = number, file.block(directory[number])
                names = [line[0] for line in lines]
            yield from lines[bisect_left(names, key):bisect_right(names, key)]


def places_of(index: DataFrame, urls: DataFrame) -> DataFrame:
    """``archive, begin, size`` of every capture of the distinct keys of ``urls`` (column
    ``url``).  The files' first keys (a row a file) travel with the tasks; a key goes to
    each file whose range holds it, so the captures of a hot key are read by many tasks."""
    files = sorted((r.first_key, r.number, r.path) for r in index.collect())
    firsts, paths = [f[0] for f in files], [f[2] for f in files]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string())], ["key"])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(f, k) for k in batch.column("key").to_pylist()
                    for f in range(max(0, bisect_left(firsts, k) - 1), bisect_right(firsts, k))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string())],
                                             ["file", "key"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column("file").to_pylist(), b.column("key").to_pylist()))
        for number, group in groupby(rows, key=lambda r: r[0]):
            found = searched(Bytes(paths[number]), (k for _, k in group))
            while part := list(islice(found, BLOCK_LINES)):
                yield pa.RecordBatch.from_arrays([pa.array([x[2] for x in part], pa.int32()), pa.array([x[3] for x in part], pa.int64()),
                                                  pa.array([x[4] for x in part], pa.int64())], ["archive", "begin", "size"])

    asked = urls.select("url").mapInArrow(keys, "key string").distinct().mapInArrow(dealt, "file int, key string")
    return (dealt_evenly(asked, "file", max(1, len(files))).sortWithinPartitions("file", "key")
            .mapInArrow(search, "archive int, begin long, size long"))


def read_warc(folder: str, index: DataFrame, urls: DataFrame | None = None) -> DataFrame:
    """Records found through the index and read by their byte ranges: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to, url, html`` (null in a
    revisit).  With ``urls`` (column ``url``; null has the key of an empty one) those of
    their keys, found by binary search, else every record."""
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                file = Bytes(path)
                for entry in file.directory():
                    rows = list(zip(*file.block(entry)))
                    yield pa.RecordBatch.from_arrays([pa.array(rows[2], pa.int32()), pa.array(rows[3], pa.int64()),
                                                      pa.array(rows[4], pa.int64())], ["archive", "begin", "size"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, file = None, None
        for batch in batches:
            rows, held = [], 0
            for archive, begin, size in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != now:
                    now, file = archive, Bytes(f"{folder}/pages-{archive:06d}.warc.gz")
                rows.append(_row(*parsed(file.read(begin, size))))
                held += rows[-1]["payload_bytes"]
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    kinds = {"int64": "long", "string": "string"}
    files = index.select("number", "path").repartition("number")
    found = (files.select("path").mapInArrow(entries, "archive int, begin long, size long") if urls is None
             else places_of(index, urls))
    archives = (saved(found, "warc-entries") if index.limit(1).count() else found)
    last = archives.agg(F.max("archive")).first()[0]
    return (dealt_evenly(archives, "archive", (last or 0) + 1).sortWithinPartitions("archive", "begin")
            .mapInArrow(records, ", ".join(f"{f.name} {kinds[str(f.type)]}" for f in SCHEMA)))


SCHEMA = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("html", pa.string())])


def _row(headers: dict[str, str], payload: bytes) -> dict:
    number = lambda name: int(headers[name]) if name in headers else None
    kind = headers["WARC-Type"]
    return {"page_id": number("X-Page-ID"), "payload_bytes": number("X-Payload-Bytes"),
            "payload_digest": headers["WARC-Payload-Digest"].removeprefix("sha256:"), "record_type": kind,
            "refers_to": number("X-Refers-To-Page"), "url": headers.get("WARC-Target-URI"),
            "html": payload.decode() if kind == "response" else None}


def captures_of(files: list[tuple[str, str]], url: str) -> Iterator[list]:
    """Index entries of a url; ``files`` are (first key, path) in order."""
    key = url_key(url)
    for number in range(max(0, bisect_left([k for k, _ in files], key) - 1), len(files)):
        if files[number][0] > key:
            return
        file = Bytes(files[number][1])
        directory = file.directory()
        for entry in directory[max(0, bisect_left([e[0] for e in directory], key) - 1):]:
            if entry[0] > key:
                return
            lines = file.block(entry)
            for line in lines[bisect_left([x[0] for x in lines], key):]:
                if line[0] != key:
                    break
                yield line


def lookup(folder: str, index: DataFrame, urls: Iterable[str]) -> DataFrame:
    """Records of the given urls.  The table of index files (one row for each file)
    travels with the task; blocks and records are range reads."""
    files = sorted((r.first_key, r.number, r.path) for r in index.collect())
    files = [(k, p) for k, _, p in files]
    spark = index.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url in batch.column("url").to_pylist():
                rows = [_row(*parsed(Bytes(f"{folder}/pages-{line[2]:06d}.warc.gz").read(line[3], line[4])))
                        for line in captures_of(files, url)]
                yield pa.RecordBatch.from_pylist([r | {"asked": url} for r in rows], SCHEMA.append(pa.field("asked", pa.string())))

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, html string, asked string"
    return spark.createDataFrame([(u,) for u in urls], "url string").mapInArrow(run, schema)
