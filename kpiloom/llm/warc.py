"""WARC archives with a two-level capture index.

Writing: each task appends its pages to one archive, a gzip member for each record, so a record can
be read by its place alone. Of equal payloads of some size one page holds the record (``response``),
the others refer to it (``revisit``). Places go into the index: lines in the order of their key (the
host reversed, then the path), cut into compressed blocks, and a sparse directory of one entry for
each block. Entries are kept in the order in which blocks were cut (``part`` and ``offset``): their
keys are cut short and would not tell it.

Reading: a key is bisected in the directory, then in its block, then its record is read by range.
The directory is the only part that every task holds. It has at most ``MAX_ENTRIES`` entries of a
key of at most ``KEY_BYTES`` bytes, as blocks take more lines when there are more captures.

Files get names of their own in each attempt of a task and count only if a committed row names them,
so a lost executor leaves nothing wrong behind. They lie in the shared folder.
"""

from __future__ import annotations

import hashlib
import math
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import storage

#: Payloads of fewer bytes are always written.
LEAST_REVISIT = 1000
BLOCK_LINES = 3000
MAX_ENTRIES = 1 << 18
KEY_BYTES = 256
#: Captures that a task reads back, and the most tasks of one lookup.
TASK_CAPTURES, MAX_TASKS = 4096, 20_000
LEVEL = 3

#: Pages come without a time of capture.
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass
class Archive:
    """Captures as a table, and the directory of their index."""

    captures: DataFrame
    directory: DataFrame


def sort_key(url: str) -> Column:
    """The host's labels from last to first, then path and query: ``com,example)/a?b``. A null url
    has the empty key; one without ``://`` is its own path."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise(
        F.concat(F.lit("/"), F.col(url))
    )
    host = F.lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    path = F.regexp_replace(rest, "^[^/?#]*", "")
    key = F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), path)
    return F.coalesce(key, F.lit(""))


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as the session sees it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


class _Appender:
    """A file that grows by compressed members."""

    def __init__(self, folder: str, name: str):
        system, at = fs.FileSystem.from_uri(folder)
        system.create_dir(at, recursive=True)
        self.path = f"{folder}/{name}"
        self.out = system.open_output_stream(f"{at}/{name}", compression=None)
        self.end = 0

    def add(self, data: bytes) -> tuple[int, int]:
        member = zlib.compress(data, LEVEL, wbits=31)
        start = self.end
        self.out.write(member)
        self.end += len(member)
        return start, len(member)


class _Files:
    """Ranges of files, a few of which stay open."""

    def __init__(self, most: int = 32):
        self.open: OrderedDict[str, pa.NativeFile] = OrderedDict()
        self.most = most

    def member(self, path: str, start: int, length: int) -> bytes:
        if path not in self.open:
            system, at = fs.FileSystem.from_uri(path)
            self.open[path] = system.open_input_file(at)
            if len(self.open) > self.most:
                self.open.popitem(last=False)[1].close()
        self.open.move_to_end(path)
        return zlib.decompress(self.open[path].read_at(length, start), wbits=31)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit keeps the response's head, without the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    block = head + payload if refers_to is None else head
    fields = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        fields.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        fields += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """What ``record`` wrote; a payload that differs from its digest raises an error."""
    head, rest = data.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    length = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    named = lambda field: int(x) if (x := fields[field].removeprefix("<urn:page:").removesuffix(">")) else None
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    return {
        "page_id": named("WARC-Record-ID"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": named("WARC-Refers-To") if kind == "revisit" else None,
    }


def _judged(pages: DataFrame) -> DataFrame:
    """Pages with digest, and the page they refer to. Copies are counted on digests alone; the
    payloads are joined to the digests that occur more than once, a table whose size is then known."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    large = rows.filter(F.octet_length("payload") >= LEAST_REVISIT)
    copies = large.groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = storage.written(copies.filter("n > 1 and first is not null").drop("n"), "copies")
    joined = rows.join(copies, "digest", "left")
    refers = F.expr("if(page_id <=> first, null, first)")
    return joined.select(sort_key("url").alias("key"), "page_id", "url", "payload", "digest", refers.alias("refers_to"))


_CAPTURES = "key string, page_id bigint, record_type string, file string, offset bigint, length bigint"


def write(pages: DataFrame) -> Archive:
    """Archives of all rows of ``pages`` (page_id, url, html), and their index.

    A null html is an empty payload. Equal payloads of ``LEAST_REVISIT`` bytes or more: the page of
    the largest id is the response, and so is any row that repeats this id; the others revisit it.
    Without any id all are responses. Null urls and ids are written as empty fields.
    """
    spark = pages.sparkSession
    folder = _qualified(spark, storage.new_path(spark, "warc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            places = []
            for row in batch.to_pylist():
                if out is None:
                    out = _Appender(folder, f"{uuid.uuid4().hex}.warc.gz")
                    out.add(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode())
                places.append(out.add(record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])))
            if places:
                kinds = ["response" if x is None else "revisit" for x in batch["refers_to"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["key"],
                        batch["page_id"],
                        pa.array(kinds, pa.string()),
                        pa.array([out.path] * len(places), pa.string()),
                        pa.array([a for a, _ in places], pa.int64()),
                        pa.array([n for _, n in places], pa.int64()),
                    ],
                    ["key", "page_id", "record_type", "file", "offset", "length"],
                )
        if out is not None:
            out.out.close()

    captures = storage.written(_judged(pages).mapInArrow(run, _CAPTURES), "captures")
    return Archive(captures, index(captures, folder))


_DIRECTORY = "key binary, page_id bigint, part bigint, file string, offset bigint, length bigint, lines bigint"


def index(captures: DataFrame, folder: str) -> DataFrame:
    """Write the captures in the order of their key as compressed blocks of lines; the directory.

    A task writes one range of keys to one file, and ranges are numbered in their order."""
    total = captures.count()
    block = max(BLOCK_LINES, math.ceil(2 * total / MAX_ENTRIES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, lines, entries = None, [], []

        def flush() -> None:
            nonlocal lines
            start, length = out.add(b"\n".join(lines))
            key, page, *_ = lines[0].split(b"\t")
            entries.append((key[:KEY_BYTES], _number(page), start, length, len(lines)))
            lines = []

        for batch in batches:
            for row in batch.to_pylist():
                out = out or _Appender(folder, f"{uuid.uuid4().hex}.cdx.gz")
                # Tabs and line breaks would end a field.
                key = row["key"].replace("\t", "%09").replace("\n", "%0A").encode()
                fields = (row["page_id"] if row["page_id"] is not None else "", row["file"], row["offset"], row["length"])
                lines.append(b"\t".join([key, *(str(x).encode() for x in fields)]))
                if len(lines) == block:
                    flush()
        if lines:
            flush()
        if out is not None:
            out.out.close()
            columns = list(zip(*entries, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.binary()),
                    pa.array(columns[1], pa.int64()),
                    pa.array([TaskContext.get().partitionId()] * len(entries), pa.int64()),
                    pa.array([out.path] * len(entries), pa.string()),
                    *(pa.array(c, pa.int64()) for c in columns[2:]),
                ],
                ["key", "page_id", "part", "file", "offset", "length", "lines"],
            )

    escaped = F.replace(F.replace("key", F.lit("\t"), F.lit("%09")), F.lit("\n"), F.lit("%0A"))
    ordered = captures.withColumn("key", escaped).repartitionByRange("key", "page_id", "offset")
    return storage.written(ordered.sortWithinPartitions("key", "page_id", "offset").mapInArrow(run, _DIRECTORY), "directory")


def _number(page_id: bytes) -> int:
    """A page's place among the pages of one key: without id it comes first."""
    return int(page_id) if page_id else -(1 << 63)


class Reader:
    """Looks keys up: directory, block, record."""

    def __init__(self, directory: dict[str, list]):
        self.keys = list(zip(directory["key"], directory["page_id"], strict=True))
        self.files, self.offsets, self.lengths = directory["file"], directory["offset"], directory["length"]
        self.ranges = _Files()
        self.blocks: OrderedDict[int, tuple[list, list]] = OrderedDict()

    def block(self, i: int) -> tuple[list, list]:
        if i not in self.blocks:
            lines = [x.split(b"\t") for x in self.ranges.member(self.files[i], self.offsets[i], self.lengths[i]).split(b"\n")]
            self.blocks[i] = ([(x[0], _number(x[1])) for x in lines], lines)
            if len(self.blocks) > 4:
                self.blocks.popitem(last=False)
        self.blocks.move_to_end(i)
        return self.blocks[i]

    def find(self, key: str, page_id: int | None) -> Iterator[dict]:
        """All captures of a key and page. The first may lie in the last block that begins before.
        A key that the directory holds whole is bisected together with its page, so pages of one hot
        key do not share their blocks' work; of longer keys all blocks of the same head are read."""
        name = key.replace("\t", "%09").replace("\n", "%0A").encode()
        wanted = (name, -(1 << 63) if page_id is None else page_id)
        if len(name) < KEY_BYTES:
            first, last = bisect_left(self.keys, wanted), bisect_right(self.keys, wanted)
        else:
            first, last = (cut(self.keys, name[:KEY_BYTES], key=lambda x: x[0]) for cut in (bisect_left, bisect_right))
        for i in range(max(0, first - 1), last):
            keys, lines = self.block(i)
            for at in range(bisect_left(keys, wanted), bisect_right(keys, wanted)):
                _, _, file, offset, length = lines[at]
                yield parse(self.ranges.member(file.decode(), int(offset), int(length)))


_FOUND = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def lookup(archive: Archive, wanted: DataFrame, payload: bool = False) -> DataFrame:
    """Every capture of the pages in ``wanted`` (page_id, url): page, size and digest of the full
    payload, kind of record, the page it refers to, and with ``payload`` the bytes of responses. A
    page that was not captured gives no row; repeated rows of ``wanted`` count once."""
    directory = archive.directory.select("key", "page_id", "part", "file", "offset", "length", "lines").orderBy("part", "offset").toArrow()
    captured = sum(directory["lines"].to_pylist())
    shipped = wanted.sparkSession.sparkContext.broadcast(directory.drop_columns(["lines"]).to_pydict())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payload]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shipped.value)
        schema = pa.schema(
            [
                ("page_id", pa.int64()),
                ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()),
                ("record_type", pa.string()),
                ("refers_to", pa.int64()),
                *[("payload", pa.binary())] * payload,
            ]
        )
        for batch in batches:
            found = []
            for key, page_id in zip(batch["key"].to_pylist(), batch["page_id"].to_pylist(), strict=True):
                found += [{name: x[name] for name in names} for x in reader.find(key, page_id)]
                if len(found) >= 1000:
                    yield pa.RecordBatch.from_pylist(found, schema=schema)
                    found = []
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    keys = wanted.select(sort_key("url").alias("key"), F.col("page_id").cast("bigint").alias("page_id")).distinct()
    # Keys are a few bytes, the records behind them are not: tasks are told by captures.
    tasks = min(max(math.ceil(captured / TASK_CAPTURES), 1), MAX_TASKS)
    ordered = keys.repartitionByRange(tasks, "key", "page_id").sortWithinPartitions("key", "page_id")
    return ordered.mapInArrow(run, _FOUND + ", payload binary" * payload)
