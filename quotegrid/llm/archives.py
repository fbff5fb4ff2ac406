"""WARC archives written and read as a table of chunks: a record is rows of its identifier and chunk numbers.

Payloads are cut into chunks by Spark, so that a task handles one chunk at a time however large a record is. A running
SHA-1 goes with the chunks; the last chunk of a record has its payload's digest. Records of one digest are copies: one response keeps the payload,
and revisit records refer to it. Chunk rows are shuffled once, by record, with a row ahead of them (chunk -1) that says what to
write; a task streams its records into archives, one gzip member each, on any file system all executors reach. The rows
that writers return are the archives' index, and the index is the commit: what a lost or repeated task left
behind is in no index and never read. Reading streams each archive back into chunk rows, checked against the digest
and the length in the record's header.

Defined results: a null payload is empty; a null url is empty; a null page id is smaller than all others; repeated
rows are records like others, and one of them is the response if they are long enough to be compared; an empty table gives no
archive and no record; columns beside the three named ones are not carried. A row of the source is given as a whole, so the task that cuts it
into chunks holds it; no later step does.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotegrid.llm import files
from quotegrid.llm.common import width
from quotegrid.session import materialize, scratch_path, ship_package

CHUNK = 1 << 16  # bytes of payload in a row
LEAST = 1000  # shorter payloads are not compared
ARCHIVE = 1 << 30  # a task opens another archive behind this size
LEVEL = 4  # of compression
READ = 1 << 18  # compressed bytes taken from an archive at a time

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


# -- chunks of a table's payloads


def chunk_table(pages: DataFrame, size: int = CHUNK) -> DataFrame:
    """page_id, uri, k, chunk (from 0 on), data, last; in the order of the source's rows.

    ``k`` is a hash of the row's values; together with the page id it tells records apart.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    uri = F.coalesce(F.col("url"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), uri.alias("uri"), body.alias("body"))
    n = F.greatest(F.ceil(F.octet_length("body") / size), F.lit(1)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col("body"), i * size + 1, F.lit(size)))
    rows = rows.select("page_id", "uri", F.xxhash64("page_id", "uri", "body").alias("k"), n.alias("n"), F.posexplode(cut).alias("chunk", "data"))
    return rows.select("page_id", "uri", "k", "chunk", "data", (F.col("chunk") == F.col("n") - 1).alias("last"))


_DIGESTS = pa.schema(
    [("page_id", pa.int64()), ("uri", pa.string()), ("k", pa.int64()), ("size", pa.int64()), ("digest", pa.string())]
)


def payload_digests(chunks: DataFrame) -> DataFrame:
    """page_id, uri, k, size and digest (hexadecimal SHA-1) of each record; chunks are read where they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, size = hashlib.sha1(), 0
        for batch in batches:
            out = []
            data = batch.column(3)
            for i, (page, uri, k, last) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 4)), strict=True)):
                part = data[i].as_buffer()
                sha.update(part)
                size += part.size
                if last:
                    out.append((page, uri, k, size, sha.hexdigest()))
                    sha, size = hashlib.sha1(), 0
            yield _batch(out, _DIGESTS)

    rows = chunks.select("page_id", "uri", "k", "data", "last")
    return rows.mapInArrow(run, "page_id long, uri string, k long, size long, digest string")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def verdicts(digests: DataFrame, least: int = LEAST) -> DataFrame:
    """A row per different record: how often it occurs (``copies``), how many of these are responses, and whom the others refer to.

    Of records of equal payloads the one of the largest page id is the response.
    """
    same = digests.groupBy("page_id", "uri", "k", "size", "digest").agg(F.count("*").alias("copies"))
    long_ = same.where(F.col("size") >= least)
    kept = F.max(F.struct("page_id", "uri", "k")).alias("kept")
    groups = long_.groupBy(F.col("digest").alias("_digest"), F.col("size").alias("_size")).agg(kept, F.sum("copies").alias("n"))
    groups = groups.where("n > 1").select("_digest", "_size", "kept")
    met = same.join(groups, (F.col("digest") == F.col("_digest")) & (F.col("size") == F.col("_size")), "left")
    is_kept = F.struct("page_id", "uri", "k").eqNullSafe(F.col("kept"))
    responses = F.when(F.col("kept").isNull(), F.col("copies")).when(is_kept, 1).otherwise(0)
    return met.select(*same.columns, responses.cast("long").alias("responses"), "kept")


# -- records


@dataclass
class Header:
    """What a record says of itself."""

    kind: str
    record_id: str
    uri: str
    date: str
    digest: str
    size: int  # of the whole payload, also of a revisit
    refers_to: str | None = None
    refers_to_uri: str | None = None

    def encode(self) -> bytes:
        http = HTTP.format(self.size).encode()
        lines = [
            VERSION.decode(),
            f"WARC-Type: {self.kind}",
            f"WARC-Record-ID: <{self.record_id}>",
            f"WARC-Target-URI: {quote(self.uri, safe=_SAFE)}",
            f"WARC-Date: {self.date}",
            f"WARC-Payload-Digest: sha1:{self.digest}",
            f"X-Payload-Length: {self.size}",
            "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(http) + (self.size if self.kind == 'response' else 0)}",
        ]
        if self.refers_to is not None:
            lines[-1:-1] = [
                f"WARC-Profile: {REVISIT_PROFILE}",
                f"WARC-Refers-To: <{self.refers_to}>",
                f"WARC-Refers-To-Target-URI: {quote(self.refers_to_uri or '', safe=_SAFE)}",
            ]
        return "\r\n".join(lines).encode() + b"\r\n\r\n" + http

    @classmethod
    def parse(cls, block: bytes) -> tuple[Header, int]:
        """The header, and how many bytes its record's block has."""
        lines = block.decode().split("\r\n")
        if lines[0] != VERSION.decode():
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        of = dict(line.split(": ", 1) for line in lines[1:])
        bare = lambda x: x and x.removeprefix("<").removesuffix(">")
        head = cls(
            of["WARC-Type"],
            bare(of["WARC-Record-ID"]),
            unquote(of["WARC-Target-URI"]),
            of["WARC-Date"],
            of["WARC-Payload-Digest"].removeprefix("sha1:"),
            int(of["X-Payload-Length"]),
            bare(of.get("WARC-Refers-To")),
            unquote(of["WARC-Refers-To-Target-URI"]) if "WARC-Refers-To-Target-URI" in of else None,
        )
        return head, int(of["Content-Length"])


_SAFE = ":/?#[]@!$&'()*+,;="


def record_id(page_id: int | None, k: int, copy: int) -> str:
    """A name that other records can refer to without a table of names."""
    return f"urn:page:{'' if page_id is None else page_id}:{k & (1 << 64) - 1:016x}:{copy}"


def page_of(name: str | None) -> int | None:
    page = name.split(":")[2] if name else ""
    return int(page) if page else None


class _Member:
    """One gzip member of an archive."""

    def __init__(self, out: Any):
        self.out, self.gz = out, zlib.compressobj(LEVEL, zlib.DEFLATED, 31)

    def write(self, data: bytes) -> None:
        if packed := self.gz.compress(data):
            self.out.write(packed)

    def close(self) -> None:
        self.out.write(self.gz.flush())


class ArchiveWriter:
    """Writes records one after the other, opening another archive when one is full."""

    def __init__(self, folder: str, date: str, most: int = ARCHIVE):
        self.system, self.folder = files.open_folder(folder)
        self.date, self.most, self.out, self.name = date, most, None, ""

    def begin(self) -> tuple[str, int, _Member]:
        if self.out is not None and self.out.tell() >= self.most:
            self.close()
        if self.out is None:
            self.system.create_dir(self.folder, recursive=True)
            self.name = f"{uuid.uuid4().hex}.warc.gz"
            self.out = self.system.open_output_stream(files.join(self.folder, self.name), compression=None)
        return self.name, self.out.tell(), _Member(self.out)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


_INDEX = pa.schema([("record_id", pa.string()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
INDEX = "record_id string, archive string, offset long, length long"
_PLAN = ("k", "page_id", "uri", "size", "digest", "copies", "responses", "kept")


def _write(folder: str, date: str, most: int):
    """Writes the records of a partition, sorted by record and chunk; yields their index rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, date, most)
        row: dict | None = None
        member = start = None
        rows: list[tuple] = []

        def head(kind: str, copy: int) -> Header:
            kept = row["kept"] if kind == "revisit" else None
            refers = record_id(kept["page_id"], kept["k"], 0) if kept else None
            return Header(kind, record_id(row["page_id"], row["k"], copy), row["uri"], date, row["digest"], row["size"], refers, kept and kept["uri"])

        def whole(h: Header, body: bytes = b"") -> None:
            name, at, out = writer.begin()
            out.write(h.encode())
            out.write(body + b"\r\n\r\n")
            out.close()
            rows.append((h.record_id, name, at, writer.out.tell() - at))

        for batch in batches:
            rows = []
            data = batch.column(1)
            for i, (chunk, last, plan) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)), strict=True)):
                if chunk < 0:
                    row, expected = plan, 0
                    for copy in range(row["responses"], row["copies"]):
                        whole(head("revisit", copy))
                    continue
                if chunk != expected or not row["responses"]:
                    continue  # a repeated row's chunk, or one whose payload stands elsewhere
                expected += 1
                part = data[i].as_buffer().to_pybytes()
                if last and not chunk:
                    for copy in range(row["responses"]):
                        whole(head("response", copy), part)
                    continue
                if not chunk:
                    if row["responses"] > 1:
                        raise ValueError("payloads of several chunks have to be long enough to be compared")
                    name, start, member = writer.begin()
                    h = head("response", 0)
                    member.write(h.encode())
                member.write(part)
                if last:
                    member.write(b"\r\n\r\n")
                    member.close()
                    rows.append((h.record_id, name, start, writer.out.tell() - start))
            yield _batch(rows, _INDEX)
        writer.close()
        yield _batch([], _INDEX)

    return run


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", size: int = CHUNK, least: int = LEAST, most: int = ARCHIVE) -> DataFrame:
    """Writes a record for every row of ``pages`` (page_id, url, html) below ``folder``; returns the index, see ``INDEX``.

    The table is scanned twice: for the digests, which decide what is a copy, and for the payloads.
    """
    if size < least:
        raise ValueError("a payload that is not compared has to fit in one chunk")
    spark = pages.sparkSession
    ship_package(spark)
    chunks = chunk_table(pages, size)
    plan = materialize(verdicts(materialize(payload_digests(chunks), "digests"), least), "verdicts")
    kind = plan.select(*_PLAN).schema.simpleString()
    ahead = plan.select("k", "page_id", F.lit(-1).alias("chunk"), F.lit(None).cast("binary").alias("data"), F.lit(False).alias("last"), F.struct(*_PLAN).alias("plan"))
    rows = chunks.select("k", "page_id", "chunk", "data", "last", F.lit(None).cast(kind).alias("plan"))
    dealt = ahead.unionByName(rows).repartition(width(spark), "k").sortWithinPartitions("k", "page_id", "chunk")
    dealt = dealt.select("chunk", "data", "last", "plan")
    return materialize(dealt.mapInArrow(_write(folder, date, most), INDEX), "index")


# -- reading


class _Source:
    """Bytes of one gzip member after the other, read in small pieces."""

    def __init__(self, stream: Any):
        self.stream, self.gz, self.raw, self.buf = stream, zlib.decompressobj(31), b"", b""

    def more(self) -> bool:
        """Takes in some more bytes; false at the end of the archive."""
        while True:
            if self.gz.eof:
                self.raw, self.gz = self.gz.unused_data, zlib.decompressobj(31)
            raw = self.raw or self.stream.read(READ)
            if not raw:
                return False
            got = self.gz.decompress(raw, CHUNK)
            self.raw = self.gz.unconsumed_tail
            if got:
                self.buf += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        """What stands before the mark, which is taken, too; null at the end."""
        while (at := self.buf.find(mark)) < 0:
            if not self.more():
                if self.buf:
                    raise ValueError("the archive ends inside a record")
                return None
        out, self.buf = self.buf[:at], self.buf[at + len(mark) :]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buf) < n:
            if not self.more():
                raise ValueError("the archive ends inside a record")
        out, self.buf = self.buf[:n], self.buf[n:]
        return out


def read_stream(stream: Any, size: int = CHUNK) -> Iterator[tuple[Header, int, bytes, str, bool]]:
    """Header, chunk number, data, digest so far and whether it is the last one, of each chunk in an archive."""
    source = _Source(stream)
    while (block := source.until(b"\r\n\r\n")) is not None:
        head, left = Header.parse(block)
        http = source.until(b"\r\n\r\n")
        left -= len(http) + 4
        sha, chunk, length = hashlib.sha1(), 0, left
        while left or not chunk:
            part = source.take(min(size, left))
            left -= len(part)
            sha.update(part)
            if not left and head.kind == "response" and (sha.hexdigest(), length) != (head.digest, head.size):
                raise ValueError(f"the payload of {head.record_id} is not the one that was written")
            yield head, chunk, part, sha.hexdigest(), not left
            chunk += 1
        if source.take(4) != b"\r\n\r\n":
            raise ValueError(f"{head.record_id} does not end where it should")


_READ = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("uri", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("chunk", pa.int32()),
        ("digest_so_far", pa.string()),
        ("last", pa.bool_()),
        ("data", pa.binary()),
    ]
)
CHUNKS = (
    "record_id string, page_id long, uri string, record_type string, refers_to long, payload_bytes long,"
    " payload_digest string, chunk int, digest_so_far string, last boolean, data binary"
)


def read_archives(index: DataFrame, folder: str, size: int = CHUNK, payloads: bool = True) -> DataFrame:
    """The chunk rows of all archives in the index, see ``CHUNKS``; without payloads the last row of each record, data null.

    An archive is read by one task, from its start to its end; the index tells its size, and writers keep it bounded.
    """
    spark = index.sparkSession
    # by range: a hash partitioning would be taken from the distinct before it, whose tasks are joined when rows are few
    archives = index.select("archive").distinct().repartitionByRange(width(spark), "archive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = files.open_folder(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_stream(files.join(path, name), compression=None) as stream:
                    yield from _batches(read_stream(stream, size), payloads)

    return archives.mapInArrow(run, CHUNKS)


def _batches(chunks: Iterator[tuple], payloads: bool) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for head, chunk, data, digest, last in chunks:
        if not (payloads or last):
            continue
        of = (head.record_id, page_of(head.record_id), head.uri, head.kind, page_of(head.refers_to), head.size, head.digest)
        rows.append((*of, chunk, digest, last, data if payloads else None))
        held += 400 + (len(data) if payloads else 0)
        if held > 4 << 20:
            yield _batch(rows, _READ)
            rows, held = [], 0
    if rows:
        yield _batch(rows, _READ)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record, read back and verified."""
    found = read_archives(index, folder, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def archive_and_read_back(pages: DataFrame) -> DataFrame:
    """Archives in a fresh folder of the shared one, and their records."""
    folder = scratch_path(pages.sparkSession, "archives")
    return read_records(write_archives(pages, folder), folder)
