"""WARC archives, written and read as a chunked record table.

Writing: every task streams its pages into one archive (a gzip member per
record) in a shared folder. Reading: every task streams its archives and turns
a payload into rows of at most ``chunk_bytes`` (record_id, chunk), each with
the running digest of the payload up to there, so no record is ever held
whole. The last chunk's digest is the payload's and is checked against the
header.

Equal payloads of at least ``min_bytes`` are stored once: the record with the
smallest page_id is the response, the others are revisits that refer to it.
"""

from __future__ import annotations

import hashlib
import posixpath
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialise, rows, shared_path

CHUNK_BYTES = 1 << 20
_BLOCK = 1 << 18  # bytes read from an archive at once
_LEVEL = 1
_DATE = "2024-01-01T00:00:00Z"  # the pages carry no capture time
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a shared path; a path without a scheme is a local one."""
    return pa.fs.FileSystem.from_uri(path) if ":" in path else (pa.fs.LocalFileSystem(), path)


def classify(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """(page_id, url, payload, digest, refers_to, refers_url): the response of a revisit, else null.

    A null html is an empty payload. Among equal payloads every row with the
    smallest page_id is a response; a null page_id is never the smallest unless
    all are null, and then all are responses.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    read = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")) \
        .withColumn("digest", F.sha2("payload", 256))
    # only digests that occur again are joined back
    groups = read.where(F.octet_length("payload") >= min_bytes).groupBy("digest") \
        .agg(F.min("page_id").alias("first"), F.min_by("url", "page_id").alias("first_url"), F.count("*").alias("n")) \
        .where(F.col("n") > 1).drop("n")
    joined = read.join(groups, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to"),
                         F.when(revisit, F.col("first_url")).alias("refers_url"))


def _uri(url: str | None) -> str:
    return "".join(c for c in url or "" if c not in "\r\n")


def _header(number: str, page_id: int | None, url: str | None, digest: str, refers_to: int | None,
            refers_url: str | None, size: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:record:{number}:{digest[:16]}>", f"WARC-Date: {_DATE}",
             f"WARC-Target-URI: {_uri(url)}", f"WARC-Payload-Digest: sha256:{digest}"]
    if page_id is not None:
        lines.append(f"WARC-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To-Target-URI: {_uri(refers_url)}", f"WARC-Refers-To-Page-ID: {refers_to}",
                  f"WARC-Refers-To-Date: {_DATE}", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join([*lines, "Content-Type: text/html", f"Content-Length: {size}", "", ""]).encode()


def write_archives(classified: DataFrame, folder: str) -> DataFrame:
    """Write one archive per task below ``folder``; returns (path, n_records) of the archives, computed once.

    A task's archive gets a name of its own attempt, and only the names that
    Spark's commit kept are returned, so a repeated task leaves no double records.
    """
    schema = pa.schema([("path", pa.string()), ("n_records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, n, out, path = TaskContext.get(), 0, None, None
        try:
            for batch in batches:
                for page_id, url, payload, digest, refers_to, refers_url in zip(*batch.columns):
                    if out is None:
                        fs, root = _open(folder)
                        fs.create_dir(root, recursive=True)
                        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
                        path, out = posixpath.join(folder, name), fs.open_output_stream(
                            posixpath.join(root, name), compression=None)
                    body = payload.as_buffer()
                    kept = body if not refers_to.is_valid else b""
                    head = _header(f"{context.partitionId()}-{n}", page_id.as_py(), url.as_py(), digest.as_py(),
                                   refers_to.as_py(), refers_url.as_py(), len(kept))
                    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
                    out.write(packer.compress(head))
                    for at in range(0, len(kept), _BLOCK):
                        out.write(packer.compress(memoryview(kept)[at:at + _BLOCK]))
                    out.write(packer.compress(b"\r\n\r\n") + packer.flush())
                    n += 1
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield rows(schema, {"path": [path], "n_records": [n]})

    return materialise(classified.select("page_id", "url", "payload", "digest", "refers_to", "refers_url")
                       .mapInArrow(run, "path string, n_records long"), "archives")


class _Members:
    """The bytes of consecutive gzip members, read in blocks."""

    def __init__(self, stream: pa.NativeFile):
        self.stream, self.unpacker, self.raw, self.held = stream, None, b"", b""

    def more(self) -> bool:
        """Fetch more unpacked bytes; False at the end of the archive."""
        while True:
            if not self.raw:
                self.raw = self.stream.read(_BLOCK)
                if not self.raw:
                    if self.unpacker is not None:
                        raise ValueError("archive ends inside a record")
                    return False
            if self.unpacker is None:
                self.unpacker = zlib.decompressobj(31)
            found = self.unpacker.decompress(self.raw, _BLOCK)
            if self.unpacker.eof:
                self.raw, self.unpacker = self.unpacker.unused_data, None
            else:
                self.raw = self.unpacker.unconsumed_tail
            if found:
                self.held += found
                return True

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to ``mark``, which is skipped; None at the end of the archive."""
        while (at := self.held.find(mark)) < 0:
            if not self.more():
                if self.held:
                    raise ValueError("archive ends inside a header")
                return None
        found, self.held = self.held[:at], self.held[at + len(mark):]
        return found

    def take(self, size: int) -> bytes:
        """At most ``size`` bytes; at least one."""
        if not self.held and not self.more():
            raise ValueError("archive ends inside a payload")
        found, self.held = self.held[:size], self.held[size:]
        return found


def _records(stream: pa.NativeFile, chunk_bytes: int) -> Iterator[tuple[dict, int, bytes, str, bool]]:
    """(header, chunk number, chunk, digest of the payload so far, is it the last) of every record."""
    members = _Members(stream)
    while (head := members.until(b"\r\n\r\n")) is not None:
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        header = dict(x.split(": ", 1) for x in lines[1:])
        left, digest, number = int(header["Content-Length"]), hashlib.sha256(), 0
        while left or not number:
            parts, size = [], min(left, chunk_bytes)
            while size:
                parts.append(members.take(size))
                digest.update(parts[-1])
                size -= len(parts[-1])
                left -= len(parts[-1])
            yield header, number, b"".join(parts), digest.hexdigest(), not left
            number += 1
        if members.until(b"\r\n\r\n") != b"":
            raise ValueError("a record is longer than its Content-Length")


def read_archives(archives: DataFrame, chunk_bytes: int = CHUNK_BYTES, payloads: bool = True) -> DataFrame:
    """The chunked record table of the archives (column path).

    Columns: record_id, page_id, url, record_type, refers_to (page_id),
    payload_digest (from the header), chunk (from 0), offset, chunk_bytes, running_digest
    (SHA-256 of the payload up to and with this chunk), is_last, payload (the
    chunk's bytes; null without ``payloads``). A record has at least one row. A
    response whose bytes do not match its digest fails the job.
    """
    schema = pa.schema([
        ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("chunk", pa.int64()),
        ("offset", pa.int64()), ("chunk_bytes", pa.int64()), ("running_digest", pa.string()), ("is_last", pa.bool_()),
        ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {f.name: [] for f in schema}, 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, file = _open(path)
                with fs.open_input_stream(file, compression=None) as stream:
                    for header, number, chunk, digest, last in _records(stream, chunk_bytes):
                        named = header["WARC-Payload-Digest"].removeprefix("sha256:")
                        kind = header["WARC-Type"]
                        if last and kind == "response" and digest != named:
                            raise ValueError(f"{header['WARC-Record-ID']}: payload does not match its digest")
                        page, target = header.get("WARC-Page-ID"), header.get("WARC-Refers-To-Page-ID")
                        for name, value in zip(held, (
                                header["WARC-Record-ID"], page and int(page), header.get("WARC-Target-URI"), kind,
                                target and int(target), named, number, number * chunk_bytes, len(chunk), digest, last,
                                chunk if payloads else None)):
                            held[name].append(value)
                        size += len(chunk) if payloads else 0
                        if size >= chunk_bytes or len(held["chunk"]) >= 4096:
                            yield rows(schema, held)
                            held, size = {f.name: [] for f in schema}, 0
        yield rows(schema, held)

    return archives.select("path").mapInArrow(
        run, "record_id string, page_id long, url string, record_type string, refers_to long, payload_digest string, "
             "chunk long, offset long, chunk_bytes long, running_digest string, is_last boolean, payload binary")


def round_trip(pages: DataFrame, folder: str | None = None, min_bytes: int = 100,
               chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, read them back: one row per page.

    Columns: page_id, payload_bytes, payload_digest (of the full payload; a
    revisit's come from the response it refers to), record_type, refers_to.
    Repeated rows give a record each; null and empty html are responses of no
    bytes; an empty table gives no archive and no row.
    """
    spark: SparkSession = pages.sparkSession
    archives = write_archives(classify(pages, min_bytes), folder or shared_path(spark, "warc"))
    chunks = read_archives(archives.repartition(max(archives.count(), 1)), chunk_bytes, payloads=False)
    records = materialise(chunks.where("is_last").select(
        "page_id", "record_type", "refers_to", "payload_digest", "running_digest",
        (F.col("offset") + F.col("chunk_bytes")).alias("size")), "records")
    # what a revisit refers to is looked up among the responses that were read
    responses = records.where(F.col("record_type") == "response").where(F.col("size") >= min_bytes) \
        .select(F.col("running_digest").alias("payload_digest"), F.col("page_id").alias("refers_to"),
                F.col("size").alias("response_size")).distinct()
    revisits = records.where(F.col("record_type") == "revisit").join(responses, ["payload_digest", "refers_to"], "left") \
        .withColumn("size", F.coalesce("response_size", F.raise_error("a revisit's response is missing").cast("long")))
    columns = ["page_id", F.col("size").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"]
    return records.where(F.col("record_type") == "response").select(*columns).unionByName(revisits.select(*columns))
