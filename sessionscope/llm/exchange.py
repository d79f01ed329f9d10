"""Joining the n-gram sets of text chunks, on sorted hash arrays.

Operators that compare every n-gram of the corpus with all others would
shuffle one row per n-gram occurrence. Here documents are first gathered into
chunks of some megabytes (one row each, written to the shared folder). A chunk
*asks* about its distinct n-grams: it sends, for each bucket of the hash space,
one row holding the sorted hashes and what belongs to them. A bucket merges
the arrays of all chunks and *answers* each in the order asked, so answers
carry no hashes. Answers return to their chunk by its id.

Hot n-grams cost one entry per chunk, buckets are even because hashes are, and
every step is an ordinary shuffle that Spark can recompute.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialise

CHUNK_BYTES = 8 << 20

_CHUNKS = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
_PARTS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary())])
_TEXT = -1  # the bucket of the row that holds a chunk's documents
SUMMARY = -1  # the chunk of a row that a bucket adds about itself


def buckets(spark: SparkSession) -> int:
    """Buckets of the hash space: one for each shuffle partition."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def pack(array: np.ndarray) -> bytes:
    """A numeric array, byte planes apart, compressed."""
    array = np.ascontiguousarray(array)
    planes = array.view(np.uint8).reshape(len(array), array.itemsize).T if len(array) else array
    data = zstandard.ZstdCompressor(level=1).compress(planes.tobytes())
    return array.dtype.str.encode().ljust(4) + data


def unpack(blob: bytes) -> np.ndarray:
    dtype = np.dtype(blob[:4].strip().decode())
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[4:]), np.uint8)
    return np.ascontiguousarray(data.reshape(dtype.itemsize, -1).T).reshape(-1).view(dtype)


def pack_sorted(array: np.ndarray) -> bytes:
    """Sorted unsigned numbers, as differences."""
    return pack(np.diff(array, prepend=array.dtype.type(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


def narrow(array: np.ndarray) -> np.ndarray:
    """The smallest unsigned type that holds the array."""
    return array.astype(np.min_scalar_type(int(array.max()) if len(array) else 0))


def frame(parts: list[bytes]) -> bytes:
    """Several blobs as one."""
    sizes = np.array([len(parts), *map(len, parts)], "<i8")
    return sizes.tobytes() + b"".join(parts)


def unframe(blob: bytes) -> list[bytes]:
    n = int(np.frombuffer(blob, "<i8", 1)[0])
    ends = 8 * (n + 1) + np.cumsum(np.frombuffer(blob, "<i8", n, 8))
    return [blob[e - s:e] for s, e in zip(np.frombuffer(blob, "<i8", n, 8), ends)]


def split(sorted_hashes: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` equal ranges of the hash space begins and ends."""
    bounds = np.array([(i << 64) // n for i in range(1, n)], np.uint64)
    return np.concatenate(([0], np.searchsorted(sorted_hashes, bounds), [len(sorted_hashes)]))


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, kind: str | None = None) -> DataFrame:
    """(chunk, kind, payload): documents gathered into chunks, in the shared folder.

    ``docs`` has a column text; the payload holds all its columns (Arrow,
    compressed), null texts as empty. Documents of different ``kind`` (an
    integer column) never share a chunk. Written once, so every later step
    sees the same chunks even when executors are lost.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        open_rows: dict[int, list[pa.RecordBatch]] = {}
        sizes: dict[int, int] = {}

        def close(k: int) -> pa.RecordBatch:
            nonlocal made
            made += 1
            table = pa.Table.from_batches(open_rows.pop(k))
            sizes.pop(k)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table.combine_chunks())
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + made], pa.int64()), pa.array([k], pa.int32()),
                 pa.array([sink.getvalue().to_pybytes()], pa.binary())], schema=_CHUNKS)

        for batch in batches:
            kinds = np.asarray(batch.column(names.index(kind))) if kind else np.zeros(batch.num_rows, np.int64)
            lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(names.index("text"))), 0), np.int64)
            for k in np.unique(kinds).tolist():
                own = np.flatnonzero(kinds == k)
                at = 0
                while at < len(own):
                    room = chunk_bytes - sizes.get(k, 0)
                    take = max(1, int(np.searchsorted(np.cumsum(lengths[own[at:]]), room)))
                    part = own[at:at + take]
                    open_rows.setdefault(k, []).append(batch.take(pa.array(part)))
                    sizes[k] = sizes.get(k, 0) + int(lengths[part].sum())
                    if sizes[k] >= chunk_bytes or at + take < len(own):
                        yield close(k)
                    at += take
        for k in list(open_rows):
            yield close(k)

    return materialise(docs.mapInArrow(run, "chunk long, kind int, payload binary"), "chunks", "uncompressed")


def documents(payload: bytes) -> dict[str, list]:
    """A chunk's columns; texts as UTF-8."""
    table = pa.ipc.open_stream(payload).read_all()
    out = {n: table.column(n) for n in table.column_names}
    texts = out["text"].cast(pa.large_binary()).to_pylist()
    return {n: c.to_pylist() if n != "text" else [t or b"" for t in texts] for n, c in out.items()}


def part(chunk: int, bucket: int, payload: bytes) -> pa.RecordBatch:
    """One row (chunk, bucket, payload)."""
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([bucket], pa.int32()),
                                       pa.array([payload], pa.binary())], schema=_PARTS)


def ask(chunks: DataFrame, question: Callable[[dict], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """(chunk, bucket, payload): the rows that ``question`` makes of a chunk's documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                for bucket, asked in question(documents(payload.as_py())):
                    yield part(chunk, bucket, asked)

    return chunks.select("chunk", "payload").mapInArrow(run, "chunk long, bucket int, payload binary")


def groups(batches: Iterator[pa.RecordBatch], key: tuple[int, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with the same values in the columns ``key``."""
    held, at = [], None
    for batch in batches:
        for i in range(batch.num_rows):
            row = tuple(c[i].as_py() for c in batch.columns)
            own = tuple(row[k] for k in key)
            if held and own != at:
                yield at, held
                held = []
            at = own
            held.append(row)
    if held:
        yield at, held


def answer(asked: DataFrame, n: int, resolve: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """(chunk, bucket, payload): ``resolve`` maps a bucket's questions to answers, one each.

    One answer more is the bucket's own and goes to the chunk ``SUMMARY``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), group in groups(batches, (1,)):
            found = resolve([row[2] for row in group])
            chunks = [row[0] for row in group] + [SUMMARY] * (len(found) - len(group))
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunks, pa.int64()), pa.array([bucket] * len(found), pa.int32()),
                 pa.array(found, pa.binary())], schema=_PARTS)

    return asked.repartitionById(n, F.pmod("bucket", F.lit(n)).cast("int")).sortWithinPartitions("bucket", "chunk") \
        .mapInArrow(run, "chunk long, bucket int, payload binary")


def gather(chunks: DataFrame, answers: DataFrame, n: int,
           finish: Callable[[int, dict, list[bytes]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``finish`` gets each chunk's id, documents and answers, in the order of the buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (chunk,), group in groups(batches, (0,)):
            texts = [row[2] for row in group if row[1] == _TEXT]
            if texts:
                yield from finish(chunk, documents(texts[0]), [row[2] for row in group if row[1] != _TEXT])

    answers = answers.where(F.col("chunk") != SUMMARY)
    own = chunks.select("chunk", F.lit(_TEXT).alias("bucket"), "payload")
    # neighbouring chunks of a task, and the same ones of neighbouring tasks, go to different partitions
    place = F.pmod(F.shiftright("chunk", 32) + F.lit(7919) * F.col("chunk").bitwiseAND(0xFFFFFFFF), F.lit(n))
    return own.unionByName(answers).repartitionById(n, place.cast("int")).sortWithinPartitions("chunk", "bucket") \
        .mapInArrow(run, schema)
