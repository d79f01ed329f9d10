"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has 64 bits. Fingerprints within ``distance`` bits of each other
must agree on ``blocks - distance`` of ``blocks`` blocks, so every choice of
agreeing blocks is a join key (6 blocks and distance 3: 20 keys of at least 30
bits). Only distinct fingerprints are joined, so exact copies cost one row.

Keys held by many fingerprints are refined, not compared pair by pair: such
fingerprints get the keys of 16 blocks (13 of 16 agree, 560 keys of 52 bits),
whose groups hold at most 4,096 different fingerprints whatever the input.
Each group yields the edges of a spanning forest, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import materialise, rows, text_bytes
from .components import connected_components

SEED = 42
_STEP = 1 << 16  # shingles held at once of one text


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of a UTF-8 text, as an unsigned number.

    ASCII letters are lower-cased; words end at ASCII white space. A text
    with fewer than ``shingle`` words is one shingle; without words it is 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    starts, ends = starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), _STEP):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in
                           zip(starts[at:at + _STEP], ends[at:at + _STEP])], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    over = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(over.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's bits as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in text_bytes(batch.column(1))),
                                np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .mapInArrow(run, "doc_id long, fp long")


def _masks(blocks: int, distance: int) -> list[int]:
    """Bits to keep, for every choice of ``distance`` blocks to leave out."""
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(bounds, bounds[1:])]
    return [sum(block) - sum(out) for out in combinations(block, distance)]


def forest(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest over different values within ``distance``."""
    left, right, rest = [], [], values
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(rest ^ at) <= distance
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), at))
                right.append(found)
                queue.extend(found)
                rest = rest[~near]
    none = np.empty(0, values.dtype)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _keys(fps: DataFrame, blocks: int, distance: int) -> DataFrame:
    """(fp, mask, key) for every mask."""
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in _masks(blocks, distance)])
    return fps.select("fp", F.posexplode(masks).alias("mask", "bits")) \
        .select("fp", F.col("mask").cast("short").alias("mask"), F.col("fp").bitwiseAND(F.col("bits")).alias("key"))


def _forests(groups: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) of each group's spanning forest; ``fps`` is the group."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0)
            values, ends = fps.values.to_numpy(), fps.offsets.to_numpy()
            found = [forest(values[s:e], distance) for s, e in zip(ends, ends[1:])]
            if found:
                yield rows(schema, {"a": np.concatenate([f[0] for f in found]),
                                    "b": np.concatenate([f[1] for f in found])})

    return groups.select("fps").mapInArrow(run, "a long, b long")


def near_pairs(fps: DataFrame, distance: int = 3, blocks: int = 6, fine_blocks: int = 16,
               hot: int = 64) -> DataFrame:
    """Edges (a, b) that connect the same fingerprints as all pairs would.

    ``fps`` holds different fingerprints (column fp). Groups of up to ``hot``
    fingerprints are resolved at once; the members of larger ones are keyed
    again by ``fine_blocks`` blocks, which bounds a group's size by
    2 ** (64 * distance / fine_blocks).
    """
    keyed = _keys(fps, blocks, distance)
    sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialise(keyed.join(sizes, ["mask", "key"]).select("mask", "key", "fp", "n"), "blocks")
    small = shared.where(F.col("n") <= hot).groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))
    crowded = shared.where(F.col("n") > hot).select("fp").distinct()
    fine = _keys(crowded, fine_blocks, distance).groupBy("mask", "key") \
        .agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return _forests(small, distance).unionByName(_forests(fine, distance)).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, blocks: int = 6) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document.

    ``fingerprint``: 16 lower-case hexadecimal digits. ``component_id``: the
    smallest doc_id reachable over links of at most ``distance`` bits. Null
    and empty texts have fingerprint 0 and link like any other. Rows that
    repeat a doc_id give a row each; a null doc_id is linked but never named
    as component unless all of its component are null (then null). Other
    columns are not read. An empty table gives an empty result.
    """
    known = materialise(fingerprints(docs, shingle), "fingerprints")
    roots = connected_components(near_pairs(known.select("fp").distinct(), distance, blocks))
    rooted = known.join(roots.select(F.col("node").alias("fp"), "component"), "fp", "left") \
        .select("doc_id", "fp", F.coalesce("component", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(first, "root").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
