"""Removing repeated word spans through a compacted de Bruijn graph.

Windows of ``k`` words are the edges of a de Bruijn graph, their first and
last ``k - 1`` words the nodes. Three joins find and compact what repeats:

1. every window has an anchor, the short word n-gram in it with the smallest
   fingerprint, which a copy of the window shares; windows whose anchor occurs
   nowhere else cannot repeat and take no further part;
2. the remaining edges are joined on their fingerprints and each distinct edge
   is labelled with its source: the smallest (doc_id, start) where it occurs;
3. a chunk walks its documents along edges that are repeated and whose sources
   are consecutive too. Such a walk is a nonbranching path of the graph as its
   source spells it, and compacts into one row.

A path whose source coordinates lie before its own is a verified repeat of an
earlier span: all its words go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import exchange as ex
from .common import materialise, rows
from .repeats import bits, labels, questions, repeated, sizes, sources
from .tokens import joined, mix, word_windows, words

ANCHOR = 8  # words of an anchor
_NULL_ID = np.iinfo(np.int64).max  # a null doc_id sorts after all others


class _Chunk:
    """A chunk's words, document by document."""

    def __init__(self, docs: dict, k: int):
        ids = np.array([_NULL_ID if d is None else d for d in docs["doc_id"]], np.int64)
        self.ids, self.texts, self.k = ids, docs["text"], k
        data, starts = joined(self.texts)
        self.hashes, self.begin, self.end = words(data)
        self.data = data
        self.doc = np.searchsorted(starts, self.begin, "right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(self.texts) + 1))  # each document's first word
        self.position = np.arange(len(self.doc)) - self.first[self.doc]  # of a word in its document
        n = max(len(self.doc) - k + 1, 0)
        self.inside = self.doc[:n] == self.doc[k - 1:]  # windows that stay in one document
        self.windows = word_windows(self.hashes, k)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of the selected anchors, and the place of each window's own in them (-1: none)."""
        size = min(ANCHOR, self.k)
        grams = word_windows(self.hashes, size)
        own = np.full(len(self.inside), -1, np.int64)
        if not len(own):
            return np.empty(0, np.uint64), own
        smallest = _sliding_argmin(grams, self.k - size + 1)
        chosen, place = np.unique(smallest[self.inside], return_inverse=True)
        own[self.inside] = place
        return mix(grams[chosen]), own  # small by choice; mixed again they spread over the buckets


def _sliding_argmin(values: np.ndarray, span: int) -> np.ndarray:
    """Position of the smallest of each ``span`` consecutive values, by doubling; ties: the first."""
    best, width = np.arange(len(values)), 1
    while width < span:
        step = min(width, span - width)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        width += step
    return best


def _edges(chunk: _Chunk, candidate: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct fingerprints of candidate windows; first place, repeats, and each window's place in them."""
    at = np.flatnonzero(candidate)
    order = np.lexsort((chunk.position[at], chunk.ids[chunk.doc[at]], chunk.windows[at]))
    at = at[order]
    h = chunk.windows[at]
    head = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.empty(0, bool)
    place = np.cumsum(head) - 1
    twice = np.bincount(place, minlength=int(head.sum())) > 1
    return h[head], at[head], twice, at, place


def paths(docs: DataFrame, k: int = 20, chunk_bytes: int = ex.CHUNK_BYTES, texts: bool = True) -> DataFrame:
    """Words that repeat earlier spans, one row per document.

    Columns: doc_id; n_words; n_removed; kept (the remaining words joined by
    one space, UTF-8, binary; null without ``texts``); kept_sha256; path_starts
    and path_words: each removed path's first word and number of words;
    source_ids and source_starts: where its source starts. A word goes if it lies in a window
    of ``k`` words whose sequence also starts earlier: in a smaller doc_id, or
    earlier in the same document. Occurrences with the same doc_id and start
    (repeated rows) are not earlier than each other. A null doc_id sorts last;
    null texts have no words. An empty table gives an empty result.
    """
    n = ex.buckets(docs.sparkSession)
    chunks = ex.chunked(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), chunk_bytes)

    def ask_anchors(content: dict) -> Iterator[tuple[int, bytes]]:
        hashes, count = np.unique(_Chunk(content, k).anchors()[0], return_counts=True)
        yield from questions(hashes, n, [(count > 1).astype(np.uint8)])

    answers = materialise(ex.answer(ex.ask(chunks, ask_anchors), n, repeated), "anchors", "uncompressed")

    def candidates(chunk: _Chunk, found: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """Windows whose anchor occurs elsewhere, and the answers left over."""
        anchors, own = chunk.anchors()
        hashes, place = np.unique(anchors, return_inverse=True)
        asked = len(sizes(hashes, n))
        again = np.append(bits(found[:asked], hashes, n)[place, 0], False)
        return again[own], found[asked:]

    def ask_edges(chunk_id: int, content: dict, found: list[bytes]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(content, k)
        hashes, first, twice, _, _ = _edges(chunk, candidates(chunk, found)[0])
        beside = [chunk.ids[chunk.doc[first]], ex.narrow(chunk.position[first]), twice.astype(np.uint8)]
        for bucket, payload in questions(hashes, n, beside, first=n):
            yield ex.part(chunk_id, bucket, payload)

    edges = ex.gather(chunks, answers, n, ask_edges, "chunk long, bucket int, payload binary")

    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()),
        ("kept_sha256", pa.string()), ("path_starts", pa.list_(pa.int64())), ("path_words", pa.list_(pa.int64())),
        ("source_ids", pa.list_(pa.int64())), ("source_starts", pa.list_(pa.int64()))])

    def compact(chunk_id: int, content: dict, found: list[bytes]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(content, k)
        candidate, rest = candidates(chunk, found)
        hashes, _, _, at, place = _edges(chunk, candidate)
        source_id, source_start = labels(rest, hashes, n)
        own_id, own_start = chunk.ids[chunk.doc[at]], chunk.position[at]
        sid, spos = source_id[place], source_start[place]
        earlier = (spos >= 0) & ((sid < own_id) | ((sid == own_id) & (spos < own_start)))
        order = np.argsort(at[earlier])
        at, sid, spos = at[earlier][order], sid[earlier][order], spos[earlier][order]
        # consecutive windows of one document with consecutive sources compact into one path
        if len(at):
            step = (np.diff(at) == 1) & (np.diff(spos) == 1) & (np.diff(sid) == 0) & (np.diff(chunk.doc[at]) == 0)
            head = np.flatnonzero(np.concatenate(([True], ~step)))
            size = np.diff(np.append(head, len(at))) + k - 1
        else:
            head = size = np.empty(0, np.int64)
        gone = np.zeros(len(chunk.doc) + 1, np.int64)
        np.add.at(gone, at[head], 1)
        np.add.at(gone, at[head] + size, -1)
        gone = np.cumsum(gone)[:-1] > 0
        of_doc = np.searchsorted(chunk.doc[at[head]], np.arange(len(chunk.texts) + 1))
        for lo in range(0, len(chunk.texts), 256):
            out = {f.name: [] for f in schema}
            for d in range(lo, min(lo + 256, len(chunk.texts))):
                w = slice(chunk.first[d], chunk.first[d + 1])
                keep = ~gone[w]
                kept = b" ".join([chunk.data[s:e] for s, e in zip(chunk.begin[w][keep].tolist(),
                                                                 chunk.end[w][keep].tolist())])
                p = head[of_doc[d]:of_doc[d + 1]]
                for name, value in zip(out, (
                        content["doc_id"][d], len(keep), int((~keep).sum()), kept if texts else None,
                        hashlib.sha256(kept).hexdigest(),
                        (at[p] - chunk.first[d]).tolist(), size[of_doc[d]:of_doc[d + 1]].tolist(),
                        [None if i == _NULL_ID else i for i in sid[p].tolist()], spos[p].tolist())):
                    out[name].append(value)
            yield rows(schema, out)

    return ex.gather(chunks, answers.unionByName(ex.answer(edges, n, sources)), n, compact,
                     "doc_id long, n_words long, n_removed long, kept binary, kept_sha256 string, "
                     "path_starts array<long>, path_words array<long>, source_ids array<long>, "
                     "source_starts array<long>")

