"""Removing repeated byte strings by longest-previous-factor arrays.

The suffixes of all texts, cut at ``length`` bytes, are put into suffix order:
a suffix's place is the fingerprint of its ``length``-byte prefix, so suffixes
with equal prefixes are neighbours, ordered by position. At that depth the
common prefix of neighbours is ``length`` or counts as none, and the previous
and next smaller positions of a suffix (``factors``) say whether an equal
string starts earlier (longest previous factor) or later.

Only suffixes that can repeat and are not settled otherwise are ordered. Every
window of ``length`` bytes has an anchor, the first of its short byte n-grams
with the smallest fingerprint, which each copy of the window shares. An
anchor's context is all the bytes that windows over it can reach. Chunks
exchange the contexts of their anchors: where a context occurs again, its
windows repeat; where an anchor has but one context, no other window can
equal them; only anchors with several contexts leave their windows to the
suffix order, and of copies of a context one chunk stands for all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import exchange as ex
from .common import materialise, rows
from .repeats import bits, questions, sizes
from .tokens import PIECE, distinct, mix, places, prefix_hashes, span_hashes

GRAM = 32  # bytes of an anchor, at most
_WINDOW = np.uint64(0x14057B7EF767814F)  # tells windows from other hashes


def _sliding(values: np.ndarray, span: int, best: np.ufunc) -> np.ndarray:
    """The smallest or largest of each ``span`` consecutive values, by block-wise running bests."""
    n = len(values) - span + 1
    if n <= 0:
        return values[:0]
    pad = -len(values) % span
    blocks = np.concatenate((values, np.full(pad, values[-1]))).reshape(-1, span)
    ahead = best.accumulate(blocks, axis=1).reshape(-1)
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return best(behind[:n], ahead[span - 1:span - 1 + n])


class _Piece:
    """Some fragments of texts, joined: their windows' anchors and the anchors' contexts."""

    def __init__(self, fragments: list[tuple[int, int, bytes]], length: int):
        self.doc = np.array([f[0] for f in fragments], np.int64)
        self.offset = np.array([f[1] for f in fragments], np.int64)  # in its document
        size = np.array([len(f[2]) for f in fragments], np.int64)
        self.begin = np.cumsum(size + 1) - size - 1
        self.data = np.frombuffer(b"\n".join(f[2] for f in fragments), np.uint8)
        self.length = length
        n = max(len(self.data) - length + 1, 0)
        step = np.zeros(n + 1, np.int64)
        windows = np.maximum(size - length + 1, 0)
        np.add.at(step, np.minimum(self.begin, n), (windows > 0).astype(np.int64))
        np.add.at(step, np.minimum(self.begin + windows, n), -(windows > 0).astype(np.int64))
        self.valid = np.cumsum(step)[:n] > 0
        self.anchors = self.contexts = np.empty(0, np.uint64)
        self.run_sizes = self.run_anchor = np.empty(0, np.int64)
        if not n:
            return
        sums = prefix_hashes(self.data)
        gram = min(GRAM, length)
        at = np.arange(len(self.data) - gram + 1)
        grams = mix(span_hashes(sums, at, at + gram))
        span = length - gram + 1
        smallest = _sliding(grams, span, np.minimum)
        # a gram is an anchor where it is the smallest of some window over it
        padded = np.concatenate((np.zeros(span - 1, np.uint64), smallest, np.zeros(span - 1, np.uint64)))
        chosen = np.flatnonzero(grams == _sliding(padded, span, np.maximum))
        # anchors are small by choice; mixed again they spread over the buckets
        self.anchors = mix(grams[chosen])
        home = np.searchsorted(self.begin, chosen, "right") - 1
        lo = np.maximum(chosen - span + 1, self.begin[home])
        hi = np.maximum(np.minimum(chosen + length, self.begin[home] + size[home]), lo)
        # where the anchor lies in its context counts too: clipped contexts of one place must differ
        shape = (chosen - lo).astype(np.uint64) * np.uint64(length + span) + (hi - lo).astype(np.uint64)
        self.contexts = mix(span_hashes(sums, lo, hi) + mix(shape + np.uint64(1)))
        # runs of windows with the same anchor: its value, and the first place from the window on
        change = smallest[1:] != smallest[:-1]
        inner = chosen[chosen < n - 1]
        change[inner[smallest[inner] == grams[inner]]] = True
        last = np.append(np.flatnonzero(change), n - 1)
        self.run_sizes = np.diff(last, prepend=-1)
        self.run_anchor = np.searchsorted(chosen, last)
        while len(other := np.flatnonzero(grams[chosen[self.run_anchor]] != smallest[last])):
            self.run_anchor[other] += 1

    def windows(self, at: np.ndarray) -> np.ndarray:
        return mix(span_hashes(prefix_hashes(self.data), at, at + self.length) ^ _WINDOW)

    def spans(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, start, end) of the maximal runs of bytes that repeated windows cover."""
        step = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(step, repeated, 1)
        np.add.at(step, repeated + self.length, -1)
        edges = np.diff(np.concatenate(([False], np.cumsum(step) > 0)).view(np.int8))
        start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        at = np.searchsorted(self.begin, start, "right") - 1
        shift = self.offset[at] - self.begin[at]
        return self.doc[at], start + shift, end + shift


def _pieces(texts: list[bytes], length: int) -> Iterator[_Piece]:
    """The texts in pieces of bounded size; a longer text in fragments that share length - 1 bytes."""
    room = max(PIECE, 2 * length)
    held, size = [], 0
    for d, text in enumerate(texts):
        for at in range(0, max(len(text) - length, 0) + 1, room - length + 1):
            part = text[at:at + room]
            if held and size + len(part) + 1 > room:
                yield _Piece(held, length)
                held, size = [], 0
            held.append((d, at, part))
            size += len(part) + 1
    if held:
        yield _Piece(held, length)


def _asked_first(pieces: list[_Piece]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's different (anchor, context), sorted; which occur twice or more; and where each piece's are."""
    anchors = np.concatenate([p.anchors for p in pieces] or [np.empty(0, np.uint64)])
    contexts = np.concatenate([p.contexts for p in pieces] or [np.empty(0, np.uint64)])
    order = np.lexsort((contexts, anchors))
    a, c = anchors[order], contexts[order]
    head = np.concatenate(([True], (a[1:] != a[:-1]) | (c[1:] != c[:-1]))) if len(a) else np.empty(0, bool)
    place = np.empty(len(a), np.int64)
    place[order] = np.cumsum(head) - 1
    return a[head], c[head], np.bincount(place, minlength=int(head.sum())) > 1, place


def _contexts(asked: list[bytes]) -> list[bytes]:
    """Two bits per asked (anchor, context): does it occur twice or more? is the asker to order its windows?"""
    parts = [ex.unframe(q) for q in asked]
    anchors = [ex.unpack_sorted(p[0]) for p in parts]
    a, c = np.concatenate(anchors), np.concatenate([ex.unpack(p[1]) for p in parts])
    twice = np.concatenate([ex.unpack(p[2]) for p in parts]).astype(bool)
    order = np.lexsort((c, a))  # stable: of like entries the first asked comes first
    a, c = a[order], c[order]
    new_anchor = np.concatenate(([True], a[1:] != a[:-1]))
    new = new_anchor.copy()
    new[1:] |= c[1:] != c[:-1]
    heads, anchor_heads = np.flatnonzero(new), np.flatnonzero(new_anchor)
    entry, anchor = np.cumsum(new) - 1, np.cumsum(new_anchor) - 1
    many = np.diff(np.append(heads, len(a))) > 1
    many |= np.logical_or.reduceat(twice[order], heads)
    several = np.add.reduceat(new.astype(np.int64), anchor_heads) > 1
    flags = np.empty((len(a), 2), bool)
    flags[order, 0] = many[entry]
    flags[order, 1] = several[anchor] & new  # the first asker stands for all with this context
    return [np.packbits(f.reshape(-1)).tobytes() for f in np.split(flags, np.cumsum([len(x) for x in anchors])[:-1])]


def _settle(piece: _Piece, repeated: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows known to repeat, windows to order), from the flags of the piece's anchors."""
    if not len(piece.run_sizes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    sure = np.repeat(repeated[piece.run_anchor], piece.run_sizes) & piece.valid
    ask = np.repeat(order[piece.run_anchor], piece.run_sizes) & piece.valid
    return np.flatnonzero(sure), np.flatnonzero(ask)


def factors(order: np.ndarray, equal: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix has an equal one at an earlier, and at a later position.

    ``order``: suffixes in suffix order; ``equal``: for each but the first,
    whether it shares the full prefix with its neighbour before; ``positions``:
    each suffix's position. Among neighbours with equal prefixes, the previous
    or next smaller position exists unless the suffix holds the smallest one.
    """
    if not len(order):
        return np.empty(0, bool), np.empty(0, bool)
    run = np.cumsum(np.concatenate(([0], ~equal)))
    heads = np.flatnonzero(np.concatenate(([True], ~equal)))
    placed = positions[order]
    earlier, later = np.empty(len(order), bool), np.empty(len(order), bool)
    earlier[order] = placed > np.minimum.reduceat(placed, heads)[run]
    later[order] = placed < np.maximum.reduceat(placed, heads)[run]
    return earlier, later


def _previous_and_next(asked: list[bytes]) -> list[bytes]:
    """Two bits per asked suffix: does an equal one start earlier, later? Chunks ask in the order of positions."""
    parts = [ex.unframe(q) for q in asked]
    hashes = [ex.unpack_sorted(p[0]) for p in parts]
    every, many = np.concatenate(hashes), np.concatenate([ex.unpack(p[1]) for p in parts]).astype(bool)
    position = np.arange(len(every))
    order = np.argsort(every, kind="stable")
    placed = every[order]
    earlier, later = factors(order, placed[1:] == placed[:-1], position)
    later |= many  # a chunk asks once for its own repeats
    both = np.stack([earlier, later], 1)
    return [np.packbits(b.reshape(-1)).tobytes() for b in np.split(both, np.cumsum([len(h) for h in hashes])[:-1])]


def remove_repeats(docs: DataFrame, length: int = 200, chunk_bytes: int = ex.CHUNK_BYTES,
                   texts: bool = True) -> DataFrame:
    """Texts without the bytes that lie in a ``length``-byte string which starts elsewhere too.

    Columns: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept
    (the remaining bytes; null without ``texts``), kept_sha256, span_starts and
    span_ends (bytes, end exclusive). Matches may overlap, lie in one document
    or in several, never cross documents, and are judged on the input. A text
    is read whole as UTF-8 (null: empty); rows that repeat a document match each
    other. An empty table gives an empty result.
    """
    n = ex.buckets(docs.sparkSession)
    chunks = ex.chunked(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), chunk_bytes)

    def ask_contexts(content: dict) -> Iterator[tuple[int, bytes]]:
        anchors, contexts, twice, _ = _asked_first(list(_pieces(content["text"], length)))
        yield from questions(anchors, n, [contexts, twice.astype(np.uint8)])

    known = materialise(ex.answer(ex.ask(chunks, ask_contexts), n, _contexts), "contexts", "uncompressed")

    def settled(content: dict, found: list[bytes]) -> tuple[list[tuple], list[bytes]]:
        """(piece, windows known to repeat, those to order, which of these it knows to repeat); answers left over."""
        pieces = list(_pieces(content["text"], length))
        anchors, _, _, place = _asked_first(pieces)
        asked = len(sizes(anchors, n))
        flags = bits(found[:asked], anchors, n, 2)
        claimed, out, done = np.zeros(len(anchors), bool), [], 0
        for piece in pieces:
            own = place[done:done + len(piece.anchors)]
            done += len(own)
            # of a context that repeats in the chunk, its first anchor stands for the others
            first = np.zeros(len(own), bool)
            first[np.unique(own, return_index=True)[1]] = True
            first &= ~claimed[own]
            claimed[own] = True
            sure, ask = _settle(piece, flags[own, 0], flags[own, 1] & first)
            out.append((piece, sure, ask))
        return out, found[asked:]

    def ask_windows(chunk_id: int, content: dict, found: list[bytes]) -> Iterator[pa.RecordBatch]:
        every, surely = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        for piece, sure, ask in settled(content, found)[0]:
            hashes = piece.windows(ask)
            every.append(hashes)
            surely.append(hashes[np.isin(ask, sure, assume_unique=True)])
        hashes, count = np.unique(np.concatenate(every), return_counts=True)
        twice = count > 1
        twice[places(hashes, np.concatenate(surely))] = True
        for bucket, payload in questions(hashes, n, [twice.astype(np.uint8)], first=n):
            yield ex.part(chunk_id, bucket, payload)

    asked = ex.gather(chunks, known, n, ask_windows, "chunk long, bucket int, payload binary")
    answers = known.unionByName(ex.answer(asked, n, _previous_and_next))

    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept", pa.binary()), ("kept_sha256", pa.string()),
        ("span_starts", pa.list_(pa.int64())), ("span_ends", pa.list_(pa.int64()))])

    def finish(_: int, content: dict, found: list[bytes]) -> Iterator[pa.RecordBatch]:
        pieces, rest = settled(content, found)
        asked = [piece.windows(ask) for piece, _, ask in pieces]
        every = np.concatenate([*asked, np.empty(0, np.uint64)])
        hashes = distinct(every)
        again = bits(rest, hashes, n, 2).any(axis=1)[places(hashes, every)]
        spans: list[list[tuple[int, int]]] = [[] for _ in content["text"]]
        done = 0
        for piece, sure, ask in pieces:
            repeats = np.zeros(len(piece.valid), bool)
            repeats[sure] = True
            repeats[ask[again[done:done + len(ask)]]] = True
            done += len(ask)
            for d, s, e in zip(*(x.tolist() for x in piece.spans(np.flatnonzero(repeats)))):
                if spans[d] and s <= spans[d][-1][1]:  # fragments of one text overlap
                    spans[d][-1] = spans[d][-1][0], max(e, spans[d][-1][1])
                else:
                    spans[d].append((s, e))
        for lo in range(0, len(spans), 256):
            out = {f.name: [] for f in schema}
            for doc_id, text, gone in zip(*(x[lo:lo + 256] for x in (content["doc_id"], content["text"], spans))):
                keep = zip([0, *(e for _, e in gone)], [*(s for s, _ in gone), len(text)])
                kept = b"".join([text[s:e] for s, e in keep])
                for name, value in zip(out, (
                        doc_id, len(text), len(text) - len(kept), len(gone), kept if texts else None,
                        hashlib.sha256(kept).hexdigest(), [s for s, _ in gone], [e for _, e in gone])):
                    out[name].append(value)
            yield rows(schema, out)

    return ex.gather(chunks, answers, n, finish,
                     "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string, "
                     "span_starts array<long>, span_ends array<long>")
