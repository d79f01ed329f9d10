"""Packing documents into sequences by length patterns.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens.
Only the histogram of piece lengths (at most ``capacity`` numbers) reaches the
driver, where it is planned: all patterns of up to three lengths that fill a
sequence exactly are enumerated, non-negative least squares fits how often
each should repeat to match the histogram, the counts are rounded without
taking more pieces than there are, and what is left is packed best-fit,
longest first, in bulk by length.

The plan says for every length which ranks go where. A piece's rank among
those of its length is its place in its task plus the number of such pieces in
earlier tasks, so no length, however common, meets in one task.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialise, rows
from .tokens import joined, spans

CAPACITY = 2048
SEPARATOR = 0  # the id behind every document
# of the fitted repeats that are used, and the smallest number that still counts as one
SHARES = ((1.0, 0.05), (1.0, 0.5), (0.9, 0.5), (0.7, 0.5), (0.4, 0.5), (0.1, 0.5))
_GROUP = 1 << 21  # bytes of text whose words are tokenised together

_AT_ONCE = 1 << 14  # words in one call of the tokenizer

# How the vocabulary's file says words are found. For texts of
# printable ASCII and Latin-1 letters its normaliser only lower-cases.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
_SHORT, _LONG = b"stmd", (b"re", b"ve", b"ll")  # what may follow an apostrophe

_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[*b"\t\n\r "]] = _SPACE
_KIND[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = _LETTER
_KIND[[*b"0123456789"]] = _DIGIT


def _lower(text: bytes) -> np.ndarray:
    """A plain text's bytes in lower case."""
    data = np.frombuffer(text.lower(), np.uint8).copy()
    latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
    data[latin] += 0x20
    return data


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of lower-case plain text start and end."""
    kind = _KIND[data]
    start = np.ones(len(data), bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    start &= kind != _SPACE
    mark = np.flatnonzero((data == ord("'")) & start)
    if len(mark):
        padded = np.concatenate((data, np.zeros(3, np.uint8)))
        one, two = padded[mark + 1], padded[mark + 2]
        size = np.isin(one, list(_SHORT)).astype(np.int64)
        for pair in _LONG:
            size[(one == pair[0]) & (two == pair[1])] = 2
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        rest = mark + 1 + size
        rest = rest[rest < len(data)]
        start[rest[kind[rest] == _LETTER]] = True
    starts = np.flatnonzero(start)
    bounds = np.append(np.flatnonzero(start | (kind == _SPACE)), len(data))
    return starts, bounds[np.searchsorted(bounds, starts, "right")]


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions begin, ..., begin + size - 1 of each range, one after another."""
    shift = np.cumsum(size) - size
    return np.repeat(begin - shift, size) + np.arange(int(size.sum()))


def _slices(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every ``_AT_ONCE`` words, from the words' ends."""
    hi = np.append(ends[_AT_ONCE - 1:-1:_AT_ONCE], ends[-1])
    return np.append(0, hi[:-1]), hi


def _groups(sizes: list[int]) -> Iterator[range]:
    """Consecutive texts of up to ``_GROUP`` characters together."""
    lo, total = 0, 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > _GROUP:
            yield range(lo, i)
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield range(lo, len(sizes))


class Encoder:
    """Token ids of texts, as little-endian 32-bit numbers.

    The different words of plain texts are tokenised once per group of texts;
    any other text goes to the tokenizer as a whole. Both give the
    tokenizer's own ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        steps = [n.get("type") for n in (parts["normalizer"] or {}).get("normalizers", [])]
        splits = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        suffix = parts["model"].get("end_of_word_suffix")
        self.by_word = bool(suffix) and steps == ["NFC", "Replace", "Lowercase"] and \
            splits[0].get("pattern", {}).get("Regex") == _SPLIT and splits[0].get("invert", False)
        vocabulary = self.tokenizer.get_vocab()
        # a text that may hold one of these is not plain: it is one id wherever it stands
        self.added = [t["content"].lower() for t in parts.get("added_tokens") or []]
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        if self.by_word:
            self.ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _is_plain(self, text: str) -> bool:
        if not (self.by_word and _PLAIN.fullmatch(text)):
            return False
        lower = text.lower()
        return not any(t in lower for t in self.added)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of plain texts, through the table of their different words."""
        raw, first = joined([t.encode() for t in texts])
        data = _lower(raw)
        starts, ends = _words(data)
        if not len(starts):
            return [np.empty(0, "<u4")] * len(texts)
        hashes = spans(data, starts, ends)
        _, sample, place = np.unique(hashes, return_index=True, return_inverse=True)
        # the different words, one space behind each, in one call
        size = ends[sample] - starts[sample] + 1
        words = data[np.minimum(_ragged(starts[sample], size), len(data) - 1)]
        words[np.cumsum(size) - 1] = ord(" ")
        found = [self._known(words[lo:hi]) for lo, hi in zip(*_slices(np.cumsum(size)))]
        ids, many = (np.concatenate(x) for x in zip(*found))
        stop = np.cumsum(many)
        counts = many[place]
        every = ids[_ragged((stop - many)[place], counts)]
        upto = np.concatenate(([0], np.cumsum(counts)))[np.searchsorted(starts, np.append(first, len(data) + 1))]
        return [every[lo:hi] for lo, hi in zip(upto, upto[1:])]

    def _known(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words with a space behind each, and how many each has."""
        text = words.tobytes().decode()
        (ids,) = self._whole([text])
        stop = np.flatnonzero(self.ends_word[ids]) + 1
        if len(stop) != text.count(" ") or stop[-1] != len(ids):  # a word without its end: ask one by one
            each = self._whole(text.split(" ")[:-1])
            return np.concatenate(each), np.array([len(e) for e in each])
        return ids, np.diff(stop, prepend=0)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.empty(0, "<u4")] * len(texts)
        plain, other = [], []
        for i, text in enumerate(texts):
            (plain if self._is_plain(text) else other).append(i)
        for own, encode in ((plain, self._plain), (other, self._whole)):
            for group in _groups([len(texts[i]) for i in own]):
                held = [own[j] for j in group]
                for i, found in zip(held, encode([texts[i] for i in held])):
                    out[i] = found
        return out


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, task, place): the pieces of all documents.

    ``place`` counts the earlier pieces of the same length in the task;
    ``ids`` are little-endian 32-bit numbers, null unless asked for.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("task", pa.int32()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encode, placed = TaskContext.get().partitionId(), _encoder(vocabulary), defaultdict(int)
        end, step = np.array([SEPARATOR], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for group in _groups([len(t) for t in texts]):
                out: dict[str, list] = {f.name: [] for f in schema}
                for i, found in zip(group, encode([texts[i] for i in group])):
                    doc_id, data = names[i], found.tobytes() + end
                    for piece, at in enumerate(range(0, len(data), step)):
                        own = data[at:at + step]
                        size = len(own) // 4
                        for name, value in zip(out, (doc_id, piece, at // 4, size, zlib.crc32(own),
                                                     own if ids else None, task, placed[size])):
                            out[name].append(value)
                        placed[size] += 1
                yield rows(schema, out)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, task int, place long")


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All ways to fill ``capacity`` exactly with up to three of ``lengths``: rows, 0 for an unused slot."""
    have = np.zeros(capacity + 1, bool)
    have[lengths] = True
    found = [np.array([[capacity, 0, 0]])] if have[capacity] else []
    own = np.flatnonzero(have[:capacity])
    for a in own[2 * own >= capacity].tolist():
        if have[capacity - a] and a < capacity:
            found.append(np.array([[a, capacity - a, 0]]))
    for a in own[3 * own >= capacity].tolist():  # the longest of three
        b = own[(own <= a) & (2 * own >= capacity - a) & (own < capacity - a)]
        b = b[have[capacity - a - b]]
        found.append(np.stack([np.full(len(b), a), b, capacity - a - b], 1))
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def nonnegative_least_squares(slots: np.ndarray, wanted: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Repeat counts x >= 0 that bring the used lengths nearest to ``wanted`` (accelerated projected gradient)."""
    used = slots > 0
    flat = slots[used]

    def uses(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, np.repeat(x, used.sum(axis=1)), len(wanted))

    def back(r: np.ndarray) -> np.ndarray:
        return np.where(used, r[slots], 0).sum(axis=1)

    if not len(slots):
        return np.zeros(0)
    v = np.ones(len(slots))
    for _ in range(20):  # the largest eigenvalue bounds the step
        w = back(uses(v))
        size = np.linalg.norm(w)
        v = w / size
    step, x, y, t = 1 / (1.05 * size), np.zeros(len(slots)), np.zeros(len(slots)), 1.0
    for _ in range(rounds):
        new = np.maximum(y - step * back(uses(y) - wanted), 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def _round(slots: np.ndarray, x: np.ndarray, least: float, left: np.ndarray) -> list[tuple[list[int], int]]:
    """(lengths, repeats) of the patterns used; takes their pieces from ``left``."""
    chosen = []
    for i in np.argsort(-x, kind="stable"):
        if x[i] < least:
            break
        used = slots[i][slots[i] > 0]
        kinds, each = np.unique(used, return_counts=True)
        times = int(min(np.floor(x[i] + 0.5) or 1, (left[kinds] // each).min()))
        if times:
            left[kinds] -= each * times
            chosen.append((used.tolist(), times))
    return chosen


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Best-fit, longest first, of the pieces in ``left``; like sequences are handled together."""
    by_gap: list[list[tuple[list[int], int]]] = [[] for _ in range(capacity + 1)]
    gaps = np.zeros(capacity + 1, bool)

    def add(gap: int, lengths: list[int], times: int) -> None:
        if times:
            by_gap[gap].append((lengths, times))
            gaps[gap] = True

    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            fitting = np.flatnonzero(gaps[length:])
            gap = int(fitting[0]) + length if len(fitting) else capacity
            if len(fitting):
                lengths, times = by_gap[gap].pop()
                gaps[gap] = bool(by_gap[gap])
            else:
                lengths, times = [], -(-n // (capacity // length))
            each = gap // length
            full = min(n // each, times)
            add(gap - each * length, lengths + [length] * each, full)
            n, times = n - full * each, times - full
            if n and times:  # the last pieces of this length go together
                add(gap - n * length, lengths + [length] * n, 1)
                n, times = 0, times - 1
            if lengths:
                add(gap, lengths, times)
    return [group for groups in by_gap for group in groups]


def _planned(slots: np.ndarray, x: np.ndarray, least: float, left: np.ndarray,
             capacity: int) -> list[tuple[list[int], int]]:
    return _round(slots, x, least, left) + _best_fit(left, capacity)


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Where pieces go: rows (length, first rank, number, first sequence, offset), sorted; and the number of sequences.

    ``histogram``: the number of pieces by length, from 0 to ``capacity``.
    """
    left = histogram.astype(np.int64).copy()
    slots = patterns(np.flatnonzero(left), capacity)
    fit = nonnegative_least_squares(slots, left.astype(np.float64))
    # patterns may use up the short pieces that would fill gaps beside the rest: keep the best of a few shares
    chosen = min((_planned(slots, share * fit, least, left.copy(), capacity) for share, least in SHARES),
                 key=lambda groups: sum(times for _, times in groups))
    taken, sequence, out = np.zeros(capacity + 1, np.int64), 0, []
    for lengths, times in chosen:
        offset = 0
        for length in lengths:
            out.append((length, int(taken[length]), times, sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    return np.array(sorted(out), np.int64).reshape(-1, 5), sequence


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Pack documents (doc_id, text) into sequences of at most ``capacity`` tokens.

    Returns per piece: doc_id, piece (from 0), start (its document's tokens
    before it), length, ids_crc32, sequence_id, offset (its place in the
    sequence; gapless from 0) and, if asked for, ids. A document is the token
    ids of its whole text and one separator; only longer ones are cut. Null and
    empty texts are one separator. Repeated rows are packed as often as they
    occur; other columns are not read; an empty table gives an empty result.
    """
    found = materialise(pieces(docs, vocabulary, capacity, ids), "pieces")
    counts = found.groupBy("task", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[r.length] = r.n
    table, _ = plan(histogram, capacity)
    # the plan is bounded by the patterns, not by the pieces
    slots = docs.sparkSession.createDataFrame(table.tolist(), "slot_length long, first_rank long, times long, "
                                              "first_sequence long, slot_offset long")
    rank = F.col("before") + F.col("place")
    fits = (F.col("length") == F.col("slot_length")) & (rank >= F.col("first_rank")) \
        & (rank < F.col("first_rank") + F.col("times"))
    return found.join(before, ["task", "length"]).join(F.broadcast(slots), fits).select(
        "doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else []),
        (F.col("first_sequence") + rank - F.col("first_rank")).alias("sequence_id"), F.col("slot_offset").alias("offset"))
