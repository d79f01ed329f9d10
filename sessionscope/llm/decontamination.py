"""Benchmark passages in documents, copied or asked again with other values.

Texts become tokens by code point: runs of letters, numbers, and single
characters of scripts written without spaces. A template replaces numbers,
capitalised words and units behind numbers by typed placeholders; beside it the
plain view keeps every word, in lower case. Windows of both views are hashed
and joined with those of the benchmark. Hits that follow one another at the
same distance form a run; where the run goes through placeholders, the values
in the slots must correspond: one benchmark value, one document value, and
back. A capitalised word that only begins a sentence of the item is no slot:
it must be the same word.

A benchmark of up to ``MAX_WINDOWS`` windows is broadcast, measured before. A
larger one stays a table: its windows are hash-joined with the different
windows of every text that pass a bitmap of fixed size, and only the texts and
items that share one meet to be compared. Both ways judge alike.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import carried, column, materialise, restored, rows, text_bytes
from .tokens import joined, mix, spans, word_windows

WINDOW = 8  # tokens
SHORTEST = 3  # an item with fewer tokens cannot be told from chance and is never found
MAX_WINDOWS = 1 << 20  # of a benchmark that is broadcast; a larger one is joined
_GROUP = 1 << 20  # bytes of text handled at once (a longer text alone)

# Words that stand for numbers, and units.
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
                "million billion").split()
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons ounce "
         "ounces pound pounds ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day "
         "days week weeks month months year years dollar dollars cent cents euro euros percent degree degrees meter "
         "meters metre metres kilometer kilometers centimeter centimeters mph kph watt watts volt volts").split()

LITERAL, NUMBER, NAME, UNIT = range(4)
_PLACE = np.array([0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_TEMPLATE = np.uint64(0x27D4EB2F165667C5)  # tells templates from plain windows

_BREAK, _LETTER, _DIGIT, _POINT, _ALONE = range(5)
# Code points of scripts written without spaces; a character is a token.
_UNSPACED = ((0x0E00, 0x0E7F), (0x0E80, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF),
             (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_SENTENCE_END = ".!?:;\n\u2026\u3002\uff01\uff1f"


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower-case form of every code point."""
    kind, lower = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha() or unicodedata.category(s) in ("Mn", "Mc"):  # marks belong to their letter
            kind[c] = _LETTER
            small = s.lower()
            lower[c] = ord(small) if len(small) == 1 else c
        elif s.isdecimal():
            kind[c] = _DIGIT
    for first, last in _UNSPACED:
        own = kind[first:last + 1]
        own[own == _LETTER] = _ALONE
    kind[[ord("."), ord(",")]] = _POINT
    return kind, lower


def _hashes_of(listed: list[str]) -> np.ndarray:
    data, first = joined([w.encode() for w in listed])
    array = np.frombuffer(data, np.uint8)
    return np.sort(spans(array, first, first + [len(w) for w in listed]))


class _Tokens:
    """The tokens of some texts: their document, plain hash, type and template code."""

    def __init__(self, texts: list[bytes]):
        kinds, lowered = _characters()
        each = [np.frombuffer(t.decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for t in texts]
        first = np.concatenate(([0], np.cumsum([len(t) + 1 for t in each]))).astype(np.int64)
        data = np.concatenate([np.append(t, np.uint32(10)) for t in each]) if each else np.empty(0, np.uint32)
        lower = lowered[data]
        kind = kinds[data]
        points = np.flatnonzero(kind == _POINT)
        inner = points[(points > 0) & (points < len(data) - 1)]
        inner = inner[(kind[inner - 1] == _DIGIT) & (kind[inner + 1] == _DIGIT)]
        kind[points] = _BREAK
        kind[inner] = _DIGIT  # a point inside a number
        change = np.flatnonzero((kind[1:] != kind[:-1]) | (kind[1:] == _ALONE)) + 1 if len(data) else np.empty(0, np.int64)
        bounds = np.concatenate(([0], change, [len(data)])) if len(data) else np.zeros(1, np.int64)
        token = kind[bounds[:-1]] != _BREAK
        starts, ends = bounds[:-1][token], bounds[1:][token]
        self.doc = np.searchsorted(first, starts, "right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        raw = np.frombuffer(lower.tobytes().decode("utf-32-le", "replace").encode(), np.uint8)
        width = 1 + (lower > 0x7F) + (lower > 0x7FF).astype(np.int64) + (lower > 0xFFFF)
        place = np.concatenate(([0], np.cumsum(width)))
        self.plain = spans(raw, place[starts], place[ends])
        number = (kind[starts] == _DIGIT) | _among(self.plain, _NUMBERS)
        unit = _among(self.plain, _UNIT_WORDS)
        unit[1:] &= number[:-1] & (self.doc[1:] == self.doc[:-1])
        unit[:1] = False
        name = (lower != data)[starts]
        self.type = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, LITERAL)))
        self.code = np.where(self.type == LITERAL, self.plain, _PLACE[self.type])
        ended = np.concatenate(([0], np.cumsum(np.isin(data, _SENTENCE_ENDS))))
        self.begins = np.ones(len(starts), bool)  # a sentence
        self.begins[1:] = (ended[starts[1:]] > ended[ends[:-1]]) | (self.doc[1:] != self.doc[:-1])

    def firm(self) -> np.ndarray:
        """Capitalised words that only begin a sentence: nothing says that they are names.

        Not those that are capitalised elsewhere in the text, nor in front of another name.
        """
        name = self.type == NAME
        out = name & self.begins
        inner = name & ~self.begins
        out[:-1] &= ~(inner[1:] & (self.doc[1:] == self.doc[:-1]))
        key = mix(self.plain + mix(self.doc.astype(np.uint64)))
        return out & ~np.isin(key, key[inner])

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(plain, template, dense template, inside one text) for every window; others get hash 0.

        A template with literals in less than half its places is dense: it
        says little, and counts only where the whole item follows.
        """
        plain, template = word_windows(self.plain, size), word_windows(self.code, size) ^ _TEMPLATE
        n = len(plain)
        inside = self.doc[:n] == self.doc[size - 1:] if n else np.empty(0, bool)
        literal = np.concatenate(([0], np.cumsum(self.type == LITERAL)))
        said = literal[size:size + n] - literal[:n]
        half = 2 * said >= size
        return np.where(inside, plain, 0), np.where(inside & half, template, 0), \
            np.where(inside & ~half & (said > 0), template, 0), inside


def _among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    return listed[np.minimum(np.searchsorted(listed, values), len(listed) - 1)] == values


_NUMBERS, _UNIT_WORDS = _hashes_of(NUMBER_WORDS), _hashes_of(UNITS)
_SENTENCE_ENDS = np.array([ord(c) for c in _SENTENCE_END], np.uint32)


@dataclass
class Index:
    """Some items: their windows by size, sorted by hash, and their tokens."""

    items: list[list[int]]  # ids by text
    first: np.ndarray  # of each item's tokens in the arrays below
    plain: np.ndarray
    type: np.ndarray
    code: np.ndarray
    firm: np.ndarray
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # size -> hash, item, place in it
    sieve: dict[int, np.ndarray]  # size -> which low hash bits occur


_SIEVE = np.uint64((1 << 22) - 1)


def build_index(items: list[tuple[list[int], bytes]]) -> Index:
    tokens = _Tokens([t for _, t in items])
    sizes = np.diff(tokens.first)
    windows, sieve = {}, {}
    for size in range(SHORTEST, WINDOW + 1):
        own = sizes >= WINDOW if size == WINDOW else sizes == size
        if not own.any():
            continue
        plain, template, dense, inside = tokens.windows(size)
        at = np.flatnonzero(inside & own[tokens.doc[:len(inside)]])
        hashes = np.concatenate((plain[at], template[at], dense[at]))
        at = np.concatenate((at, at, at))[hashes > 0]
        hashes = hashes[hashes > 0]
        order = np.argsort(hashes, kind="stable")
        doc = tokens.doc[at[order]]
        windows[size] = hashes[order], doc, at[order] - tokens.first[doc]
        sieve[size] = np.zeros(int(_SIEVE) + 1, bool)
        sieve[size][hashes & _SIEVE] = True
    return Index([i for i, _ in items], tokens.first, tokens.plain, tokens.type, tokens.code, tokens.firm(),
                 windows, sieve)


def _hits(tokens: _Tokens, index: Index) -> np.ndarray:
    """Rows (document, item, distance, place in the item, window size, plain 1, template 0 or dense -1), sorted."""
    out = []
    for size, (hashes, item, place) in index.windows.items():
        plain, template, dense, _ = tokens.windows(size)
        for view, is_plain in ((plain, 1), (template, 0), (dense, -1)):
            at = np.flatnonzero(index.sieve[size][view & _SIEVE])
            at = at[view[at] > 0]
            lo, hi = np.searchsorted(hashes, view[at]), np.searchsorted(hashes, view[at], "right")
            n = hi - lo
            row = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            at = np.repeat(at, n)
            doc = tokens.doc[at]
            if is_plain < 0:  # the whole item must lie there
                begin, n = at - place[row], np.diff(index.first)[item[row]]
                fits = (begin >= tokens.first[doc]) & (begin + n <= tokens.first[doc + 1])
                at, row, doc, begin, n = (x[fits] for x in (at, row, doc, begin, n))
                whole = np.ones(len(at), bool)
                for k in range(int(n.max(initial=0))):  # token by token, among those that still agree
                    left = np.flatnonzero(whole & (n > k))
                    if not len(left):
                        break
                    whole[left] = tokens.code[begin[left] + k] == index.code[index.first[item[row[left]]] + k]
                at, row, doc = at[whole], row[whole], doc[whole]
            out.append(np.stack([doc, item[row], at - tokens.first[doc] - place[row], place[row],
                                 np.full(len(at), size), np.full(len(at), is_plain)], 1))
    hits = np.concatenate(out) if out else np.empty((0, 6), np.int64)
    return hits[np.lexsort(hits.T[3::-1])]


def _consistent(ours: np.ndarray, theirs: np.ndarray) -> float:
    """The share of slots whose values correspond one to one (1 without slots)."""
    if not len(ours):
        return 1.0
    pairs, n = np.unique(np.stack([ours, theirs]), axis=1, return_counts=True)
    shares = []
    for side in pairs:
        _, group = np.unique(side, return_inverse=True)
        best = np.zeros(group.max() + 1, np.int64)
        np.maximum.at(best, group, n)
        shares.append(best.sum() / n.sum())
    return min(shares)


@dataclass(frozen=True)
class Limits:
    """When a document counts as holding an item."""

    coverage: float = 0.5  # of the item's tokens, in one run
    run: int = 13  # or so many tokens in one run
    consistency: float = 0.75  # of the slots


def _judge(tokens: _Tokens, index: Index, limits: Limits) -> dict[int, dict[int, tuple[float, float]]]:
    """document -> item -> (coverage, slot consistency) of the items found."""
    hits = _hits(tokens, index)
    found: dict[int, dict[int, tuple[float, float]]] = {}
    if not len(hits):
        return found
    same = (hits[1:, :3] == hits[:-1, :3]).all(axis=1) & (hits[1:, 3] <= hits[:-1, 3] + hits[:-1, 4])
    heads = np.flatnonzero(np.concatenate(([True], ~same)))
    for lo, hi in zip(heads, np.append(heads[1:], len(hits))):
        doc, item, shift, start = hits[lo, :4].tolist()
        end = int((hits[lo:hi, 3] + hits[lo:hi, 4]).max())
        if (hits[lo:hi, 5] < 0).any():  # found whole
            start, end = 0, int(index.first[item + 1] - index.first[item])
        size = int(index.first[item + 1] - index.first[item])
        # a firm word that differs ends the run: the longest piece between such words counts
        at = np.arange(start, end)
        differ = at[index.firm[index.first[item] + at]
                    & (tokens.plain[tokens.first[doc] + at + shift] != index.plain[index.first[item] + at])]
        if len(differ):
            edges = np.concatenate(([start - 1], differ, [end]))
            widest = int(np.argmax(np.diff(edges)))
            start, end = int(edges[widest]) + 1, int(edges[widest + 1])
            if (hits[lo:hi, 5] < 0).any() or end - start < min(WINDOW, size):
                continue  # dense in slots: only whole; else no shorter than a window
        if end - start < limits.run and end - start < limits.coverage * size:
            continue
        ours = slice(tokens.first[doc] + start + shift, tokens.first[doc] + end + shift)
        theirs = slice(index.first[item] + start, index.first[item] + end)
        slots = index.type[theirs] != LITERAL
        share = _consistent(tokens.plain[ours][slots], index.plain[theirs][slots])
        if share < limits.consistency:
            continue
        best = found.setdefault(doc, {})
        now = ((end - start) / size, share)
        best[item] = max(best.get(item, now), now)
    return found


def _groups(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > _GROUP:
            yield lo, texts[lo:i]
            lo, size = i, 0
        size += len(t)
    if texts[lo:]:
        yield lo, texts[lo:]


ADDED = {"contaminated": "boolean", "item_ids": "array<bigint>", "coverage": "double", "consistency": "double"}


def _names(docs: DataFrame, keep: list[str] | None) -> list[str]:
    return [c for c in (docs.columns if keep is None else keep) if c not in ADDED]


def _broadcast(docs: DataFrame, columns: list[str], index: Index, limits: Limits) -> DataFrame:
    """``columns`` and the added ones, with the whole index in every task."""
    held = docs.sparkSession.sparkContext.broadcast(index)
    read, kept, place = carried(docs, columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            texts = list(text_bytes(batch.column(place)))
            out: list[list] = [[False] * len(texts), [[] for _ in texts], [0.0] * len(texts), [0.0] * len(texts)]
            for lo, group in _groups(texts):
                for doc, items in _judge(_Tokens(group), index, limits).items():
                    i = lo + doc
                    out[0][i] = True
                    out[1][i] = sorted({d for k in items for d in index.items[k]})
                    out[2][i], out[3][i] = max(items.values())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(columns)], pa.array(out[0], pa.bool_()), pa.array(out[1], pa.list_(pa.int64())),
                 pa.array(out[2], pa.float64()), pa.array(out[3], pa.float64())],
                names=[*batch.schema.names[:len(columns)], *ADDED])

    schema = ", ".join([*kept, *(f"{c} {t}" for c, t in ADDED.items())])
    return restored(read.mapInArrow(run, schema), columns, list(ADDED))


_SIEVE_WORDS = 1 << 18  # 64-bit words of the bitmap that texts' windows pass
_SHARES = 64  # of a text's candidate items, compared apart


def _sized(hashes: np.ndarray, size: int) -> np.ndarray:
    return mix(hashes + np.uint64(size))


def _item_windows(items: DataFrame) -> DataFrame:
    """(hash, size, item) of (item, text)."""
    schema = pa.schema([("hash", pa.int64()), ("size", pa.int32()), ("item", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), list(text_bytes(batch.column(1)))
            for lo, group in _groups(texts):
                for size, (hashes, item, _) in build_index([([], t) for t in group]).windows.items():
                    yield rows(schema, {"hash": _sized(hashes, size).view(np.int64), "size": np.full(len(hashes), size),
                                        "item": [names[lo + i] for i in item.tolist()]})

    return items.mapInArrow(run, "hash long, size int, item string").distinct()


def _text_windows(texts: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, hash): the different windows of (key, text) that the benchmark may have."""
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most WINDOW
    bits = windows.groupBy(F.pmod("hash", F.lit(_SIEVE_WORDS)).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(hash, 58) as int))")).alias("bits")).toArrow()
    sieve = np.zeros(_SIEVE_WORDS, np.uint64)  # of fixed size
    sieve[np.asarray(bits.column("at"))] = np.asarray(bits.column("bits")).view(np.uint64)
    held = texts.sparkSession.sparkContext.broadcast(sieve)
    schema = pa.schema([("key", pa.string()), ("hash", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for lo, group in _groups(list(text_bytes(batch.column(1)))):
                tokens = _Tokens(group)
                for size in sizes:
                    for view in tokens.windows(size)[:3]:
                        at = np.flatnonzero(view > 0)
                        h = _sized(view[at], size)
                        word = held.value[(h & np.uint64(_SIEVE_WORDS - 1)).astype(np.int64)]
                        passed = word >> (h >> np.uint64(58)) & np.uint64(1) > 0
                        pairs = np.unique(np.stack([tokens.doc[at[passed]], h[passed].view(np.int64)]), axis=1)
                        if pairs.shape[1]:
                            yield rows(schema, {"key": [names[lo + d] for d in pairs[0].tolist()], "hash": pairs[1]})

    return texts.mapInArrow(run, "key string, hash long").distinct()


def _joined(docs: DataFrame, columns: list[str], items: DataFrame, limits: Limits) -> DataFrame:
    """The same with the benchmark (ids, text) as a table; what a text holds is found once for equal texts."""
    key, text = F.sha2(F.col("text").cast("binary"), 256), F.col("text").cast("string")
    listed = materialise(items.select(F.sha2(F.col("text").cast("binary"), 256).alias("item"), "ids", "text"), "items")
    windows = materialise(_item_windows(listed.select("item", "text")), "windows")
    read = docs.where(F.col("text").isNotNull()).select(key.alias("key"), text.alias("text"))
    pairs = materialise(_text_windows(read, windows).join(windows.select("hash", "item").distinct(), "hash")
                        .select("key", "item").distinct(), "pairs")
    shared = read.join(pairs.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    some = pairs.join(listed, "item").groupBy("key", F.pmod(F.xxhash64("item"), F.lit(_SHARES)).alias("share")) \
        .agg(F.collect_list(F.struct("ids", F.col("text").alias("item"))).alias("items"))
    schema = pa.schema([("key", pa.string()), ("ids", pa.list_(pa.int64())), ("coverage", pa.float64()),
                        ("consistency", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, own, asked in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2)):
                index = build_index([(x["ids"], x["item"].encode()) for x in asked.as_py()])
                for items in _judge(_Tokens([own]), index, limits).values():
                    coverage, consistency = max(items.values())
                    yield rows(schema, {"key": [name], "ids": [sorted({d for k in items for d in index.items[k]})],
                                        "coverage": [coverage], "consistency": [consistency]})

    found = shared.join(some, "key").select("key", "text", "items") \
        .mapInArrow(run, "key string, ids array<long>, coverage double, consistency double") \
        .groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"),
                            F.max(F.struct("coverage", "consistency")).alias("best"))
    found = materialise(found, "found").withColumnsRenamed({"key": "key found", "ids": "ids found", "best": "best found"})
    best = F.col("`best found`")
    return docs.join(found, key == F.col("`key found`"), "left").select(
        *map(column, columns), F.col("`key found`").isNotNull().alias("contaminated"),
        F.coalesce(F.col("`ids found`"), F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce(best["coverage"], F.lit(0.0)).alias("coverage"),
        F.coalesce(best["consistency"], F.lit(0.0)).alias("consistency"))


def find(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, limits: Limits = Limits(),
         max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Which documents hold benchmark items (item_id, text).

    Returns the columns ``keep`` of ``docs`` (all by default; one named like an
    added column is replaced, its values are never read) and: contaminated;
    item_ids, sorted; coverage, the largest share of an item's tokens found in
    one run; consistency of that run's slots. A run counts from ``limits.run``
    tokens or ``limits.coverage`` of the item on. Null and empty texts hold
    nothing; items with a null or too short text are never found, and an item
    with a null id is found but not listed; items of the same text are compared
    once. Repeated documents are judged alike; empty tables give no finding.
    """
    columns = _names(docs, keep)
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")) \
        .where(F.col("text").isNotNull()).groupBy("text").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    # a token has at least one character, two views have a window each
    total = items.agg(F.sum(2 * F.octet_length("text") + F.size("ids")).alias("n")).first().n or 0
    if total > max_windows:
        return _joined(docs, columns, items, limits)
    chosen = sorted((r.text.encode(), r.ids) for r in items.collect())
    return _broadcast(docs, columns, build_index([(ids, text) for text, ids in chosen]), limits)
