"""Phrases whose words belong together, per language, from all documents.

Every word occurrence is a suffix pointer of up to four words inside its piece
of text. A task sorts the pointers of some megabytes of text, keeps the
different ones with their number and routes them by their leading words: by two
words, by three where both are hot, by four where three are. A word is hot if it
occurs more often than a bucket's share, so there are fewer hot words than
buckets and no route but a single four-word one can outgrow a bucket. A bucket
runs a multikey three-way quicksort over its pointers, word by word to four:
the sizes of the equal partitions are the phrases' counts, and partitions below
the least count are abandoned. Counts of phrases shorter than their route are
added up over the buckets.

Words travel as 64-bit fingerprints of (language, word). The vocabulary of all
words proves them different, or another set of fingerprints is taken, so counts
are exact. Words below the least count cannot be in a phrase: a bitmap of fixed
size leaves most of them out of the routing, the sort abandons the rest.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import exchange as ex
from .common import materialise, text_bytes
from .tokens import distinct, mix, spans

LONGEST = 4  # words of a phrase
LEAST = 30  # occurrences of a phrase
INSIDE = 80  # per cent of a phrase's occurrences that lie in a longer one, which then replaces it
_SEGMENT = 1 << 23  # bytes of text handled at once
_BUCKET = 1 << 20  # suffix pointers of a bucket
_COARSE = 256  # buckets that a segment sends to; more are reached in two steps
_SMALL = 1 << 13  # a partition of the quicksort that is finished by the library's sort
_FILTER_WORDS = 1 << 19  # 64-bit words of the bitmap of frequent words
_COMMON = (1 << 16) - 1  # most frequent words, known to every task by number
_SHARES = 64  # tasks that may rank a language's phrases
_LONG_WORD = 256  # bytes from which a word's fingerprint is a cryptographic one

_KIND = np.zeros(256, np.uint8)  # 0 in a word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_PIECE_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------- words --
def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, bytes]]]:
    """(language, text) pairs, some megabytes at a time: texts joined by line ends, long ones cut between pieces."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
            at = 0
            while len(text) - at > _SEGMENT:
                end = _PIECE_END.search(text, at + _SEGMENT)
                upto = end.end() if end else len(text)
                yield [(lang, text[at:upto])]
                at = upto
            held.setdefault(lang, []).append(text[at:])
            size += len(text) - at
            if size >= _SEGMENT:
                yield [(k, b"\n".join(v)) for k, v in held.items()]
                held, size = {}, 0
    yield [(k, b"\n".join(v)) for k, v in held.items()]


def _fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lang: str, salt: int) -> np.ndarray:
    """64-bit fingerprints of (language, word); never 0."""
    of_bytes = np.random.default_rng(salt).permutation(256).astype(np.uint8)
    h = spans(of_bytes[data], starts, ends)
    for i in np.flatnonzero(ends - starts >= _LONG_WORD).tolist():
        word = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8, salt=salt.to_bytes(8, "little"))
        h[i] = np.frombuffer(word.digest(), np.uint64)[0]
    own = np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8, salt=salt.to_bytes(8, "little")).digest(), np.uint64)
    h = mix(h ^ own[0])
    return np.where(h == 0, np.uint64(1), h)


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, start and end of each word, and whether the next word is in the same piece."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    kind = _KIND[data]
    edges = np.diff(np.concatenate(([True], kind > 0, [True])).view(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    cuts = np.flatnonzero(kind == 2)
    piece = np.searchsorted(cuts, starts)
    return data, starts, ends, np.append(piece[1:] == piece[:-1], False)[:len(starts)]


def vocabulary(texts: DataFrame, salt: int) -> DataFrame:
    """(lang, word, fp, n): every different word of (lang, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text in (own for segment in _segments(batches) for own in segment):
            data, starts, ends, _ = _words(text)
            if not len(starts):
                continue
            h = _fingerprints(data, starts, ends, lang, salt)
            check = _fingerprints(data, starts, ends, lang, salt + 1000)
            order = np.lexsort((check, h))
            new = np.concatenate(([True], (h[order][1:] != h[order][:-1]) | (check[order][1:] != check[order][:-1])))
            first = order[new]
            raw = data.tobytes()
            words = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(first)), pa.array(words, pa.binary()).cast(pa.string()),
                 pa.array(h[first].view(np.int64)), pa.array(np.diff(np.append(np.flatnonzero(new), len(h))))],
                names=["lang", "word", "fp", "n"])

    found = texts.mapInArrow(run, "lang string, word string, fp long, n long")
    return materialise(found.groupBy("lang", "word").agg(F.min("fp").alias("fp"), F.sum("n").alias("n")), "vocabulary")


# ------------------------------------------------------ suffix pointers --
def _route(fps: np.ndarray, words: np.ndarray, depth: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each pointer, by its first ``depth`` words."""
    key = np.zeros(len(words), np.uint64)
    for k in range(LONGEST):
        key = np.where(k < depth, mix(key + fps[words[:, k]] * _ODD), key)
    return ((key >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _runs(columns: list[np.ndarray]) -> np.ndarray:
    """Where the rows of sorted columns change."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


class Pointers:
    """Different suffix pointers: their words by number (0: the end), route depth and number.

    Words 1, 2, ... are those of ``common``, fingerprints in order that all
    tasks share; the numbers behind are places in ``rare``.
    """

    def __init__(self, common: np.ndarray, rare: np.ndarray, words: np.ndarray, depth: np.ndarray, n: np.ndarray):
        self.common, self.rare, self.words, self.depth, self.n = common, rare, words, depth, n

    @property
    def fps(self) -> np.ndarray:
        """Fingerprints by number."""
        return np.concatenate([np.zeros(1, np.uint64), self.common, self.rare])

    @staticmethod
    def numbers(common: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rare, number of each of ``fps``)."""
        found = np.searchsorted(common, fps)
        known = common[np.minimum(found, len(common) - 1)] == fps if len(common) else np.zeros(len(fps), bool)
        rare = distinct(fps[~known & (fps > 0)])
        at = np.where(known, found + 1, 1 + len(common) + np.searchsorted(rare, fps))
        return rare, np.where(fps > 0, at, 0).astype(np.int32)

    @classmethod
    def of(cls, common: np.ndarray, fps: np.ndarray, follows: np.ndarray, hot: np.ndarray) -> Pointers:
        """From the words of a text in order (0 where a word is left out)."""
        rare, at = cls.numbers(common, fps)
        words = np.zeros((len(fps), LONGEST), np.int32)
        words[:, 0] = at
        for k in range(1, LONGEST):
            words[:-1, k] = np.where(follows[:-1] & (words[:-1, k - 1] > 0), words[1:, k - 1], 0)
            words[words[:, k - 1] == 0, k] = 0
        words = words[words[:, 1] > 0]
        is_hot = np.isin(np.concatenate([np.zeros(1, np.uint64), common, rare]), hot)[words]
        depth = 2 + (is_hot[:, 0] & is_hot[:, 1]) + (is_hot[:, 0] & is_hot[:, 1] & is_hot[:, 2])
        return cls(common, rare, words, depth.astype(np.int8), np.ones(len(words), np.int64))

    @classmethod
    def merged(cls, parts: list[Pointers]) -> Pointers:
        common = parts[0].common
        rare = distinct(np.concatenate([p.rare for p in parts]))
        first = np.arange(1 + len(common), dtype=np.int32)
        words = [np.concatenate([first, (len(first) + np.searchsorted(rare, p.rare)).astype(np.int32)])[p.words]
                 for p in parts]
        return cls(common, rare, np.concatenate(words), np.concatenate([p.depth for p in parts]),
                   np.concatenate([p.n for p in parts]))

    def dealt(self, buckets: int, packets: int) -> Iterator[tuple[int, bytes]]:
        """(packet, payload): equal pointers together; packets are equal ranges of the buckets."""
        packet = _route(self.fps, self.words, self.depth, buckets) * packets // buckets
        known = 1 + len(self.common)
        a, b = (self.words[:, k].astype(np.int64) << 32 | self.words[:, k + 1] for k in (0, 2))
        order = np.lexsort((b, a, packet))
        first = _runs([packet[order], a[order], b[order]])
        n = np.add.reduceat(self.n[order], first) if len(first) else self.n[:0]
        at = order[first]
        words, depth, packet = self.words[at], self.depth[at], packet[at]
        cuts = np.append(_runs([packet]), len(packet)) if len(packet) else np.zeros(1, int)
        for lo, hi in zip(cuts.tolist(), cuts[1:].tolist()):
            own = words[lo:hi]
            used = distinct(own[own >= known])  # rare words travel with the packet
            own = np.where(own >= known, known + np.searchsorted(used, own), own)
            yield int(packet[lo]), ex.frame([
                ex.pack_sorted(self.rare[used - known]), *[ex.pack(ex.narrow(own[:, k])) for k in range(LONGEST)],
                ex.pack(depth[lo:hi]), ex.pack(ex.narrow(n[lo:hi]))])

    @classmethod
    def unpacked(cls, common: np.ndarray, payload: bytes) -> Pointers:
        rare, *columns, depth, n = ex.unframe(payload)
        words = np.stack([ex.unpack(c).astype(np.int32) for c in columns], 1)
        return cls(common, ex.unpack_sorted(rare), words, ex.unpack(depth), ex.unpack(n).astype(np.int64))


def quicksort(words: np.ndarray, n: np.ndarray, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(phrases, counts) of 2 to 4 words met at least ``least`` times, by a multikey three-way quicksort.

    ``words`` has a row of four places for each pointer, 0 behind its end.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = [(np.arange(len(words)), 0)]
    while held:
        at, depth = held.pop()
        if n[at].sum() < least:
            continue  # too few for any phrase
        if len(at) <= _SMALL:
            _sorted_out(words[at], n[at], depth, least, found)
            continue
        key = words[at, depth]
        pivot = np.sort(key[[len(at) // 4, len(at) // 2, 3 * len(at) // 4]])[1]
        held += [(at[key < pivot], depth), (at[key > pivot], depth)]
        equal = at[key == pivot]
        size = n[equal].sum()
        if pivot > 0 and size >= least:  # the equal partition: a phrase, and one word deeper
            if depth > 0:
                found.append((words[equal[:1], :depth + 1], np.array([size])))
            if depth + 1 < LONGEST:
                held.append((equal, depth + 1))
    return found


def _sorted_out(words: np.ndarray, n: np.ndarray, depth: int, least: int, found: list) -> None:
    """The same for a small partition whose pointers agree in the first ``depth`` words."""
    for k in range(depth, LONGEST):
        if not len(words):
            return
        order = np.lexsort([words[:, j] for j in range(k, depth - 1, -1)])
        words, n = words[order], n[order]
        first = _runs([words[:, j] for j in range(depth, k + 1)])
        sizes = np.add.reduceat(n, first)
        good = (sizes >= least) & (words[first, k] > 0)
        if k > 0 and good.any():
            found.append((words[first[good], :k + 1], sizes[good]))
        kept = np.repeat(good, np.diff(np.append(first, len(words))))  # the others are abandoned
        words, n = words[kept], n[kept]


def _counted(pointers: Pointers, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(phrases, counts, whether other buckets hold more of them)."""
    for depth in range(2, LONGEST + 1):
        own = pointers.depth == depth
        words, n = pointers.words[own], pointers.n[own]
        if not len(words):
            continue
        for phrases, counts in quicksort(words, n, least):
            if phrases.shape[1] >= depth:
                yield phrases, counts, False
        for k in range(2, depth):  # shorter than the route
            order = np.lexsort([words[:, j] for j in range(k - 1, -1, -1)])
            held = words[order, :k]
            first = _runs([held[:, j] for j in range(k)])
            yield held[first], np.add.reduceat(n[order], first), True


def phrase_counts(texts: DataFrame, words: DataFrame, salt: int, least: int = LEAST) -> DataFrame:
    """(w, n): fingerprints and occurrences of every phrase of 2 to 4 words with ``n`` at least ``least``."""
    spark = texts.sparkSession
    frequent = words.where(F.col("n") >= least)
    total = frequent.agg(F.sum("n")).first()[0] or 0
    buckets = max(ex.buckets(spark), -(-total // _BUCKET))
    packets = min(buckets, _COARSE)
    share = max(total // buckets, 1)
    hot = np.array([r.fp for r in frequent.where(F.col("n") > share).select("fp").collect()], np.int64).view(np.uint64)
    place = F.pmod("fp", F.lit(_FILTER_WORDS))
    bits = frequent.groupBy(place.alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(fp, 58) as int))")).alias("bits")).toArrow()
    known = np.zeros(_FILTER_WORDS, np.uint64)  # of fixed size
    known[np.asarray(bits.column("at"))] = np.asarray(bits.column("bits")).view(np.uint64)
    first = frequent.orderBy(F.desc("n"), "fp").limit(_COMMON).select("fp").collect()
    common = np.sort(np.array([r.fp for r in first], np.int64).view(np.uint64))
    held = spark.sparkContext.broadcast((known, hot, common))
    part = pa.schema([("bucket", pa.int32()), ("payload", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hot, common = held.value
        for segment in _segments(batches):
            fps, follows = [np.empty(0, np.uint64)], [np.empty(0, bool)]
            for lang, text in segment:
                data, starts, ends, same_piece = _words(text)
                if len(starts):
                    fps.append(_fingerprints(data, starts, ends, lang, salt))
                    follows.append(same_piece)
            fps, follows = np.concatenate(fps), np.concatenate(follows)
            kept = known[(fps & np.uint64(_FILTER_WORDS - 1)).astype(np.int64)] >> (fps >> np.uint64(58)) & np.uint64(1)
            fps[kept == 0] = 0
            for packet, payload in Pointers.of(common, fps, follows, hot).dealt(buckets, packets):
                yield pa.RecordBatch.from_arrays([pa.array([packet], pa.int32()), pa.array([payload], pa.binary())],
                                                 schema=part)

    def deal_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From packets to buckets, some millions of pointers at a time."""
        parts, rows = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            for bucket, payload in Pointers.merged(parts).dealt(buckets, buckets):
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([payload], pa.binary())],
                                                 schema=part)

        for batch in batches:
            for payload in batch.column(1):
                parts.append(Pointers.unpacked(held.value[2], payload.as_py()))
                rows += len(parts[-1].n)
                if rows >= 4 * _BUCKET:
                    yield from out()
                    parts, rows = [], 0
        if parts:
            yield from out()

    out_schema = pa.schema([("w", pa.list_(pa.int64())), ("n", pa.int64()), ("partial", pa.bool_())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in ex.groups(batches, (0,)):
            pointers = Pointers.merged([Pointers.unpacked(held.value[2], row[1]) for row in group])
            fps = pointers.fps
            for phrases, counts, partial in _counted(pointers, least):
                flat = fps[phrases].view(np.int64)
                offsets = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel())), pa.array(counts),
                     pa.array([partial] * len(counts))], schema=out_schema)

    def gathered(parts: DataFrame, n: int) -> DataFrame:
        return parts.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket")

    asked = texts.mapInArrow(ask, "bucket int, payload binary")
    if packets < buckets:
        asked = gathered(asked, packets).mapInArrow(deal_again, "bucket int, payload binary")
    counted = materialise(gathered(asked, buckets).mapInArrow(count, "w array<long>, n long, partial boolean"), "phrases")
    summed = counted.where("partial").groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return counted.where("NOT partial").select("w", "n").unionByName(summed)


# ------------------------------------------------------------ candidates --
def _exact(name: str):
    return F.col(name).cast("decimal(20,0)")


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """(w, a, score, l, r) of each phrase's lowest-scoring cut."""
    counts = materialise(phrases.unionByName(words.select(F.array("fp").alias("w"), "n")), "counts")
    cuts = phrases.select("w", F.col("n").alias("a"), F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k")) \
        .selectExpr("w", "a", "k", "slice(w, 1, k) AS head", "slice(w, k + 1, size(w) - k) AS rest")
    both = cuts.join(counts.select(F.col("w").alias("head"), F.col("n").alias("l")), "head") \
        .join(counts.select(F.col("w").alias("rest"), F.col("n").alias("r")), "rest")
    score = F.expr("(CAST(a AS DECIMAL(20,0)) * 2000000) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    best = both.select("w", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("w", "a") \
        .agg(F.min("cut").alias("cut"))
    return best.select("w", "a", "cut.score", "cut.l", "cut.r")


def without_parts(candidates: DataFrame, phrases: DataFrame, inside: int = INSIDE) -> DataFrame:
    """Candidates but those that nearly always occur inside one longer phrase."""
    pieces = F.expr("flatten(transform(sequence(2, size(w) - 1), "
                    "k -> transform(sequence(1, size(w) - k + 1), i -> slice(w, i, k))))")
    longest = phrases.where(F.size("w") > 2).select(F.explode(pieces).alias("w"), "n") \
        .groupBy("w").agg(F.max("n").alias("longer"))
    return candidates.join(longest, "w", "left") \
        .where(F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * inside)).drop("longer")


def mine(docs: DataFrame, top: int = 2000, least: int = LEAST, inside: int = INSIDE) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and
    those into words at spaces and tabs. ``a`` counts a phrase's occurrences
    inside pieces, ``n`` all words of the language, ``l`` and ``r`` the two parts
    of the cut with the lowest score floor(2000000 a / (l + r)), the first of
    equal ones. Phrases of which ``inside`` per cent lie in one longer phrase
    are left out. Ordered by score, a (descending) and phrase (bytewise).

    A null language counts as ``und``; null and empty texts hold no words;
    repeated rows count again; other columns are not read. An empty table, or
    one without phrases, gives an empty result.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    for salt in range(16):
        words = vocabulary(texts, salt)
        if words.groupBy("fp").count().where("count > 1").isEmpty():
            break  # no two words share a fingerprint
    else:
        raise RuntimeError("words share their fingerprints under every salt")
    frequent = words.where(F.col("n") >= least)
    phrases = materialise(phrase_counts(texts, words, salt, least), "frequent")
    kept = materialise(without_parts(scored(phrases, frequent), phrases, inside), "candidates")
    spelled = kept.select("w", F.posexplode("w").alias("at", "fp")).join(frequent.select("fp", "word", "lang"), "fp") \
        .groupBy("w").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"), F.min("lang").alias("lang"))
    named = kept.join(spelled, "w").select(
        "lang", F.concat_ws(" ", F.transform("words", lambda x: x["word"])).alias("phrase"), "a", "l", "r", "score")
    # the first of every share of a language's phrases, then the first of those
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    shares = named.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(_SHARES)))
    few = shares.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best))) \
        .where(F.col("rank") <= top).drop("share", "rank")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))) \
        .where(F.col("rank") <= top).join(totals, "lang") \
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
