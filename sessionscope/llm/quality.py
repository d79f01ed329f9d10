"""Quality rules: plain counts, and divergence from a language's usual text.

References are taken from all documents: per language the histogram of
character classes and the frequencies of its most common words (exact: every
word is counted, by hash bucket). A document is compared with its language's
reference by Jensen-Shannon distance (square root of the divergence, base 2);
short documents are spared the comparisons that need more text. Documents of
no language are compared with the nearest reference.

Every language has a reference. Up to ``MAX_LANGUAGES`` of them are broadcast;
beyond, languages are dealt to parts of about that many, a part's references
travel in front of its documents, and documents of no language pass the parts
one after another. The verdicts are the same either way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import exchange as ex
from .common import materialise, rows, text_bytes
from .tokens import joined, word_windows, words

COMMON_WORDS = 200  # per language
MAX_LANGUAGES = 256  # broadcast together; more are met in parts
SYMBOLS = b"#*$%&|<>"
_GROUP = 1 << 20  # bytes of text handled at once (a longer text alone)

# character classes, by a character's first byte
LOWER, UPPER, DIGIT, SPACE, LINE, POINT, SYMBOL, CONTROL, OTHER, _INNER = range(10)
CLASSES = 9


def _classes() -> np.ndarray:
    table = np.full(256, OTHER)
    table[:0x20] = table[0x7F] = CONTROL
    table[0x21:0x7F] = SYMBOL
    table[[*b" \t\r\x0b\x0c"]] = SPACE
    table[ord("\n")] = LINE
    table[ord("a"):ord("z") + 1] = LOWER
    table[ord("A"):ord("Z") + 1] = UPPER
    table[ord("0"):ord("9") + 1] = DIGIT
    table[[*b".,;:!?'\"-()"]] = POINT
    table[0x80:0xC0] = _INNER  # continues a character
    return table


_CLASS = _classes()
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def _sums(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, values, n).astype(np.int64)


class _Group:
    """Some texts' bytes, words and character classes."""

    def __init__(self, texts: list[bytes]):
        self.n = len(texts)
        data, self.begin = joined(texts)
        self.bytes = np.frombuffer(data, np.uint8)
        self.hashes, self.start, self.end = words(data)
        self.doc = np.searchsorted(self.begin, self.start, "right") - 1
        # joining lower-cased texts keeps every byte's place
        self.lower = words(data.lower())[0]
        kinds = _CLASS[self.bytes]
        owner = np.searchsorted(self.begin, np.arange(len(self.bytes)), "right") - 1
        joint = np.zeros(len(self.bytes), bool)
        joint[self.begin[1:] - 1] = True  # line ends between texts
        seen = (kinds != _INNER) & ~joint
        self.classes = np.bincount(owner[seen] * CLASSES + kinds[seen], minlength=self.n * CLASSES) \
            .reshape(self.n, CLASSES)
        self.symbols = _sums(_IS_SYMBOL[self.bytes], owner, self.n)
        first = np.concatenate(([0], np.cumsum(kinds != _INNER)))  # characters begun before a byte
        self.word_chars = _sums(first[self.end] - first[self.start], self.doc, self.n)
        self.n_words = np.bincount(self.doc, minlength=self.n)

    def repeated_words(self, size: int = 3) -> np.ndarray:
        """Words in windows of ``size`` that the text holds twice or more."""
        windows = word_windows(self.hashes, size)
        inside = self.doc[:len(windows)] == self.doc[size - 1:] if len(windows) else np.empty(0, bool)
        at = np.flatnonzero(inside)
        order = at[np.lexsort((windows[at], self.doc[at]))]
        same = (windows[order][1:] == windows[order][:-1]) & (self.doc[order][1:] == self.doc[order][:-1])
        again = np.zeros(len(self.hashes) + 1, bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        covered = again.copy()
        for k in range(1, size):
            covered[k:] |= again[:-k]
        return _sums(covered[:-1], self.doc, self.n)


def _groups(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of bounded size, and where each begins."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > _GROUP:
            yield lo, texts[lo:i]
            lo, size = i, 0
        size += len(t)
    if texts[lo:]:
        yield lo, texts[lo:]


def _repeated_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            n += line in seen
            seen.add(line)
    return n


@dataclass
class References:
    """By language: class shares, sorted hashes of common words and their shares (the last: all others)."""

    languages: dict[str, int]
    classes: np.ndarray
    words: list[np.ndarray]
    shares: list[np.ndarray]


def reference_rows(docs: DataFrame, common_words: int = COMMON_WORDS) -> DataFrame:
    """(lang, sums, words) of every language: character classes, words and documents, and its most common words."""
    n = ex.buckets(docs.sparkSession)
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("payload", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), list(text_bytes(batch.column(1)))
            for lang in set(langs.tolist()):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                classes, seen, times = np.zeros(CLASSES, np.int64), [], []
                for _, part in _groups(own):
                    group = _Group(part)
                    classes += group.classes.sum(axis=0)
                    h, c = np.unique(group.lower, return_counts=True)
                    seen.append(h)
                    times.append(c)
                h, at = np.unique(np.concatenate(seen), return_inverse=True)
                c = np.bincount(at, np.concatenate(times), len(h)).astype(np.int64)
                cuts = ex.split(h, n)
                out = [(-1, ex.pack(np.append(classes, [c.sum(), len(own)])))]
                out += [(b, ex.frame([ex.pack_sorted(h[cuts[b]:cuts[b + 1]]), ex.pack(ex.narrow(c[cuts[b]:cuts[b + 1]]))]))
                        for b in np.flatnonzero(np.diff(cuts)).tolist()]
                yield rows(schema, {"lang": [lang] * len(out), "bucket": [b for b, _ in out],
                                    "payload": [p for _, p in out]})

    counted = docs.where(F.col("lang").isNotNull()).select(F.col("lang").cast("string"), F.col("text").cast("string")) \
        .mapInArrow(count, "lang string, bucket int, payload binary")
    total_schema = pa.schema([("lang", pa.string()), ("word", pa.int64()), ("n", pa.int64()), ("rank", pa.int32())])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, lang), group in ex.groups(batches, (1, 0)):
            if bucket < 0:  # class counts, words, documents
                sums = np.sum([ex.unpack(row[2]) for row in group], axis=0)
                yield rows(total_schema, {"lang": [lang] * len(sums), "word": range(len(sums)), "n": sums,
                                          "rank": [-1] * len(sums)})
                continue
            parts = [ex.unframe(row[2]) for row in group]
            h, at = np.unique(np.concatenate([ex.unpack_sorted(p[0]) for p in parts]), return_inverse=True)
            c = np.bincount(at, np.concatenate([ex.unpack(p[1]) for p in parts]), len(h)).astype(np.int64)
            top = np.lexsort((h.view(np.int64), -c))[:common_words]  # the overall ones are among them
            yield rows(total_schema, {"lang": [lang] * len(top), "word": h.view(np.int64)[top], "n": c[top],
                                      "rank": [0] * len(top)})

    totals = materialise(counted.repartition(n, "bucket", "lang").sortWithinPartitions("bucket", "lang")
                         .mapInArrow(total, "lang string, word long, n long, rank int"), "references")
    place = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = totals.where(F.col("rank") == 0).withColumn("rank", F.row_number().over(place)) \
        .where(F.col("rank") <= common_words).groupBy("lang").agg(F.collect_list(F.struct("word", "n")).alias("words"))
    sums = totals.where(F.col("rank") == -1).groupBy("lang", "word").agg(F.sum("n").alias("n")) \
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("word", "n"))).alias("sums"))  # CLASSES + 2 entries
    return sums.join(top, "lang", "left").select("lang", F.transform("sums", lambda x: x["n"]).alias("sums"), "words")


def collected(found: list) -> References:
    """The references of some rows of ``reference_rows``, by language."""
    found = sorted(found, key=lambda r: r["lang"].encode())
    out = References({}, np.zeros((len(found), CLASSES)), [], [])
    for i, r in enumerate(found):
        out.languages[r["lang"]] = i
        classes = np.array(r["sums"][:CLASSES], np.float64)
        out.classes[i] = classes / max(classes.sum(), 1)
        h = np.array([w["word"] for w in r["words"] or []], np.int64).view(np.uint64)
        c = np.array([w["n"] for w in r["words"] or []], np.float64)
        order = np.argsort(h)
        total_words = max(r["sums"][CLASSES], 1)
        out.words.append(h[order])
        out.shares.append(np.append(c[order], total_words - c.sum()) / total_words)
    return out


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of ``p`` from ``q`` (0 to 1)."""
    m = (p + q) / 2

    def kl(a: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0).sum(axis=-1)
    return np.sqrt(np.clip((kl(p) + kl(np.broadcast_to(q, p.shape))) / 2, 0, 1))


def _distances(group: _Group, at: np.ndarray, refs: References, lang: int) -> tuple[np.ndarray, np.ndarray]:
    """Class and word distances of the documents ``at`` from a language."""
    classes = group.classes[at] / np.maximum(group.classes[at].sum(axis=1, keepdims=True), 1)
    known = refs.words[lang]
    size = len(known) + 1
    place = np.minimum(np.searchsorted(known, group.lower), max(len(known) - 1, 0))
    place = np.where(known[place] == group.lower, place, len(known)) if len(known) else np.zeros(len(group.lower), int)
    row = np.full(group.n, -1)
    row[at] = np.arange(len(at))
    own = row[group.doc] >= 0
    counts = np.bincount(row[group.doc[own]] * size + place[own], minlength=len(at) * size).reshape(len(at), size)
    return (js_distance(classes, refs.classes[lang]),
            js_distance(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1), refs.shares[lang]))


_VERDICT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
    ("class_distance", pa.float64()), ("word_distance", pa.float64()), ("kept", pa.bool_())])
_VERDICT_TYPE = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                 "base_failed boolean, class_distance double, word_distance double, kept boolean")


@dataclass
class Limits:
    max_class_distance: float
    max_word_distance: float
    slack: float
    min_chars: int
    min_words: int

    def verdicts(self, ids: list, texts: list[bytes], group: _Group, by_class: np.ndarray,
                 by_word: np.ndarray) -> pa.RecordBatch:
        repeats = group.repeated_words()
        failed = (group.n_words < 50) | (100 * repeats > 50 * group.n_words)
        strange = (by_class > self.max_class_distance) & (group.classes.sum(axis=1) >= self.min_chars)
        far = self.max_word_distance + self.slack / np.sqrt(np.maximum(group.n_words, 1))
        strange |= (by_word > far) & (group.n_words >= self.min_words)
        return rows(_VERDICT, {
            "doc_id": ids, "n_words": group.n_words, "word_chars": group.word_chars,
            "n_symbols": group.symbols, "n_dup_lines": [_repeated_lines(t) for t in texts],
            "n_repeat_words": repeats, "base_failed": failed, "class_distance": by_class,
            "word_distance": by_word, "kept": ~failed & ~strange})


def _nearest(group: _Group, at: np.ndarray, refs: References) -> tuple[np.ndarray, np.ndarray]:
    """The least distances of the documents ``at`` from any of the references."""
    every = [_distances(group, at, refs, lang) for lang in range(len(refs.classes))]
    return np.min([c for c, _ in every], axis=0), np.min([w for _, w in every], axis=0)


def _measured(group: _Group, langs: list, refs: References) -> tuple[np.ndarray, np.ndarray]:
    """Distances of every document of a group from its language's reference, or from the nearest."""
    own = np.array([refs.languages.get(x, -1) for x in langs])
    by_class, by_word = np.zeros(group.n), np.zeros(group.n)
    for lang in np.unique(own[own >= 0]).tolist():
        at = np.flatnonzero(own == lang)
        by_class[at], by_word[at] = _distances(group, at, refs, lang)
    none = np.flatnonzero(own < 0)
    if len(none) and len(refs.classes):
        by_class[none], by_word[none] = _nearest(group, none, refs)
    return by_class, by_word


def _together(read: DataFrame, found: References, limits: Limits) -> DataFrame:
    """Verdicts with all references broadcast."""
    held = read.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, texts in _groups(list(text_bytes(batch.column(2)))):
                group = _Group(texts)
                by_class, by_word = _measured(group, langs[lo:lo + group.n], held.value)
                yield limits.verdicts(ids[lo:lo + group.n], texts, group, by_class, by_word)

    return read.mapInArrow(run, _VERDICT_TYPE)


_SALTS = 16  # tasks that may share a part's documents, as one language may hold most of them


def _by_parts(read: DataFrame, references: DataFrame, parts: int, limits: Limits) -> DataFrame:
    """Verdicts with the languages dealt to ``parts``; no task holds the references of more than one."""
    of_lang = F.pmod(F.xxhash64("lang"), F.lit(parts)).cast("int").alias("part")
    blob = references.groupBy(of_lang).agg(F.collect_list(F.struct("lang", "sums", "words")).alias("refs"))
    kind = blob.schema["refs"].dataType.simpleString()
    salted = blob.select("part", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"),
                         *[F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "long"), ("lang", "string"),
                                                                    ("text", "string"))], "refs")
    with_lang = read.where("lang IS NOT NULL").select(
        of_lang, F.pmod(F.xxhash64("doc_id", F.substring("text", 1, 100)), F.lit(_SALTS)).cast("int").alias("salt"),
        "doc_id", "lang", "text", F.lit(None).cast(kind).alias("refs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = None
        for batch in batches:
            is_refs = np.asarray(batch.column(5).is_valid())
            at = 0
            for end in [*np.flatnonzero(is_refs).tolist(), batch.num_rows]:
                own = batch.slice(at, end - at)
                if own.num_rows:
                    ids, langs = own.column(2).to_pylist(), own.column(3).to_pylist()
                    for lo, texts in _groups(list(text_bytes(own.column(4)))):
                        group = _Group(texts)
                        by_class, by_word = _measured(group, langs[lo:lo + group.n], refs)
                        yield limits.verdicts(ids[lo:lo + group.n], texts, group, by_class, by_word)
                if end < batch.num_rows:
                    refs = collected(batch.column(5)[end].as_py())
                at = end + 1

    # a part's references sort in front of its documents
    listed = salted.unionByName(with_lang).repartition("part", "salt") \
        .sortWithinPartitions("part", "salt", F.col("refs").isNull()).mapInArrow(run, _VERDICT_TYPE)

    # documents of no language pass all references, some at a time, keeping the least distances
    passed = read.where("lang IS NULL").select("doc_id", "text", F.lit(float("inf")).alias("by_class"),
                                               F.lit(float("inf")).alias("by_word"))
    spark = read.sparkSession
    out = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("by_class", pa.float64()), ("by_word", pa.float64())])
    for part in range(parts if not passed.isEmpty() else 0):
        held = spark.sparkContext.broadcast(collected(references.where(of_lang == part).collect()))

        def least(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, by_class, by_word = (batch.column(i).to_pylist() for i in (0, 2, 3))
                for lo, texts in _groups(list(text_bytes(batch.column(1)))):
                    group, upto = _Group(texts), lo + len(texts)
                    c, w = np.array(by_class[lo:upto]), np.array(by_word[lo:upto])
                    if held.value.languages:
                        found = _nearest(group, np.arange(group.n), held.value)
                        c, w = np.minimum(c, found[0]), np.minimum(w, found[1])
                    yield rows(out, {"doc_id": ids[lo:upto], "text": pa.array(texts, pa.binary()).cast(pa.string()),
                                     "by_class": c, "by_word": w})

        passed = materialise(passed.mapInArrow(least, "doc_id long, text string, by_class double, by_word double"),
                             "unlabelled")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, by_class, by_word = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for lo, texts in _groups(list(text_bytes(batch.column(1)))):
                upto = lo + len(texts)
                yield limits.verdicts(ids[lo:upto], texts, _Group(texts), np.array(by_class[lo:upto]),
                                      np.array(by_word[lo:upto]))

    return listed.unionByName(passed.mapInArrow(finish, _VERDICT_TYPE))


def judge(docs: DataFrame, max_class_distance: float = 0.3, max_word_distance: float = 0.38, slack: float = 1.3,
          min_chars: int = 200, min_words: int = 50, together: int = MAX_LANGUAGES) -> DataFrame:
    """Counts and the verdict for every document.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed (fewer than 50 words, or over half of them in
    repeated windows of three), class_distance, word_distance, kept. ``kept``:
    not base_failed, class_distance at most ``max_class_distance`` (judged from
    ``min_chars`` characters on) and word_distance at most ``max_word_distance``
    plus ``slack`` / sqrt(n_words), as a sample of few words lies further off
    (from ``min_words`` words on). ``together`` bounds the languages whose
    references a task holds; results do not depend on it. A null text has no
    words and fails. Without any labelled language no distance is taken (0).
    Repeated rows are judged alike; other columns are not read; an empty table
    gives an empty result.
    """
    limits = Limits(max_class_distance, max_word_distance, slack, min_chars, min_words)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text"))
    references = materialise(reference_rows(docs), "languages")
    n = references.count()
    if n <= together:
        return _together(read, collected(references.collect()), limits)
    return _by_parts(read, references, -(-n // together), limits)
