"""A deleted-interpolation language model, and the score of every text.

P(w | h) = l2(b) c(h w) / c(h) + l1(b) c(w) / N + l0(b) / (V + 1): maximum-
likelihood estimates of two orders and a uniform share for unseen words, mixed
by weights that depend on the bucket b of the context's frequency c(h). The
weights come from expectation-maximisation: the training documents are split,
the n-grams of one part (``held``) are held out, and the estimates that explain
them are counted on the other part only. The final model keeps the weights and
counts all training documents.

Counts are joined with the texts through ``exchange``: a chunk asks about the
distinct words and word pairs it contains, sends its training counts along,
and gets back the counts over the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import exchange as ex
from .common import materialise, rows
from .tokens import joined, mix, words

BUCKETS = 24  # contexts seen 0, 1, 2-3, 4-7, ... times
_END = np.uint64(0x0E0D_0E0D_0E0D_0E0D)  # the token behind each text, and before the first
ROUNDS = 12

LEARN, HELD, SCORE = 0, 1, 2  # a document's part


class _Chunk:
    """The tokens of a chunk's documents: words and one end each, in order."""

    def __init__(self, docs: dict):
        self.ids, self.parts = docs["doc_id"], np.array(docs["part"], np.int64)
        data, starts = joined([t.lower() for t in docs["text"]])
        h, begin, _ = words(data)
        doc = np.searchsorted(starts, begin, "right") - 1
        size = np.bincount(doc, minlength=len(starts)) + 1 if len(starts) else np.empty(0, np.int64)
        self.ends = np.cumsum(size)
        self.tokens = np.full(int(size.sum()), _END, np.uint64)
        is_word = np.ones(len(self.tokens), bool)
        is_word[self.ends - 1] = False
        self.tokens[is_word] = h
        self.doc = np.repeat(np.arange(len(starts)), size)
        before = np.full(len(self.tokens), _END, np.uint64)
        before[1:] = self.tokens[:-1]  # a document's first token follows an end
        self.words, self.word_at = np.unique(self.tokens, return_inverse=True)
        pairs = mix(self.tokens * np.uint64(0x9E3779B97F4A7C15) + before)
        self.pairs, self.pair_at = np.unique(pairs, return_inverse=True)
        self.before_at = np.searchsorted(self.words, before)

    def counts(self, at: np.ndarray, size: int) -> list[np.ndarray]:
        """Occurrences of each distinct n-gram in the parts that learn."""
        part = self.parts[self.doc]
        return [np.bincount(at[part == p], minlength=size) for p in (LEARN, HELD)]


def _questions(hashes: np.ndarray, counts: list[np.ndarray], n: int, order: int) -> Iterator[tuple[int, bytes]]:
    cuts = ex.split(hashes, n)
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        own = slice(cuts[b], cuts[b + 1])
        yield 2 * b + order, ex.frame([ex.pack_sorted(hashes[own]), *(ex.pack(ex.narrow(c[own])) for c in counts)])


def _totals(questions: list[bytes]) -> list[bytes]:
    """Counts over all chunks of each asked n-gram: those that learn, and those held out.

    One more entry sums the bucket up: its tokens (learn, held out) and types (learn, either).
    """
    parts = [ex.unframe(q) for q in questions]
    hashes = [ex.unpack_sorted(p[0]) for p in parts]
    known, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    totals = [np.bincount(inverse, np.concatenate([ex.unpack(p[i]) for p in parts]), len(known)).astype(np.int64)
              for i in (1, 2)]
    out, done = [], 0
    for h in hashes:
        at = inverse[done:done + len(h)]
        out.append(ex.frame([ex.pack(ex.narrow(t[at])) for t in totals]))
        done += len(h)
    learn, held = totals
    summary = np.array([learn.sum(), held.sum(), (learn > 0).sum(), (learn + held > 0).sum()], np.int64)
    return [*out, ex.pack(summary)]


def _sums(totals: DataFrame) -> list[int]:
    """The corpus's tokens (learn, held out) and types (learn, either): one row per bucket of words."""
    parts = totals.where((F.col("chunk") == ex.SUMMARY) & (F.col("bucket") % 2 == 0)).select("payload").collect()
    return np.sum([ex.unpack(r.payload) for r in parts], axis=0).tolist() if parts else [0] * 4


def _received(chunk: _Chunk, found: list[bytes], n: int) -> list[list[np.ndarray]]:
    """[words, pairs] x [learn, held] totals of a chunk's distinct n-grams."""
    sizes = [np.count_nonzero(np.diff(ex.split(h, n))) for h in (chunk.words, chunk.pairs)]
    by_order: list[list[list[bytes]]] = [[], []]
    filled = [np.flatnonzero(np.diff(ex.split(h, n))) * 2 + order
              for order, h in enumerate((chunk.words, chunk.pairs))]
    order_of = np.argsort(np.concatenate(filled), kind="stable")
    assert len(order_of) == len(found) == sum(sizes)
    for blob, i in zip(found, order_of):
        by_order[int(i >= sizes[0])].append(ex.unframe(blob))
    return [[np.concatenate([ex.unpack(p[i]).astype(np.int64) for p in parts]) if parts else np.empty(0, np.int64)
             for i in (0, 1)] for parts in by_order]


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else 1 + the logarithm of the count to base 2."""
    return np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)


def _estimates(pair: np.ndarray, context: np.ndarray, word: np.ndarray, total: int, types: int) -> np.ndarray:
    """Each order's probability: rows 0 (uniform), 1 (words), 2 (pairs)."""
    return np.stack([np.full(len(pair), 1 / (types + 1)), word / max(total, 1), pair / np.maximum(context, 1)])


def _weights(events: DataFrame, total: int, types: int, rounds: int) -> np.ndarray:
    """Mixture weights by bucket, by expectation-maximisation on the held-out events.

    ``events`` holds arrays of counts (pair, context, word) and how often each
    occurs held out. A round sums, for every bucket, the share of the events
    that each order explains; the sums are ``BUCKETS`` rows.
    """
    weights = np.full((3, BUCKETS), 1 / 3)
    weights[:, 0] = 0.5, 0.5, 0.0  # an unseen context says nothing
    schema = pa.schema([("bucket", pa.int32()), ("order", pa.int32()), ("share", pa.float64())])
    for _ in range(rounds):
        now = weights

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((3, BUCKETS))
            for batch in batches:
                for blob in batch.column(0):
                    pair, context, word, times = (ex.unpack(p).astype(np.float64) for p in ex.unframe(blob.as_py()))
                    bucket = _bucket(context)
                    share = now[:, bucket] * _estimates(pair, context, word, total, types)
                    share *= times / share.sum(axis=0)
                    for k in range(3):
                        sums[k] += np.bincount(bucket, share[k], BUCKETS)
            yield rows(schema, {"bucket": np.tile(np.arange(BUCKETS), 3), "order": np.repeat(np.arange(3), BUCKETS),
                                "share": sums.ravel()})

        sums = np.zeros((3, BUCKETS))
        for r in events.mapInArrow(expect, "bucket int, order int, share double") \
                .groupBy("bucket", "order").agg(F.sum("share").alias("share")).collect():
            sums[r.order, r.bucket] = r.share
        seen = sums.sum(axis=0)
        weights = np.where(seen > 0, sums / np.where(seen > 0, seen, 1), weights)
    # every word keeps a probability, whatever was held out
    floor = np.array([[1e-6], [1e-6], [0]])
    weights = np.maximum(weights, floor)
    return weights / weights.sum(axis=0)


def score(docs: DataFrame, part: Column, rounds: int = ROUNDS, chunk_bytes: int = ex.CHUNK_BYTES) -> DataFrame:
    """Score the texts of ``docs`` under a model of its own documents.

    ``part`` says of each document whether it is counted (LEARN), counted and
    held out while the weights are learned (HELD), or only scored (SCORE).
    Returns doc_id, part, n_tokens (words and one end), n_known (tokens seen in
    training), train_tokens, train_types, base_score (add-one unigram log10)
    and score (log10 probability of the text's tokens). Null texts are empty;
    texts are read whole; repeated rows count as often as they occur. An empty
    table gives an empty result; without training text all weight is uniform.
    """
    n = ex.buckets(docs.sparkSession)
    read = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), part.cast("int").alias("part"))
    chunks = ex.chunked(read, chunk_bytes, kind="part")

    def question(content: dict) -> Iterator[tuple[int, bytes]]:
        chunk = _Chunk(content)
        yield from _questions(chunk.words, chunk.counts(chunk.word_at, len(chunk.words)), n, 0)
        yield from _questions(chunk.pairs, chunk.counts(chunk.pair_at, len(chunk.pairs)), n, 1)

    asked = ex.ask(chunks, question)
    totals = materialise(ex.answer(asked, 2 * n, _totals), "counts", "uncompressed")
    n_learn, n_held, v_learn, v_all = _sums(totals)

    def held_events(_: int, content: dict, found: list[bytes]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(content)
        (word, _), (pair, _) = _received(chunk, found, n)
        events = np.stack([pair[chunk.pair_at], word[chunk.before_at], word[chunk.word_at]])
        events, times = np.unique(events, axis=1, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([ex.frame([ex.pack(ex.narrow(x)) for x in (*events, times)])])], names=["events"])

    held = chunks.where(F.col("kind") == HELD)
    events = materialise(ex.gather(held, totals.join(held.select("chunk"), "chunk", "left_semi"), n, held_events,
                                   "events binary"), "events", "uncompressed")
    weights = _weights(events, n_learn, v_learn, rounds)
    total, distinct = n_learn + n_held, v_all
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("train_types", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def finish(_: int, content: dict, found: list[bytes]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(content)
        word, pair = (a + b for a, b in _received(chunk, found, n))
        own, context = word[chunk.word_at], word[chunk.before_at]
        p = (weights[:, _bucket(context)] * _estimates(pair[chunk.pair_at], context, own, total, distinct)).sum(axis=0)
        base = np.log10((own + 1) / (total + distinct + 1))
        size = len(chunk.ids)
        yield rows(schema, {
            "doc_id": chunk.ids, "part": chunk.parts, "n_tokens": np.bincount(chunk.doc, minlength=size),
            "n_known": np.bincount(chunk.doc, own > 0, size).astype(np.int64), "train_tokens": np.full(size, total),
            "train_types": np.full(size, distinct), "base_score": np.bincount(chunk.doc, base, size),
            "score": np.bincount(chunk.doc, np.log10(p), size)})

    return ex.gather(chunks, totals, n, finish,
                     "doc_id long, part int, n_tokens long, n_known long, train_tokens long, train_types long, "
                     "base_score double, score double")
