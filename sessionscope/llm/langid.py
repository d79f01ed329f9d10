"""Language identification by interpolated Kneser-Ney character models.

One model per language over the letters of a text (lower-cased; every run of
other characters is one boundary). All languages share one sorted array of
n-gram hashes per order; next to it stand the interpolated log probabilities,
one column per language. The language with the lowest cross-entropy per symbol
wins; texts that no model explains are rejected by limits that a second,
disjoint sample of labelled texts calibrates.

The models are fitted on a bounded sample (``fit_docs`` and
``calibration_docs`` whole texts per language, the smallest by a hash of the
id; fewer texts are split in the same proportion, so every language rejects);
the prediction covers every text in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import carried, materialise, restored, rows

UNKNOWN = "und"
_BOUNDARY = 32
BROADCAST_ROWS = 100_000  # ids of sampled texts sent to every task; more are joined by a shuffle
FEW = 5  # calibration texts; a language with fewer takes the spread of all languages' texts
_PIECE = 1 << 18  # characters scored at once


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-case letter, or the boundary."""
    table = np.full(0x110000, _BOUNDARY, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            table[c] = ord(s.lower()[0])
    return table


def _symbols(text: str, order: int, after_letter: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The text's symbols behind order-1 boundaries, and which characters are letters."""
    points = _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    letter = points != _BOUNDARY
    keep = letter.copy()
    keep[:1] |= after_letter
    keep[1:] |= letter[:-1]  # the first boundary after each word
    return np.concatenate([np.full(order - 1, _BOUNDARY, np.uint32), points[keep]]), letter


def _windows(symbols: np.ndarray, order: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(symbols, order) if len(symbols) >= order else \
        np.empty((0, order), symbols.dtype)


def _hashes(grams: list[np.ndarray]) -> np.ndarray:
    """64-bit hashes of n-grams given symbol by symbol."""
    h = np.full(len(grams[0]), 0x243F6A8885A308D3, np.uint64)
    for s in grams:
        h = (h ^ s.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


@dataclass
class Models:
    """Log probabilities of all languages, by order, and rejection limits."""

    languages: list[str]
    order: int
    alphabet: np.ndarray  # sorted symbols; others are the unknown symbol 0
    keys: list[np.ndarray]  # [k]: sorted hashes of the grams of k + 1 symbols
    logp: list[np.ndarray]  # [k]: grams x languages
    contexts: list[np.ndarray]  # [k]: sorted hashes of the contexts of k symbols
    backoff: list[np.ndarray]  # [k]: contexts x languages, log weight of the lower order
    limits: np.ndarray | None = None  # languages x (mean, span to other languages, spread)

    def log_probabilities(self, symbols: np.ndarray) -> np.ndarray:
        """Of each symbol from position order-1 on, given those before it."""
        known = np.minimum(np.searchsorted(self.alphabet, symbols), len(self.alphabet) - 1)
        symbols = np.where(self.alphabet[known] == symbols, symbols, 0)
        n = len(symbols) - self.order + 1
        out = np.zeros((max(n, 0), len(self.languages)), np.float32)
        todo = np.arange(max(n, 0))
        for k in range(self.order - 1, -1, -1):
            last = todo + self.order - 1
            grams = [symbols[last - j] for j in range(k, -1, -1)]
            at, found = _lookup(self.keys[k], _hashes(grams))
            out[todo[found]] += self.logp[k][at[found]]
            todo = todo[~found]
            if not len(todo):
                break
            at, seen = _lookup(self.contexts[k], _hashes([g[~found] for g in grams[:-1]] if k else
                                                         [np.zeros(len(todo), np.uint32)]))
            out[todo[seen]] += self.backoff[k][at[seen]]
        return out

    def cross_entropies(self, text: str | None) -> tuple[np.ndarray, int]:
        """Nats per symbol under each language, and the number of symbols (0: no letter)."""
        if not text or not self.languages:
            return np.zeros(len(self.languages)), 0
        total, n, tail, lettered, after = np.zeros(len(self.languages)), 0, None, False, False
        for at in range(0, len(text), _PIECE):
            symbols, letter = _symbols(text[at:at + _PIECE], self.order, after)
            lettered, after = lettered or bool(letter.any()), bool(letter[-1])
            if tail is not None:
                symbols = np.concatenate([tail, symbols[self.order - 1:]])
            logp = self.log_probabilities(symbols)
            total += logp.sum(axis=0, dtype=np.float64)
            n += len(logp)
            tail = symbols[len(symbols) - self.order + 1:]
        return (-total / n, n) if lettered and n else (np.zeros(len(self.languages)), 0)


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _distinct(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(grams, axis=0, return_inverse=True, return_counts=True)


def build(counts: dict[str, dict[str, int]], order: int) -> Models:
    """Models from each language's counts of grams of ``order`` characters."""
    languages = sorted(counts)
    tables = {lang: (np.array([[ord(c) for c in g] for g in grams], np.uint32).reshape(-1, order),
                     np.array(list(grams.values()), np.float64)) for lang, grams in counts.items()}
    alphabet = np.unique(np.concatenate([[0], *(g.ravel() for g, _ in tables.values())])).astype(np.uint32)
    levels: list[dict[str, tuple[np.ndarray, np.ndarray]]] = [{} for _ in range(order)]
    for lang, (grams, n) in tables.items():
        levels[order - 1][lang] = grams, n
        for k in range(order - 2, -1, -1):  # continuation counts: different symbols in front
            grams, _, n = _distinct(grams[:, 1:])
            levels[k][lang] = grams, n.astype(np.float64)
    models = Models(languages, order, alphabet, [], [], [], [])
    lower, lower_keys = None, None
    for k in range(order):
        stacked = [levels[k][lang][0] for lang in languages]
        if k == 0:
            stacked.append(alphabet.reshape(-1, 1))
        union = _distinct(np.concatenate(stacked))[0]
        hashed = _hashes(list(union.T))
        contexts = _distinct(union[:, :-1])[0] if k else np.zeros((1, 1), np.uint32)
        context_hashes = _hashes(list(contexts.T))
        by_context = np.argsort(context_hashes)
        sorted_contexts = context_hashes[by_context]
        of_union = _lookup(sorted_contexts, _hashes(list(union[:, :-1].T)) if k else
                           np.broadcast_to(context_hashes, len(union)))[0]
        base = np.full((len(union), len(languages)), 1 / len(alphabet)) if lower is None else \
            np.exp(lower[_lookup(lower_keys, _hashes(list(union[:, 1:].T)))[0]])
        back = np.zeros((len(contexts), len(languages)), np.float64)
        p = np.empty_like(base)
        by_key = np.argsort(hashed)
        for j, lang in enumerate(languages):
            grams, n = levels[k][lang]
            at = by_key[_lookup(hashed[by_key], _hashes(list(grams.T)))[0]]
            ctx = of_union[at]
            ones, twos = (n == 1).sum(), (n == 2).sum()
            discount = np.clip(ones / max(ones + 2 * twos, 1), 0.1, 0.95)
            total = np.bincount(ctx, n, len(contexts))
            types = np.bincount(ctx, minlength=len(contexts))
            weight = np.where(total > 0, discount * types / np.maximum(total, 1), 1.0)
            back[:, j] = np.log(weight)
            p[:, j] = weight[of_union] * base[:, j]
            p[at, j] += (n - discount) / total[ctx]
        models.keys.append(hashed[by_key])
        models.logp.append(np.log(p)[by_key].astype(np.float32))
        models.contexts.append(sorted_contexts)
        models.backoff.append(back.astype(np.float32))
        lower, lower_keys = np.log(p)[by_key], hashed[by_key]
    return models


def _sample(docs: DataFrame, fit_docs: int, calibration_docs: int) -> DataFrame:
    """(lang, fit, text) of the labelled sample, split by share: a small language calibrates too."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    ranked = labelled.select("doc_id", "lang").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))) \
        .where(F.col("rank") <= fit_docs + calibration_docs)
    chosen = materialise(ranked.groupBy("doc_id", "lang").agg(F.min("rank").alias("rank")), "sample")
    own = Window.partitionBy("lang")  # of bounded size: the sampled ids
    fitted = F.greatest(F.floor(F.col("n") * fit_docs / (fit_docs + calibration_docs)), F.lit(1))
    split = chosen.withColumn("rank", F.row_number().over(own.orderBy("rank"))) \
        .withColumn("n", F.count("*").over(own)).select("doc_id", "lang", (F.col("rank") <= fitted).alias("fit"))
    if chosen.count() <= BROADCAST_ROWS:  # grows with the languages, not with the documents
        split = F.broadcast(split)
    return labelled.join(split, ["doc_id", "lang"]).select("lang", "fit", "text")


def _gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n)."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams, n = np.unique(_windows(_symbols(text, order)[0], order), axis=0, return_counts=True)
                data = np.ascontiguousarray(grams, "<u4").view(f"<U{order}").ravel()
                yield rows(schema, {"lang": [lang] * len(n), "gram": data.tolist(), "n": n})

    return texts.mapInArrow(run, "lang string, gram string, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, order: int = 4, fit_docs: int = 400, calibration_docs: int = 200) -> Models:
    """Models from the documents (doc_id, text, lang) that may be learned from."""
    sample = materialise(_sample(docs, fit_docs, calibration_docs), "langid")
    counts: dict[str, dict[str, int]] = {}
    for lang, gram, n in _gram_counts(sample.where("fit").select("lang", "text"), order).collect():
        counts.setdefault(lang, {})[gram] = n
    if not counts:
        none = np.zeros(0)
        return Models([], order, none, [], [], [], [])
    models = build(counts, order)
    tests = sample.where("not fit").select("lang", "text")
    names = models.languages
    scored = [(names.index(r.lang), np.array(r.entropies), r.n) for r in
              _entropies(tests, models).where("n > 0").collect() if r.lang in names]
    models.limits = _limits(len(names), scored, len(models.alphabet))
    return models


def _limits(languages: int, scored: list[tuple[int, np.ndarray, int]], alphabet: int) -> np.ndarray:
    """Mean, span and spread by language, from the calibration texts (language, entropies, symbols).

    Fewer than ``FEW`` own texts take the spread of all languages' texts;
    without any, the mean stands to other languages' texts as it does elsewhere.
    Where no language has a text to calibrate with, the limit is chance.
    """
    chance = np.log(alphabet)
    lang = np.array([j for j, _, _ in scored], np.int64)
    entropies = np.array([x for _, x, _ in scored], np.float64).reshape(-1, languages)
    sizes = np.array([n for _, _, n in scored], np.float64)
    if not len(lang):
        return np.array([[chance, 0.0, 0.0]] * languages)
    own = entropies[np.arange(len(lang)), lang]
    n = np.bincount(lang, minlength=languages)
    mean = np.bincount(lang, own * sizes, languages) / np.maximum(np.bincount(lang, sizes, languages), 1)
    other = np.array([entropies[lang != j, j].mean() if (lang != j).any() else chance for j in range(languages)])
    seen = n > 0
    mean = np.where(seen, mean, other * (mean[seen] / other[seen]).mean())
    squares = (own - mean[lang]) ** 2 * sizes
    spread = np.where(n < FEW, squares.mean(), np.bincount(lang, squares, languages) / np.maximum(n, 1))
    return np.stack([mean, other - mean, np.sqrt(spread)], 1)


def _entropies(texts: DataFrame, models: Models) -> DataFrame:
    """(lang, entropies, n) of labelled texts."""
    schema = pa.schema([("lang", pa.string()), ("entropies", pa.list_(pa.float64())), ("n", pa.int64())])
    held = texts.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [held.value.cross_entropies(t) for t in batch.column(1).to_pylist()]
            yield rows(schema, {"lang": batch.column(0), "entropies": [x.tolist() for x, _ in found],
                                "n": [n for _, n in found]})

    return texts.mapInArrow(run, "lang string, entropies array<double>, n long")


def decide(models: Models, text: str | None, reject_at: float, z: float) -> tuple[str, float, float, bool]:
    """(language, posterior, cross-entropy, rejected) of one text."""
    entropies, n = models.cross_entropies(text)
    if not n:
        return UNKNOWN, 0.0, 0.0, True
    best = int(np.argmin(entropies))
    score = 1 / np.exp(np.maximum((entropies[best] - entropies) * n, -700)).sum()
    mean, span, spread = models.limits[best]
    rejected = entropies[best] > mean + max(reject_at * span, z * spread / np.sqrt(n))
    return models.languages[best], float(score), float(entropies[best]), bool(rejected)


def identify(docs: DataFrame, models: Models, keep: list[str] | None = None,
             reject_at: float = 0.7, z: float = 6.0) -> DataFrame:
    """``docs`` with lang_pred, score, cross_entropy and rejected.

    lang_pred is the language with the lowest cross-entropy, "und" for a null
    text, one without letters, or when no model was learned; score is that
    language's posterior (0 for "und"). ``rejected``: "und", or a cross-entropy
    beyond the language's limit: the share ``reject_at`` of the way from its own
    texts' mean to other languages' texts, or ``z`` spreads at this length.
    The columns ``keep`` of ``docs`` are returned (all of them by default), but
    for those named like an added one. An empty table gives an empty result.
    """
    added = "lang_pred string, score double, cross_entropy double, rejected boolean"
    names = ["lang_pred", "score", "cross_entropy", "rejected"]
    columns = [c for c in keep or docs.columns if c not in names]
    read, kept, own = carried(docs, columns)
    held = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(zip(*(decide(held.value, x.as_py(), reject_at, z) for x in batch.column(own)))) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(columns)], pa.array(found[0], pa.string()), pa.array(found[1], pa.float64()),
                 pa.array(found[2], pa.float64()), pa.array(found[3], pa.bool_())],
                names=[*batch.schema.names[:len(columns)], *names])

    return restored(read.mapInArrow(run, ", ".join([*kept, added])), columns, names)
