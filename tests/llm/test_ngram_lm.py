import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionscope.llm import ngram_lm
from sessionscope.llm.ngram_lm import HELD, LEARN, SCORE
from sessionscope.llm.queries import op1_lm_score

from .conftest import SF001

END = None


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), END]


def brute(pairs, part, rounds):
    """Counts in dictionaries, expectation-maximisation event by event."""
    split = [(part(d), tokens(t)) for d, t in pairs]

    def count(parts):
        uni, bi = Counter(), Counter()
        for p, w in split:
            if p in parts:
                uni.update(w)
                bi.update(zip([END, *w], w))
        return uni, bi

    def bucket(c):
        return min(c.bit_length(), ngram_lm.BUCKETS - 1)

    def estimates(uni, bi, total, types, h, w):
        return [1 / (types + 1), uni[w] / max(total, 1), bi[h, w] / max(uni[h], 1)]

    uni, bi = count({LEARN})
    total, types = sum(uni.values()), len(uni)
    weights = {b: [1 / 3] * 3 if b else [.5, .5, 0.] for b in range(ngram_lm.BUCKETS)}
    for _ in range(rounds):
        sums = {b: [0.] * 3 for b in weights}
        for p, w in split:
            if p == HELD:
                for h, x in zip([END, *w], w):
                    share = [a * b for a, b in zip(weights[bucket(uni[h])], estimates(uni, bi, total, types, h, x))]
                    for k in range(3):
                        sums[bucket(uni[h])][k] += share[k] / sum(share)
        weights = {b: [x / sum(s) for x in s] if sum(s) else weights[b] for b, s in sums.items()}
    for b, s in weights.items():
        s = [max(s[0], 1e-6), max(s[1], 1e-6), s[2]]
        weights[b] = [x / sum(s) for x in s]
    uni, bi = count({LEARN, HELD})
    total, types = sum(uni.values()), len(uni)
    out = []
    for (d, _), (p, w) in zip(pairs, split):
        out.append((d, len(w), sum(uni[x] > 0 for x in w), total,
                    sum(math.log10((uni[x] + 1) / (total + types + 1)) for x in w),
                    sum(math.log10(sum(a * b for a, b in zip(weights[bucket(uni[h])],
                                                             estimates(uni, bi, total, types, h, x))))
                        for h, x in zip([END, *w], w))))
    return sorted(out, key=str)


def same(got, want):
    got = sorted((tuple(r) for r in got), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:6] for g in got], [w[4:] for w in want], rtol=1e-9)


COLUMNS = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_query_equals_brute_force(spark):
    pairs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    out = op1_lm_score(spark, SF001)

    def part(d):
        return {2: SCORE, 6: HELD}.get(zlib.crc32(str(d).encode()) % 7, LEARN)
    same(out.select(COLUMNS).collect(), brute(pairs, part, ngram_lm.ROUNDS))
    assert {r.doc_id for r in out.where("held_out").collect()} == {d for d, _ in pairs if part(d) == SCORE}
    # word pairs explain held-out text better than words alone
    held = out.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


@pytest.mark.parametrize("chunk_bytes", [60, 1 << 20])
def test_edge_cases(documents, chunk_bytes):
    pairs = [(0, "the Cat sat"), (1, "the cat ran"), (2, None), (3, ""), (4, "the dog sat ñandú"), (5, "x"),
             (5, "x"), (7, "the cat " * 400), (8, "zebra cat"), (None, "the cat")]

    def part(d):
        return SCORE if d is None or d % 3 == 2 else HELD if d % 3 == 1 else LEARN
    docs = documents(pairs, "'x' as score").withColumn("part", F.lit("clash"))
    at = F.coalesce(F.pmod("doc_id", F.lit(3)), F.lit(2))
    got = ngram_lm.score(docs, F.when(at == 2, SCORE).when(at == 1, HELD).otherwise(LEARN), 4, chunk_bytes)
    same(got.select(COLUMNS).collect(), brute(pairs, part, 4))


def test_empty_table_and_no_training_text(documents):
    assert ngram_lm.score(documents([]), F.lit(LEARN), 2).count() == 0
    got = ngram_lm.score(documents([(1, "a b")]), F.lit(SCORE), 2).first()
    assert (got.n_tokens, got.n_known, got.train_tokens) == (3, 0, 0)
    assert math.isfinite(got.score)


def test_unseen_words_and_ends_equal_the_definition(documents):
    train = [(0, "a b c a b"), (3, "b c a"), (1, "a b a c")]
    probes = [(2 + 3 * i, f"a {w}") for i, w in enumerate(["a", "b", "c", "unseen"])] + [(29, "a")]
    at = F.pmod("doc_id", F.lit(3))
    part = F.when(at == 2, SCORE).when(at == 1, HELD).otherwise(LEARN)
    got = ngram_lm.score(documents(train + probes), part, 3)
    same(got.select(COLUMNS).collect(), brute(train + probes, lambda d: {2: SCORE, 1: HELD}.get(d % 3, LEARN), 3))
