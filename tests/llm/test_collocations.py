import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionscope.llm import collocations as co
from sessionscope.llm.queries import op13_collocations

from .conftest import SF01

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, top=2000):
    n, counts = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {q[i:i + k] for q, b in candidates.items() for k in range(2, len(q)) for i in range(len(q) - k + 1)
                  if 100 * b >= 80 * f[q[i:i + k]]}
        found = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((lang, " ".join(p), a, f[p[:k]], f[p[k:]], n[lang], score))
        found.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i, *r[1:]) for i, r in enumerate(found[:top], start=1)]
    return sorted(out)


def got(docs, **kw):
    return sorted(tuple(r) for r in co.mine(docs, **kw).collect())


def test_query_equals_brute_force(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    want = brute(rows)
    assert want and sorted(tuple(r) for r in op13_collocations(spark, SF01).collect()) == want


def test_null_languages_a_small_threshold_and_a_small_top(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("doc_id < 200") \
        .withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang"))) \
        .withColumns({"w": F.lit(1), "n": F.lit(2), "rank": F.lit("x"), "fp": F.lit(None)})
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert got(docs, least=4, top=50) == brute(rows, least=4, top=50)
    assert got(docs, least=4, top=10 ** 6) == brute(rows, least=4, top=10 ** 6)


def test_hot_words_are_routed_deeper_and_in_two_steps(spark, documents):
    texts = ["the cat the cat the mat " * 50, "the the the the the", None, "", "A b\tc. a B c, a b c\nA B C", "été a b"]
    docs = documents([(i, t, "en", None) for i, t in enumerate(texts * 8)])
    rows = [(r.lang, r.text) for r in docs.collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 300):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert got(docs, least=8) == brute(rows, least=8)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_long_texts_and_long_words(documents):
    long = "x" * 400
    docs = documents([(1, f"{long} {long[:-1]}y end. " * 40, "en", None), (2, "w " * 1_500_000, "en", None),
                      (3, ". ".join(["alpha beta gamma"] * 500_000), "en", None)])
    found = {r[2]: r[3] for r in got(docs)}
    assert found == {f"{long} {long[:-1]}y end": 40, "w w w w": 1_499_997, "alpha beta gamma": 500_000}


def test_empty_tables_and_tables_without_phrases(documents):
    assert got(documents([]).where("false")) == [] and got(documents([(1, None), (2, ""), (3, "a b c")])) == []


@pytest.mark.parametrize("seed", range(6))
def test_quicksort_counts_every_prefix(seed):
    rng = np.random.default_rng(seed)
    words = rng.integers(0, (3, 40, 400)[seed % 3], (30_000, 4)).astype(np.int32)
    for k in range(1, 4):
        words[words[:, k - 1] == 0, k] = 0
    words = words[words[:, 0] > 0]
    n = rng.integers(1, 4, len(words))
    want = Counter()
    for row, weight in zip(words.tolist(), n.tolist()):
        for k in range(2, 5):
            if row[k - 1] > 0:
                want[tuple(row[:k])] += weight
    found = Counter()
    for phrases, counts in co.quicksort(words, n, 5):
        for p, c in zip(phrases.tolist(), counts.tolist()):
            assert tuple(p) not in found
            found[tuple(p)] = c
    assert found == {p: c for p, c in want.items() if c >= 5}


def test_shared_fingerprints_lead_to_another_salt(spark, documents, monkeypatch):
    real, asked = co.vocabulary, []

    def vocabulary(texts, salt):
        asked.append(salt)
        words = real(texts, salt)
        return words.withColumn("fp", F.lit(1).cast("long")) if salt < 2 else words

    monkeypatch.setattr(co, "vocabulary", vocabulary)
    docs = documents([(1, "a b. " * 40, "en", None)])
    assert [r[2] for r in got(docs)] == ["a b"] and asked == [0, 1, 2]
