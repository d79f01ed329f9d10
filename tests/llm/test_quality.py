import re
from collections import Counter

import numpy as np
import pytest

from sessionscope.llm import quality
from sessionscope.llm.queries import op7_quality

from .conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    """The base counts by their definition."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    repeat = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            repeat |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(repeat), failed)


def divergence(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]

    def kl(a):
        return sum(x * np.log2(x / y) for x, y in zip(a, m) if x > 0)
    return ((kl(p) + kl(q)) / 2) ** .5


def char_class(c):
    if c in " \t\r\x0b\x0c":
        return quality.SPACE
    if c == "\n":
        return quality.LINE
    if ord(c) >= 128:
        return quality.OTHER
    if c.islower():
        return quality.LOWER
    if c.isupper():
        return quality.UPPER
    if c.isdigit():
        return quality.DIGIT
    if c in ".,;:!?'\"-()":
        return quality.POINT
    return quality.CONTROL if ord(c) < 32 or ord(c) == 127 else quality.SYMBOL


def distances(docs):
    """(class, word) distances of labelled documents, from dictionaries."""
    classes, words = {}, {}

    def lowered(t):
        return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(t or "")]
    for _, t, lang in docs:
        classes.setdefault(lang, Counter()).update(map(char_class, t or ""))
        words.setdefault(lang, Counter()).update(lowered(t))
    out = {}
    for d, t, lang in docs:
        c = Counter(map(char_class, t or ""))
        n, total = max(sum(c.values()), 1), max(sum(classes[lang].values()), 1)
        by_class = divergence([c[k] / n for k in range(9)], [classes[lang][k] / total for k in range(9)])
        ranked = sorted(words[lang].values(), reverse=True)
        cut = ranked[quality.COMMON_WORDS - 1] if len(ranked) >= quality.COMMON_WORDS else 0
        clear = len(ranked) <= quality.COMMON_WORDS or ranked[quality.COMMON_WORDS] < cut
        common = [w for w, v in words[lang].items() if v >= max(cut, 1)] if clear else None
        out[d] = by_class, None
        if common is not None:
            w = Counter(lowered(t))
            m, total = max(sum(w.values()), 1), max(sum(words[lang].values()), 1)
            p = [w[x] / m for x in common]
            q = [words[lang][x] / total for x in common]
            out[d] = by_class, divergence([*p, (1 - sum(p)) if w else 0], [*q, 1 - sum(q)])
    return out


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang").collect()]
    got = {r.doc_id: r for r in op7_quality(spark, SF001).collect()}
    want = distances(docs)
    assert len(got) == len(docs)
    for d, t, _ in docs:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counts(t)
        assert r.class_distance == pytest.approx(want[d][0], abs=1e-6)
        if want[d][1] is not None:
            assert r.word_distance == pytest.approx(want[d][1], abs=1e-6)
        assert not (r.base_failed and r.kept)


def test_keeps_good_documents_and_drops_strange_ones(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/../sf0.01/labels.parquet").collect()}
    got = [r for r in op7_quality(spark, f"{SF001}/../sf0.01").collect() if r.doc_id in labels and not r.base_failed]
    good = [r.kept for r in got if labels[r.doc_id] == 1]
    bad = [r.kept for r in got if labels[r.doc_id] == 0]
    assert all(good) and sum(bad) <= 0.2 * len(bad)


def test_edge_cases(documents):
    rows = [(1, None, "en", "s"), (2, "", None, "s"), (3, " \n\n \x85", "en", "s"),
            (4, "one two three one two three " * 2000, "en", "s"), (5, "ñ é\nñ é\n\nñ é \n" * 3, "xx", "s"),
            (5, "ñ é\nñ é\n\nñ é \n" * 3, "xx", "s"), (None, " ".join(f"w{i}" for i in range(80)), None, "s"),
            (8, "#$% <b>|&*" * 30, "en", None)]
    docs = documents(rows, "'clash' as kept").withColumn("n_words", quality.F.lit(-1))
    got = quality.judge(docs).collect()
    assert sorted(((r.doc_id, *tuple(r)[1:7]) for r in got), key=str) == \
        sorted(((r[0], *counts(r[1])) for r in rows), key=str)
    assert quality.judge(documents([])).count() == 0
    unlabelled = quality.judge(documents([(1, " ".join(f"w{i}" for i in range(80)))])).first()
    assert unlabelled.kept and unlabelled.class_distance == 0


def test_any_number_of_languages(spark, documents):
    """300 languages, one of them with a third of the documents, and documents of none."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(900):
        lang = f"l{i % 300}" if i % 3 else "l0"
        words = [f"{'abcdefghij'[int(lang[1:]) % 10]}{k}" for k in rng.integers(0, 40, 60 + i % 50)]
        rows.append((i, " ".join(words) + "." * (i % 7), None if i % 50 == 1 else lang, "s"))
    docs = documents(rows)
    key = lambda r: r.doc_id
    want = sorted(quality.judge(docs, together=10_000).collect(), key=key)
    for together in (256, 40):
        assert sorted(quality.judge(docs, together=together).collect(), key=key) == want
    labelled = [r for r in rows if r[2] is not None]
    near = distances([r[:3] for r in labelled])
    for r in want:
        if r.doc_id in near:
            assert r.class_distance == pytest.approx(near[r.doc_id][0], abs=1e-6)
            if near[r.doc_id][1] is not None:
                assert r.word_distance == pytest.approx(near[r.doc_id][1], abs=1e-6)
    assert len({r.kept for r in want}) == 2 or all(r.kept for r in want)
