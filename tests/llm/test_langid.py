import math
import random
from collections import Counter

import numpy as np
import pytest

from sessionscope.llm import langid
from sessionscope.llm.queries import op5_language_id

from .conftest import SF01


def counts_of(text, order):
    grams = langid._windows(langid._symbols(text, order)[0], order)
    return dict(Counter("".join(map(chr, g)) for g in grams.tolist()))


def brute(counts, alphabet, order, gram):
    """Interpolated Kneser-Ney by its definition, for one language."""
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])

    def p(k, g):
        if k == 0:
            return 1 / alphabet
        n = levels[k]
        ones, twos = (sum(v == x for v in n.values()) for x in (1, 2))
        d = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.95)
        follow = {h: v for h, v in n.items() if h[:-1] == g[:-1]}
        total = sum(follow.values())
        if not total:
            return p(k - 1, g[1:])
        return max(n.get(g, 0) - d, 0) / total + d * len(follow) / total * p(k - 1, g[1:])
    return p(order, gram)


def test_probabilities_equal_the_definition():
    texts = {"a": "the cat sat on the mat then the rat", "b": "der hund und die katze und der bär"}
    counts = {k: counts_of(v, 3) for k, v in texts.items()}
    models = langid.build(counts, 3)
    probe = "the bät und zz"
    symbols, _ = langid._symbols(probe, 3)
    got = models.log_probabilities(symbols)
    known = set(models.alphabet.tolist())
    for i, gram in enumerate(langid._windows(symbols, 3).tolist()):
        gram = "".join(chr(c) if c in known else "\0" for c in gram)
        for j, lang in enumerate(models.languages):
            assert math.isclose(got[i, j], math.log(brute(counts[lang], len(models.alphabet), 3, gram)), abs_tol=1e-4)


def test_pieces_do_not_change_the_entropy(monkeypatch):
    models = langid.build({"a": counts_of("abc abd " * 50, 4), "b": counts_of("xyz xyw " * 50, 4)}, 4)
    text = "abc 12 xyz; " * 300
    whole = models.cross_entropies(text)
    monkeypatch.setattr(langid, "_PIECE", 7)
    pieces = models.cross_entropies(text)
    assert whole[1] == pieces[1] and np.allclose(whole[0], pieces[0], atol=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    out = op5_language_id(spark, SF01)
    got = {r.doc_id: r for r in out.collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(got) == len(lang)
    held = [d for d, r in got.items() if r.held_out]
    assert held and sum(got[d].lang_pred == lang[d] for d in held) >= 0.95 * len(held)
    assert sum(r.rejected for r in got.values()) <= 0.01 * len(got)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_edge_cases(spark, documents):
    fit_on = documents([(i, t, lang, None) for lang, t in
                        (("en", "the dog runs over the hill and the fox sees it"),
                         ("de", "der hund läuft über den hügel und der fuchs sieht es")) for i in range(20)])
    fit_on = fit_on.selectExpr("monotonically_increasing_id() doc_id", "text", "lang")
    models = langid.fit(fit_on, fit_docs=10, calibration_docs=5)
    docs = documents([(1, None), (2, ""), (3, "123 !?"), (None, "the dog"), (5, "der hund"), (5, "der hund"),
                      (6, "der fuchs " * 50000), (7, "ЖЖЖЖ ЩЩЩЩ ЪЪЪЪ " * 40)], "'x' as score")
    got = [(r.doc_id, r.lang_pred, r.rejected) for r in langid.identify(docs, models).collect()]
    assert got[:6] == [(1, "und", True), (2, "und", True), (3, "und", True), (None, "en", False),
                       (5, "de", False), (5, "de", False)]
    assert got[6][1] == "de" and got[7][2]
    assert langid.identify(documents([]), models).count() == 0


def test_nothing_to_learn_from(documents):
    models = langid.fit(documents([(1, "text", None, None), (2, None, "en", None)]))
    got = langid.identify(documents([(1, "text")]), models).first()
    assert (got.lang_pred, got.score, got.rejected) == ("und", 0.0, True)


def sentences(words, seed, n):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(40)) for _ in range(n)]


EN = "the dog runs over hill and fox sees it while rain falls from grey clouds onto old stone houses near river".split()
DE = "der hund läuft über den hügel und fuchs sieht es während regen aus grauen wolken auf alte häuser fällt".split()
JUNK = ["zqxj vkqz " * 30, "ЖЩЪ ЪЩЖ " * 30, "qqqq xxxx jjjj " * 20]


@pytest.mark.parametrize("en,de", [(10, 10), (1000, 1000), (1000, 20), (1000, 2), (1000, 1), (1, 1)])
def test_junk_is_rejected_at_any_size(spark, en, de):
    labelled = [("en", t) for t in sentences(EN, 1, en)] + [("de", t) for t in sentences(DE, 2, de)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(labelled)],
                                 "doc_id long, text string, lang string")
    models = langid.fit(docs)
    assert np.isfinite(models.limits).all()
    got = [langid.decide(models, t, 0.7, 6.0) for t in (sentences(EN, 3, 1) + sentences(DE, 4, 1) + JUNK)]
    assert [g[0] for g in got[:2]] == ["en", "de"]
    assert [g[3] for g in got] == [False, False, True, True, True]


def test_every_language_of_a_small_input_calibrates(spark):
    models = langid.fit(spark.read.parquet(f"{SF01}/documents.parquet"))
    assert len(models.languages) > 1 and (models.limits[:, 1] < np.inf).all() and (models.limits[:, 2] > 0).all()


def test_any_column_names(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("doc_id < 60")
    named = docs.selectExpr("*", "1 as `a.b`", "'x' as lang_pred", "map('k', doc_id) as `c``d`", "text as `kept 0`")
    models = langid.fit(docs)
    got = {r.doc_id: r for r in langid.identify(named, models).collect()}
    want = {r.doc_id: r for r in langid.identify(docs, models, keep=["doc_id"]).collect()}
    assert all((got[d].lang_pred, got[d].score, got[d]["a.b"]) == (r.lang_pred, r.score, 1) for d, r in want.items())
    assert got.keys() == want.keys() and all(r["c`d"] == {"k": d} and r.text == r["kept 0"] for d, r in got.items())
