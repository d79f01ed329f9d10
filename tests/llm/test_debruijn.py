import hashlib
import random
import re

import pytest

from sessionscope.llm import debruijn, tokens
from sessionscope.llm.queries import op8_debruijn

from .conftest import SF001


def brute(pairs, k):
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in pairs]
    first = {}
    for d, w in split:
        for i in range(len(w) - k + 1):
            at = (d is None, d or 0, i)
            key = tuple(w[i:i + k])
            first[key] = min(first.get(key, at), at)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i:i + k])] < (d is None, d or 0, i):
                gone |= set(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def test_query_equals_brute_force(spark):
    pairs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(pairs, 20)
    assert collected(op8_debruijn(spark, SF001)) == want
    assert sum(r[2] for r in want) > 0


@pytest.mark.parametrize("chunk_bytes", [200, 1 << 20])
def test_small_chunks_and_windows(documents, chunk_bytes):
    rng = random.Random(3)
    pairs = [(d, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))) for d in range(30)]
    pairs += [(40, None), (41, ""), (42, pairs[3][1]), (3, pairs[3][1]), (None, pairs[5][1]), (None, "q " * 900)]
    docs = documents(pairs, "'x' as n_words").withColumn("chunk", debruijn.F.lit(1))
    assert collected(debruijn.paths(docs, 5, chunk_bytes)) == brute(pairs, 5)
    assert collected(debruijn.paths(docs, 12, chunk_bytes)) == brute(pairs, 12)


def test_empty_table(documents):
    assert collected(debruijn.paths(documents([]))) == []


def test_paths_name_their_source(documents):
    shared = " ".join(f"w{i}" for i in range(12))
    rows = debruijn.paths(documents([(1, f"a b {shared} c"), (2, f"{shared} d e")]), 6).orderBy("doc_id").collect()
    assert rows[0].path_starts == []
    assert (rows[1].path_starts, rows[1].path_words, rows[1].source_ids, rows[1].source_starts) == \
        ([0], [12], [1], [2])


def test_words_longer_than_a_piece(monkeypatch):
    text = b"alpha " + b"x" * 50 + b" beta\ngamma " + b"y" * 21 + b" alpha"
    whole = tokens.words(text)
    monkeypatch.setattr(tokens, "PIECE", 10)
    pieces = tokens.words(text)
    for a, b in zip(whole, pieces):
        assert a.tolist() == b.tolist()
    assert whole[0][0] == whole[0][-1] and len(set(whole[0].tolist())) == 5
