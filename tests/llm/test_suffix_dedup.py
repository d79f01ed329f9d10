import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sessionscope.llm import suffix_dedup
from sessionscope.llm.queries import op6_suffix_dedup

from .conftest import SF001


def brute(pairs, length):
    texts = [(d, (t or "").encode()) for d, t in pairs]
    count = Counter(t[i:i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
                   .collect()), key=str)


def test_query_equals_brute_force(spark):
    pairs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(pairs, 200)
    assert collected(op6_suffix_dedup(spark, SF001)) == want
    assert sum(r[2] for r in want) > 0


def made(seed):
    """Texts that share, repeat and nearly repeat parts of one another."""
    rng = random.Random(seed)

    def text(n, letters="abcdé "):
        return "".join(rng.choice(letters) for _ in range(n))
    base = text(700)
    pairs = [(d, text(rng.randint(0, 200))) for d in range(10)]
    for d in range(10, 40):
        s = rng.randint(0, 600)
        part = base[s:s + rng.randint(5, 400)]
        if rng.random() < .5 and part:
            i = rng.randrange(len(part))
            part = part[:i] + "#" + part[i + 1:]
        pairs.append((d, text(rng.randint(0, 60)) + part + text(rng.randint(0, 60))))
    return pairs + [(50, base), (51, base), (51, base), (52, "z" * 500), (53, "xy" * 60 + "é" * 90), (54, None),
                    (55, ""), (None, base[:300]), (56, "\n".join(["a line of text"] * 20))]


@pytest.mark.parametrize("chunk_bytes,piece", [(300, 1 << 21), (1 << 20, 1 << 21), (1 << 20, 150)])
def test_equals_brute_force_in_any_chunks(documents, monkeypatch, chunk_bytes, piece):
    # pieces are cut in the tasks: run them in this process
    pairs = made(chunk_bytes + piece)
    docs = documents(pairs, "'x' as kept").withColumn("chunk", suffix_dedup.F.lit(1))
    if piece == 1 << 21:
        for length in (20, 60):
            assert collected(suffix_dedup.remove_repeats(docs, length, chunk_bytes)) == brute(pairs, length)
        return
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    texts = [(t or "").encode() for _, t in pairs]
    whole = [x for p in suffix_dedup._pieces(texts, 60) for x in p.windows(np.flatnonzero(p.valid)).tolist()]
    monkeypatch.setattr(suffix_dedup, "PIECE", 1 << 20)
    joint = [x for p in suffix_dedup._pieces(texts, 60) for x in p.windows(np.flatnonzero(p.valid)).tolist()]
    assert whole == joint
    assert len(whole) == sum(max(len(t) - 59, 0) for t in texts)


def test_empty_table(documents):
    assert collected(suffix_dedup.remove_repeats(documents([]))) == []


def test_factors_equal_their_definition():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 6, 40)
    positions = rng.permutation(40)
    order = np.lexsort((positions, keys))
    earlier, later = suffix_dedup.factors(order, np.diff(keys[order]) == 0, positions)
    for i in range(40):
        same = positions[keys == keys[i]]
        assert earlier[i] == (same < positions[i]).any() and later[i] == (same > positions[i]).any()
