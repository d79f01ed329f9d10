import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from sessionscope.llm import packing
from sessionscope.llm.queries import op4_pattern_packing, vocabulary

from .conftest import SF01


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary())


def pieces_of(tokenizer, pairs, capacity):
    out = []
    for d, t in pairs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for i, at in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[at:at + capacity], "<u4")
            out.append((d, i, at, len(own), zlib.crc32(own.tobytes())))
    return sorted(out, key=str)


def checked(rows, capacity):
    """Sequences are gapless from 0 and not too long; returns how many there are."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_query_packs_every_piece(spark, tokenizer):
    pairs = [tuple(r) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()]
    rows = op4_pattern_packing(spark, SF01).collect()
    want = pieces_of(tokenizer, pairs, 2048)
    assert sorted((tuple(r)[:5] for r in rows), key=str) == want
    total = sum(w[3] for w in want)
    assert checked(rows, 2048) <= -(-total // 2048) * 1.01 + 1


WORDS = ["the", "THE", "don't", "we're", "I'll've", "''s", "'same", "x'd'", "'", "a'b", "12'34", "ÉTÉ", "straße", "ñandú",
         "é", "日本", "İ", "ΣΑΣ", "a b", "…", "#$%", "3.14", "b--c", "²", "🎉", "<|endoftext|>", "\x1c", "\x00",
         "w" * 300]


@pytest.mark.parametrize("seed", range(3))
def test_word_table_gives_the_tokenizers_ids(tokenizer, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(WORDS) + rng.choice(["", " ", "\n", "  \t"]) for _ in range(rng.randint(0, 12)))
             for _ in range(300)]
    texts += ["".join(rng.choice("ab'stl rve12.é\n") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    encoder = packing.Encoder(vocabulary())
    assert encoder.by_word
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in encoder(texts)] == want
    assert encoder([]) == [] and encoder(["", " "])[0].tolist() == []


def test_groups_of_texts_do_not_matter(monkeypatch):
    encoder = packing.Encoder(vocabulary())
    texts = [f"some words {i} and others" * (i % 7) for i in range(50)]
    whole = [x.tolist() for x in encoder(texts)]
    monkeypatch.setattr(packing, "_GROUP", 40)
    assert [x.tolist() for x in encoder(texts)] == whole


def test_edge_cases(spark, tokenizer, documents):
    pairs = [(1, None), (2, ""), (3, "a " * 100), (3, "a " * 100), (None, "b c d"), (6, "word " * 5000), (7, "x" * 40000)]
    docs = documents(pairs, "1 as length").withColumn("offset", packing.F.lit("clash"))
    for capacity in (16, 2048):
        rows = packing.pack(docs, vocabulary(), capacity, ids=True).collect()
        assert sorted((tuple(r)[:5] for r in rows), key=str) == pieces_of(tokenizer, pairs, capacity)
        assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
        checked(rows, capacity)
    assert packing.pack(documents([]), vocabulary()).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = 64
    histogram = np.zeros(capacity + 1, np.int64)
    n = rng.integers(1, 3000)
    np.add.at(histogram, np.clip(rng.geometric(.05, n) if seed % 2 else rng.integers(1, 65, n), 1, capacity), 1)
    table, sequences = packing.plan(histogram, capacity)
    taken, load = Counter(), Counter()
    for length, lo, times, first, offset in sorted(table.tolist(), key=lambda r: r[4]):
        assert taken[length] is not None
        for i in range(times):
            assert load[first + i] == offset
            load[first + i] += length
    for length, lo, times, _, _ in table.tolist():
        assert lo == taken[length]
        taken[length] += times
    assert all(taken[k] == histogram[k] for k in range(capacity + 1))
    assert max(load.values()) <= capacity and len(load) == sequences
    total = int((histogram * np.arange(capacity + 1)).sum())
    best_fit = sum(t for _, t in packing._best_fit(histogram.copy(), capacity))
    assert sequences <= max(best_fit + 2, -(-total // capacity) + 2)


def test_least_squares_finds_an_exact_fit():
    slots = packing.patterns(np.array([10, 20, 30, 40]), 60)
    assert {tuple(sorted(s)) for s in slots.tolist()} == {(0, 20, 40), (0, 30, 30), (10, 10, 40), (10, 20, 30), (20, 20, 20)}
    wanted = np.zeros(61)
    wanted[[10, 20, 30, 40]] = 50, 70, 90, 30
    x = packing.nonnegative_least_squares(slots, wanted, 3000)
    used = np.bincount(slots[slots > 0], np.repeat(x, (slots > 0).sum(axis=1)), 61)
    assert np.allclose(used, wanted, atol=.5) and (x >= 0).all()


def test_added_tokens_are_single_ids_as_in_the_unmodified_tokenizer(documents):
    plain = Tokenizer.from_file(vocabulary())
    parts = ["one", "Two", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "<|", "|>", "é", "日",
             "don't", "endoftext", "12"]
    rng = random.Random(5)
    texts = ["one <|endoftext|> two", "<|startoftext|>", "a<|endoftext|><|startoftext|>b", "x <|endoftext |> y"]
    texts += ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(1, 9))) for _ in range(300)]
    encoder = packing.Encoder(vocabulary())
    assert encoder(texts)[0].tolist() == [637, 49407, 1237]
    assert [x.tolist() for x in encoder(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    pairs = list(enumerate(texts[:20]))
    rows = packing.pack(documents(pairs), vocabulary(), 16).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == pieces_of(plain, pairs, 16)
