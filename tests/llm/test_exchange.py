"""The helpers shared by the operators: packing of arrays, chunks, components."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sessionscope.llm import exchange as ex
from sessionscope.llm import repeats
from sessionscope.llm.components import connected_components
from sessionscope.llm.tokens import distinct, places, word_windows, words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=60))
def test_packed_arrays_come_back(values):
    array = np.sort(np.array(values, np.uint64))
    assert ex.unpack_sorted(ex.pack_sorted(array)).tolist() == array.tolist()
    assert ex.unpack(ex.pack(array)).tolist() == array.tolist()
    assert ex.unpack(ex.pack(ex.narrow(array))).tolist() == array.tolist()
    assert distinct(array[::-1]).tolist() == sorted(set(values))
    cuts = ex.split(array, 7)
    assert cuts[0] == 0 and cuts[-1] == len(array) and (np.diff(cuts) >= 0).all()
    if len(array):
        wanted = np.array(random.Random(1).choices(values, k=20), np.uint64)
        known = distinct(array)
        assert known[places(known, wanted)].tolist() == wanted.tolist()


@given(st.lists(st.binary(max_size=9), max_size=9))
def test_framed_blobs_come_back(blobs):
    assert ex.unframe(ex.frame(blobs)) == blobs


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b\x1c\x85é", max_size=60))
def test_words_are_runs_between_ascii_white_space(text):
    data = text.encode()
    hashes, starts, ends = words(data)
    assert [data[s:e] for s, e in zip(starts, ends)] == data.split()
    by_word = {}
    for h, w in zip(hashes.tolist(), data.split()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    windows = word_windows(hashes, 2).tolist()
    pairs = list(zip(data.split(), data.split()[1:]))
    assert len(windows) == len(pairs) and len(set(windows)) == len(set(pairs))


def test_repeats_are_counted_over_chunks():
    rng = random.Random(2)
    chunks = [[rng.randrange(40) * 10**17 for _ in range(rng.randint(0, 30))] for _ in range(5)]
    count = Counter(x for c in chunks for x in c)
    for n in (1, 4):
        asked: dict[int, list] = {}
        own = []
        for c in chunks:
            hashes, times = np.unique(np.array(c, np.uint64), return_counts=True)
            own.append(hashes)
            for bucket, payload in repeats.questions(hashes, n, [(times > 1).astype(np.uint8)]):
                asked.setdefault(bucket, []).append((len(own) - 1, payload))
        answers: dict[int, dict[int, bytes]] = {i: {} for i in range(len(chunks))}
        for bucket, rows in asked.items():
            for (i, _), answer in zip(rows, repeats.repeated([p for _, p in rows])):
                answers[i][bucket] = answer
        for i, hashes in enumerate(own):
            flags = repeats.bits([answers[i][b] for b in sorted(answers[i])], hashes, n)
            assert flags[:, 0].tolist() == [count[h] > 1 for h in hashes.tolist()]


def test_chunks_hold_every_document_once(spark, documents):
    docs = documents([(i, "x" * (i * 7 % 50)) for i in range(60)] + [(99, "y" * 500), (100, None)])
    chunks = ex.chunked(docs.select("doc_id", "text", F.pmod("doc_id", F.lit(2)).cast("int").alias("kind")), 100, "kind")
    held, kinds = [], []
    for r in chunks.collect():
        content = ex.documents(bytes(r.payload))
        assert sum(map(len, content["text"])) <= 100 or len(content["text"]) == 1
        assert {d % 2 for d in content["doc_id"]} == {r.kind}
        held += list(zip(content["doc_id"], content["text"]))
        kinds.append(r.kind)
    assert sorted(held) == sorted((r.doc_id, (r.text or "").encode()) for r in docs.collect())
    assert len({r.chunk for r in chunks.collect()}) == len(kinds)


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(25)]
    edges += [(200, 201 + i) for i in range(30)] + [(7, 7), (None, 3), (5, None)]
    label = {v: v for e in edges for v in e if None not in e and e[0] != e[1]}
    for _ in label:
        for a, b in edges:
            if a in label and b in label and a is not None and b is not None:
                label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in
           connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == label
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
