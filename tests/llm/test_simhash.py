import numpy as np
import pytest

from sessionscope.llm import simhash
from sessionscope.llm.queries import op9_simhash

from .conftest import SF001


def brute(pairs, distance=3):
    """Reference: bit votes one by one, union of all pairs."""
    import re

    import xxhash
    fps = []
    for _, text in pairs:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(
            c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        grams = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 0))] or \
            ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    label = list(range(len(pairs)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    values = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= distance):
            a, b = root(i), root(int(j))
            label[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(root(i), []).append(pairs[i][0])
    return sorted(((pairs[i][0], f"{fps[i]:016x}", min((d for d in groups[root(i)] if d is not None), default=None))
                   for i in range(len(fps))), key=str)


def collected(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert collected(op9_simhash(spark, SF001)) == brute(pairs)


def test_edge_cases(documents):
    pairs = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "two words"), (6, "two words"),
             (None, "two words"), (8, "a b c " * 5000), (9, "\x85 \xa0x ñ"), (None, "alone here")]
    docs = documents(pairs, "'clash' as fingerprint").withColumn("component_id", simhash.F.lit(0))
    assert collected(simhash.near_duplicates(docs)) == brute(pairs)


def test_empty_table(documents):
    assert collected(simhash.near_duplicates(documents([]))) == []


@pytest.mark.parametrize("hot", [1, 4, 64])
def test_crowded_keys_link_like_all_pairs(spark, hot):
    """Many close fingerprints share keys: refined groups give the same components."""
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 4)
    values = {int(c) for c in centres}
    for c in centres:
        for _ in range(60):
            v = int(c)
            for b in rng.integers(0, 63, rng.integers(1, 6)):
                v ^= 1 << int(b)
            values.add(v)
    values = sorted(values)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    found = simhash.connected_components(simhash.near_pairs(fps, hot=hot))
    got = dict(tuple(r) for r in found.collect())
    array, want = np.array(values, np.int64), {}
    for v in values:
        if v in want:
            continue
        queue, seen = [v], {v}
        while queue:
            at = queue.pop()
            for w in array[np.bitwise_count((array ^ at).view(np.uint64)) <= 3].tolist():
                if w not in seen:
                    seen.add(w)
                    queue.append(w)
        want |= {w: min(seen) for w in seen} if len(seen) > 1 else {v: v}
    assert {v: got.get(v, v) for v in values} == want
