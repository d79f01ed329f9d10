import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sessionscope.llm import merkle
from sessionscope.llm.common import crc_remainder
from sessionscope.llm.queries import op12_merkle_manifest

from .conftest import SF001, SF01

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in merkle.FIELDS))


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, i):
    for level in levels[:-1]:
        run = i - i % 8
        yield "".join(level[run:i]), "".join(level[i + 1:run + 8])
        i //= 8


def brute(rows):
    by_lang = {}
    for r in rows:
        other = r
        if r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
            other = r | {"text": r["text"].translate(str.maketrans(UPPER, LOWER))}
        by_lang.setdefault(r["lang"], []).append((r["doc_id"], leaf(r), leaf(other)))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        by_lang[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {lang: tree([x[1] for x in by_lang[lang]]) for lang in langs}
    top = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (doc_id, own, folded) in enumerate(by_lang[lang]):
            path = [*siblings(trees[lang], i), *siblings(top, k)]
            for left, right in path:
                folded = h(left, folded, right)
            out.append((doc_id, lang, i, own, trees[lang][-1][0], top[-1][0], h(*(a + b for a, b in path)), folded,
                        folded == top[-1][0]))
    return sorted(out, key=str)


def got(docs, **kw):
    tampered = F.when(crc_remainder(F.col("doc_id"), 3) == 0, F.translate("text", UPPER, LOWER))
    return sorted((tuple(r) for r in merkle.manifest(docs, tampered, **kw).collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = sorted(((d, *x) for d, _, _, *x in brute(rows)), key=str)
    assert sorted((tuple(r) for r in op12_merkle_manifest(spark, SF001).collect()), key=str) == want


@pytest.fixture
def odd(spark):
    """Repeated ids, equal rows, ids far apart and below zero, null ids, languages and texts."""
    base = spark.read.parquet(f"{SF01}/documents.parquet").where("doc_id < 150")
    return base.unionByName(base.where("doc_id < 20")) \
        .unionByName(base.where("doc_id < 40").withColumn("doc_id", F.lit(None).cast("long"))) \
        .unionByName(base.where("doc_id < 60").withColumn("doc_id", F.lit(7).cast("long"))) \
        .unionByName(base.where("doc_id < 30").withColumn("lang", F.lit(None).cast("string"))) \
        .unionByName(base.where("doc_id < 30").withColumn("doc_id", F.expr("-doc_id * 100004000047L"))) \
        .unionByName(base.where("doc_id < 5").withColumn("text", F.lit(None).cast("string"))) \
        .withColumns({"group": F.lit("x"), "leaf": F.lit(1), "place": F.lit(None), "node": F.lit(2)})


@pytest.mark.parametrize("levels", [1, 4])
def test_ties_nulls_and_clashing_names(odd, levels):
    assert got(odd, levels=levels) == brute([r.asDict() for r in odd.collect()])


def test_many_languages_have_a_tree_of_their_own(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").withColumn("lang", F.concat("lang", F.col("doc_id") % 70))
    assert got(docs, levels=1) == brute([r.asDict() for r in docs.collect()])


def test_one_row_is_leaf_subroot_and_root(documents):
    (r,) = merkle.manifest(documents([(5, "Abc")]), proofs=True).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.verified and r.proof == []
    assert r.proof_sha256 == hashlib.sha256(b"").hexdigest()


def test_proofs_fold_to_the_root(spark):
    for r in merkle.manifest(spark.read.parquet(f"{SF001}/documents.parquet"), proofs=True, levels=2).collect():
        folded = r.leaf
        for step in r.proof:
            folded = h(step.left, folded, step.right)
        assert folded == r.root == r.folded_root and r.verified


def test_empty_table(documents):
    found = merkle.manifest(documents([]).where("false"))
    assert found.collect() == [] and "proof_sha256" in found.columns


def test_a_bit_index_ranks_sparse_keys(spark):
    keys = [-(1 << 62), -1025, -1, 0, 1, 63, 64, 1023, 1024, 1 << 20, 1 << 40, (1 << 62) + 5]
    rows = spark.createDataFrame([("a", k, 1 + i % 3) for i, k in enumerate(keys)], "group string, key long, n long")
    found = {r.key: (r.start, r.total, r.tied) for r in
             merkle.ranks(rows, merkle.bitmap_index(rows, "key"), "key").collect()}
    start = 0
    for i, k in enumerate(keys):
        assert found[k] == (start, sum(1 + j % 3 for j in range(len(keys))), False)
        start += 1 + i % 3
