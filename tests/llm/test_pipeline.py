import os
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline as pipeline  # noqa: E402
from sessionscope.llm import langid  # noqa: E402

from .conftest import SF01, SF001  # noqa: E402
from .test_packing import checked, pieces_of, tokenizer  # noqa: E402, F401
from .test_pii import base  # noqa: E402
from .test_simhash import brute as simhash_brute  # noqa: E402


def frames(spark, sf_dir):
    """Each stage's input and output."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        made = stage(spark, docs, sf_dir).cache()
        out.append((name, docs, made))
        docs = made
    return out


@pytest.mark.parametrize("sf_dir", [SF01])
def test_every_stage_equals_its_brute_force(spark, tokenizer, sf_dir):  # noqa: F811
    stages = frames(spark, sf_dir)
    rows = [({r.doc_id: r for r in before.collect()}, after.collect()) for _, before, after in stages]
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").dtypes
    assert all(after.dtypes == columns for _, _, after in stages[:-1])

    docs, kept = rows[0]  # language ID: the same models, applied text by text
    models = langid.fit(stages[0][1])
    assert {r.doc_id for r in kept} == {d for d, r in docs.items() if not langid.decide(models, r.text, .7, 6.)[3]}
    assert len(kept) >= .99 * len(docs) and all(tuple(r) == tuple(docs[r.doc_id]) for r in kept)

    docs, kept = rows[1]
    want = simhash_brute([(d, r.text) for d, r in docs.items()])
    assert sorted(r.doc_id for r in kept) == sorted({c for _, _, c in want})
    assert all(tuple(r) == tuple(docs[r.doc_id]) for r in kept) and len(kept) < len(docs)

    docs, kept = rows[2]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert {r.doc_id for r in kept} == {d for d, r in docs.items() if not any(i in r.text for i in items)}
    assert len(kept) < len(docs)

    docs, changed = rows[3]
    assert {r.doc_id for r in changed} == set(docs)
    for r in changed:
        text = docs[r.doc_id].text
        spans = base(text)
        assert (r.text != text) >= bool(spans) and r.n_chars == len(r.text)
        assert not any(text[s:e] in r.text for k, s, e in spans if k in ("email", "card", "phone"))
        if not re.search("[0-9@]", text):
            assert r.text == text

    docs, packed = rows[4]
    want = pieces_of(tokenizer, [(d, r.text) for d, r in docs.items()], 2048)
    assert sorted((tuple(r)[:5] for r in packed), key=str) == want
    assert checked(packed, 2048) <= -(-sum(w[3] for w in want) // 2048) * 1.01 + 1


def test_run_gives_the_last_stages_rows(spark):
    want = frames(spark, SF001)[-1][2]
    got = pipeline.run(spark, SF001)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))


def test_edge_cases(spark, documents):
    english = spark.read.parquet(f"{SF001}/documents.parquet").where("lang = 'en' and length(text) > 400").limit(4).collect()
    a, b, c, d = (r.text for r in english)
    rows = [(1, None, None, None), (2, "", "en", None), (3, "!!! 12", "en", "s"), (4, a, "en", "s"), (5, a, "en", "s"),
            (None, a, "en", "s"), (None, b, None, None), (None, b, None, None), (8, c, "en", "s"), (8, c, "en", "t"),
            (9, d + " write to x@example.com", "en", None), (10, (c + "\n") * 300, "en", "s")]
    docs = documents(rows).withColumn("rejected", F.lit("clash")).withColumn("contaminated", F.lit(1)) \
        .withColumn("spans", F.array(F.lit(1))).withColumn("component_id", F.lit("x")).withColumn("item_ids", F.lit(2.5))
    spark.read.parquet(f"{SF001}/benchmark.parquet")
    held = docs
    for _, stage in pipeline.STAGES[:-1]:
        after = stage(spark, held, SF001)
        assert after.dtypes == docs.dtypes
        held = after.cache()
    got = held.orderBy(F.col("doc_id").asc_nulls_last()).collect()
    assert [r.doc_id for r in got] in ([4, 8, 9, None], [4, 8, 9, 10, None])
    assert [r.source for r in got if r.doc_id == 8] == ["s"]
    assert next(r.text for r in got if r.doc_id == 9) == d + " write to [email]"
    assert got[0].rejected == "clash" and got[0].spans == [1]
    packed = pipeline.pack(spark, held, SF001).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in got}
    checked(packed, 2048)


def test_empty_table(spark, documents):
    docs = documents([])
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF001)
        assert docs.count() == 0
    assert np.size(docs.columns) > 0
