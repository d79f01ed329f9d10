import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionscope.llm import projection_search as ps
from sessionscope.llm.queries import op11_projection_search

from .conftest import SF01


def brute(rows, k=10, every=100):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        out[int(ids[i])] = [(int(ids[j]), d[j]) for j in np.lexsort((ids, d))[:k] if np.isfinite(d[j])]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("shape", [{}, {"block_rows": 40, "leaf_rows": 8}, {"block_rows": 100, "sample": 64}])
def test_recall_against_brute_force(spark, shape):
    table = spark.read.parquet(f"{SF01}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in table.collect()])
    found = op11_projection_search(spark, SF01) if not shape else \
        ps.nearest(table, F.col("vec_id") % 100 == 0, **shape)
    got = by_query(found.collect())
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hits = sum(len({v for v, _ in want[q]} & {v for v, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {q: dict(brute([(r.vec_id, r.embedding) for r in table.collect()], k=10_000)[q]) for q in list(want)[:2]}
    for q, all_of_them in exact.items():
        assert all(math.isclose(all_of_them[v], d, rel_tol=1e-12) for v, d in got[q])


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_vectors_that_take_no_part(spark):
    good = [(i, [float(i % 7 + 1), float(i // 7)]) for i in range(1, 30)]
    bad = [(100, None), (200, [0.0, 0.0]), (300, [1.0, None]), (400, [1.0, float("nan")]), (500, [1.0, float("inf")]),
           (600, []), (700, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    table = vectors(spark, [(0, [1.0, 1.0]), *good, *bad]) \
        .withColumns({"block": F.lit(1), "cell": F.lit("x"), "score": F.lit(None), "query_id": F.lit(3)})
    got = by_query(ps.nearest(table, F.col("vec_id") % 100 == 0).collect())
    assert got == brute([(0, [1.0, 1.0]), *good])


def test_copies_tie_to_the_smaller_id_across_slices(spark):
    # a third of the rows is one vector, far more than a block holds
    rng = np.random.default_rng(1)
    rows = [(i, [0.25, -0.5, 1.0]) for i in range(0, 120)] + [(i, rng.normal(size=3).tolist()) for i in range(120, 360)]
    got = by_query(ps.nearest(vectors(spark, rows), F.col("vec_id") % 60 == 0, block_rows=16, leaf_rows=4).collect())
    assert got[0] == [(i, 0.0) for i in range(1, 11)] and got[60] == [(i, 0.0) for i in range(10)]


def test_repeated_ids_fewer_candidates_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0]), (0, [5.0, 5.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 3.0])]
    got = by_query(ps.nearest(vectors(spark, rows), F.col("vec_id") % 100 == 0).collect())
    assert got == {0: [(1, 1.0), (2, math.sqrt(10.0))]}
    assert ps.nearest(vectors(spark, []), F.col("vec_id") == 0).collect() == []
    assert ps.nearest(vectors(spark, rows), F.col("vec_id") == 77).collect() == []
    assert ps.nearest(vectors(spark, rows[:1]), F.col("vec_id") == 0).collect() == []


def test_the_search_is_exact_when_the_test_must_be_certain():
    rng = np.random.default_rng(3)
    x, stable = rng.normal(size=(500, 12)), ps.projection(12, 8)
    block = ps.Block.unpacked(ps.Block.build(np.arange(500), x, stable, 16).packed(), 12, 8)
    near, apart = block.search(np.arange(20), x[:20], x[:20] @ stable, np.full(20, np.inf), 5, 1e9)
    for q in range(20):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        assert near[q].tolist() == np.argsort(d)[:5].tolist()
        assert np.allclose(apart[q], np.sort(d)[:5])


def test_a_surer_test_verifies_more():
    assert ps.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)   # tables of the distribution
    assert ps.chi_square_quantile(0.9, 2) == pytest.approx(4.605, abs=1e-3)
    assert ps.chi_square(ps.chi_square_quantile(0.5, 6), 6) == pytest.approx(0.5)


def test_every_row_is_in_a_cell_and_cells_follow_the_tree():
    rng = np.random.default_rng(4)
    sample, points = rng.normal(size=(400, 3)), rng.normal(size=(1000, 3))
    cells = ps.Cells.fit(sample, 16)
    own = cells.of(points)
    assert own.min() >= 0 and own.max() < 16 and len(np.unique(own)) == 16
    assert (ps.Cells.fit(np.zeros((400, 3)), 16).of(np.zeros((5, 3))) == 0).all()   # all alike
