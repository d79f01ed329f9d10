import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from fixtures import action, actions_df
from sessionscope.operators.lists import rollup_any_size, session_values, value_slices
from sessionscope.operators.sessions import rollup_sessions


def _actions(spark, n=900):
    """A third of all actions in one session with many values."""
    rng = random.Random(2)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append(action("hot" if hot else f"s{i % 40}", 1, i, keyword=f"k{rng.randrange(400 if hot else 4)}" if i % 2 else "",
                           category=rng.randrange(300) if hot and i % 4 == 0 else None))
    rows += [action("none", 2, 0), action(None, 3, 1, keyword="lost")]
    return actions_df(spark, rows)


@pytest.mark.parametrize("size", [7, 50, 10_000])
@pytest.mark.parametrize("partitions", [1, 13])
def test_slices_are_the_ordered_list(spark, size, partitions):
    acts = _actions(spark)
    want = {r.session_id: (r.search_keywords, [str(c) for c in r.click_category_ids]) for r in rollup_sessions(acts).collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = value_slices(session_values(acts.repartition(partitions)), size).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for i, kind in enumerate(("keyword", "category")):
        held = {}
        for r in sorted((r for r in rows if r.kind == kind), key=lambda r: (r.session_id, r.slice)):
            assert r.slice == len(held.setdefault(r.session_id, [])) and len(r["values"]) <= size
            held[r.session_id].append((r["values"], r.slices))
        for session, parts in held.items():
            assert [v for values, _ in parts for v in values] == want[session][i]
            assert all(n == len(parts) and (len(v) == size or j == n - 1) for j, (v, n) in enumerate(parts))
        assert held.keys() == {s for s, lists in want.items() if lists[i]}


def test_rollup_with_short_lists_in_place(spark):
    acts = _actions(spark)
    sessions, _ = rollup_any_size(acts, 50)
    got = {r.session_id: r.asDict() for r in sessions.collect()}
    for r in rollup_sessions(acts).collect():
        own, want = got.pop(r.session_id), r.asDict()
        for name in ("search_keywords", "click_category_ids"):
            slices = own.pop(f"{name}_slices")
            assert slices == -(-len(want[name]) // 50)
            if slices > 1:
                assert own[name] is None
                own[name] = want[name]
        assert own == want
    assert not got


def test_no_object_aggregate_over_the_log(spark):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        session_values(_actions(spark)).explain()
    assert "ObjectHashAggregate" not in out.getvalue() and "HashAggregate" in out.getvalue()


def test_empty_log(spark):
    sessions, slices = rollup_any_size(_actions(spark).where(F.lit(False)))
    assert sessions.collect() == [] and slices.collect() == []
