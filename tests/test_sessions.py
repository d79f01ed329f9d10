"""Hand-written rows for the session job (FIXTURES §3)."""

import random

import pytest

from fixtures import action, actions_df, user, users_df
from sessionscope.operators.sessions import rollup_sessions, with_users
from sessionscope.operators.stats import bucket_counts, session_aggr_stat
from sessionscope.plans.job import filtered_sessions, session_stats
from sessionscope.sources.tasks import TaskParams

MONTH = TaskParams.of("2024-01-01", "2024-01-31")
VISIT_EDGES = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
STEP_EDGES = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]


def _visit_rows():
    rows = []
    for v in VISIT_EDGES:
        rows += [action(f"v{v}", 1, 0), action(f"v{v}", 1, v)]
    return rows


def test_visit_bucket_edges(spark):
    counts = bucket_counts(rollup_sessions(actions_df(spark, _visit_rows()))).first().asDict()
    expect = {"visit_1s_3s": 2, "visit_4s_6s": 2, "visit_7s_9s": 2, "visit_10s_30s": 2, "visit_30s_60s": 2,
              "visit_1m_3m": 2, "visit_3m_10m": 2, "visit_10m_30m": 2, "visit_30m": 1}
    assert {k: counts[k] for k in expect} == expect
    assert counts["session_count"] == len(VISIT_EDGES)   # v = 0 only in the count


def test_step_bucket_edges(spark):
    rows = [action(f"s{s}", 1, i) for s in STEP_EDGES for i in range(s)]
    counts = bucket_counts(rollup_sessions(actions_df(spark, rows))).first().asDict()
    expect = {"step_1_3": 2, "step_4_6": 2, "step_7_9": 2, "step_10_30": 2, "step_30_60": 2, "step_60": 1}
    assert {k: counts[k] for k in expect} == expect


def test_rollup_record(spark):
    rows = [action("a", 7, 0, category=10), action("a", 7, 5, category=1), action("a", 7, 9, keyword="ab"),
            action("a", 7, 12, keyword="a"), action("a", 7, 15, keyword=""), action("a", 7, 20, keyword="ab"),
            action("a", 7, 25, keyword="x|y=z,w"),
            action("a", 7, 0, time_text="junk"), action("a", 7, 0, time_text="2024-01-01 15:61:04"),
            action(None, 7, 3)]
    s = rollup_sessions(actions_df(spark, rows)).collect()
    assert len(s) == 1                      # the action without a session id is dropped
    r = s[0]
    assert r.search_keywords == ["a", "ab", "x|y=z,w"]
    assert r.click_category_ids == [1, 10]
    assert r.visit_length == 25             # unparseable times ignored for start and end
    assert r.step_length == 9               # ... but still steps
    assert r.user_id == 7


def test_user_join_drops_unknown_and_duplicates_listed_twice(spark):
    acts = actions_df(spark, [action("a", 1, 0), action("b", 2, 0), action("c", 3, 0)])
    users = users_df(spark, [user(1), user(2), user(2, age=50)])
    got = sorted(r.session_id for r in with_users(rollup_sessions(acts), users).collect())
    assert got == ["a", "b", "b"]


def _filter_case(spark):
    acts = actions_df(spark, [
        action("k1", 1, 0, keyword="shoes"), action("k1", 1, 5, category=4),
        action("k2", 2, 0, category=4),                     # clicks only, no keyword
        action("k3", 3, 0, keyword="hats"),
        action("k4", 4, 0, keyword="shoes"),                # user with NULL age and city
    ])
    users = users_df(spark, [user(1, age=25, city="c1", sex="female", professional="eng"),
                             user(2, age=35, city="c2", sex="male", professional="eng"),
                             user(3, age=45, city="c1", sex="male", professional="art"),
                             (4, "u4", "n4", None, "eng", None, "female")])
    return acts, users


@pytest.mark.parametrize("params, expect", [
    (dict(), ["k1", "k2", "k3", "k4"]),
    (dict(start_age=30, end_age=40), ["k2"]),
    (dict(start_age=30), ["k1", "k2", "k3", "k4"]),          # one-sided age bound is ignored
    (dict(professionals="eng"), ["k1", "k2", "k4"]),
    (dict(cities="c1"), ["k1", "k3"]),                       # NULL city never matches
    (dict(sex="female"), ["k1", "k4"]),
    (dict(keywords="shoes,boots"), ["k1", "k4"]),            # no keyword: excluded
    (dict(category_ids="4"), ["k1", "k2"]),
    (dict(keywords="shoes", category_ids="4", sex="female", start_age=20, end_age=30), ["k1"]),
])
def test_filters(spark, params, expect):
    acts, users = _filter_case(spark)
    p = TaskParams.of("2024-01-01", "2024-01-31", **params)
    got = sorted(r.session_id for r in filtered_sessions(acts, users, p).collect())
    assert got == expect


def test_user_prefilter_gives_the_same_sessions(spark):
    acts, users = _filter_case(spark)
    p = TaskParams.of("2024-01-01", "2024-01-31", cities="c1", sex="male")
    plain = sorted(map(tuple, filtered_sessions(acts, users, p).collect()))
    pre = sorted(map(tuple, filtered_sessions(acts, users, p, prefilter_users=True).collect()))
    assert plain == pre


def test_empty_result_has_one_row(spark):
    acts = actions_df(spark, [action("a", 1, 0)])
    users = users_df(spark, [user(1)])
    p = TaskParams.of("2023-01-01", "2023-01-31", task_id=9)
    rows = session_stats(acts, users, p).collect()
    assert len(rows) == 1 and rows[0].session_count == 0 and rows[0].task_id == 9
    assert rows[0].visit_length_1s_3s_ratio is None


def test_rounding_three_of_forty(spark):
    rows = []
    for i in range(40):
        rows += [action(f"s{i}", 1, 0), action(f"s{i}", 1, 2 if i < 3 else 100)]
    stat = session_aggr_stat(rollup_sessions(actions_df(spark, rows))).first()
    assert stat.session_count == 40
    assert stat.visit_length_1s_3s_ratio == 0.07
    assert stat.visit_length_1m_3m_ratio == 0.93


def test_same_result_for_any_partitioning_and_row_order(spark):
    rows = _visit_rows() + [action(f"s{s}", 2, i, keyword=f"k{i % 3}", category=i % 5)
                            for s in STEP_EDGES for i in range(s)]
    users = users_df(spark, [user(1), user(2, sex="female")])
    results = []
    for n in (1, 4, 50):
        shuffled = rows[:]
        random.Random(n).shuffle(shuffled)
        acts = actions_df(spark, shuffled).repartition(n)
        results.append(session_stats(acts, users, MONTH).first().asDict())
    assert results[0] == results[1] == results[2]


def test_user_prefilter_on_the_test_tables(spark):
    from conftest import SF01
    from sessionscope.plans.registry import FILTER_TASKS
    from sessionscope.sources.testdata import load_actions, load_users
    p = FILTER_TASKS["filter_all"]
    acts, users = load_actions(spark, SF01), load_users(spark, SF01)
    cols = ["session_id", "user_id", "visit_length", "step_length"]
    plain = sorted(map(tuple, filtered_sessions(acts, users, p).select(*cols).collect()))
    pre = sorted(map(tuple, filtered_sessions(acts, users, p, prefilter_users=True).select(*cols).collect()))
    assert plain == pre and len(plain) > 0
