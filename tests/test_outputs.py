"""Top categories, session sample, session detail and page flow on hand rows."""

from pyspark.sql import functions as F

from fixtures import action, actions_df, user, users_df
from sessionscope.operators.extract import random_extract, session_detail
from sessionscope.operators.flow import page_flow_conversion
from sessionscope.operators.rollups import action_gaps, actions_around
from sessionscope.operators.sessions import rollup_sessions
from sessionscope.operators.topn import session_category_counts, top_categories, top_sessions_per_category
from sessionscope.plans.job import task_outputs
from sessionscope.sources.tasks import TaskParams


def test_category_counts_split_id_lists(spark):
    acts = actions_df(spark, [
        action("a", 1, 0, category=5), action("a", 1, 1, category=5), action("a", 1, 2, order_ids="5,6"),
        action("a", 1, 3, pay_ids=" 6 ,"), action("b", 2, 0, category=6),
    ])
    got = {(r.session_id, r.category_id): (r.click_count, r.order_count, r.pay_count)
           for r in session_category_counts(acts).collect()}
    assert got == {("a", 5): (2, 1, 0), ("a", 6): (0, 1, 1), ("b", 6): (1, 0, 0)}


def test_top_categories_order_and_ties(spark):
    rows = []
    for cat, clicks, orders in [(1, 3, 0), (2, 3, 1), (3, 5, 0), (4, 0, 9)]:
        rows += [action(f"s{cat}_{i}", 1, i, category=cat) for i in range(clicks)]
        rows += [action(f"s{cat}", 1, 100 + i, order_ids=str(cat)) for i in range(orders)]
    counts = session_category_counts(actions_df(spark, rows))
    top = [r.category_id for r in top_categories(counts, 3).collect()]
    assert top == [3, 2, 1]
    ranked = top_sessions_per_category(counts, top_categories(counts, 3), 2).collect()
    per = {}
    for r in ranked:
        per.setdefault(r.category_id, []).append((r.rank, r.session_id))
    assert sorted(per[3]) == [(1, "s3_0"), (2, "s3_1")]      # ties broken by session id


def test_random_extract_quota_and_repeatability(spark):
    # 30 sessions at 05h, 10 at 06h on one day: per_day 8 -> quotas 6 and 2
    rows = [action(f"a{i}", 1, i) for i in range(30)] + [action(f"b{i}", 1, 3600 + i) for i in range(10)]
    sessions = rollup_sessions(actions_df(spark, rows))
    ex = random_extract(sessions, per_day=8, seed="x")
    got = ex.groupBy("date_hour").agg(F.count("*").alias("n"), F.max("quota").alias("q")).collect()
    assert sorted((r.date_hour, r.n, r.q) for r in got) == [("2024-01-01_05", 6, 6), ("2024-01-01_06", 2, 2)]
    again = random_extract(sessions.repartition(7), per_day=8, seed="x")
    assert sorted(r.session_id for r in ex.collect()) == sorted(r.session_id for r in again.collect())
    detail = session_detail(actions_df(spark, rows), ex)
    assert detail.count() == 8


def test_random_extract_gives_every_hour_at_least_one(spark):
    rows = [action(f"a{i}", 1, i) for i in range(100)] + [action("lonely", 1, 7200)]
    ex = random_extract(rollup_sessions(actions_df(spark, rows)), per_day=5, seed="x")
    assert "lonely" in [r.session_id for r in ex.collect()]


def test_page_flow_conversion(spark):
    # session a: 1 2 3 1 2 ; session b: 1 3 ; session c: 2 3
    rows = ([action("a", 1, i, page=p) for i, p in enumerate([1, 2, 3, 1, 2])]
            + [action("b", 1, i, page=p) for i, p in enumerate([1, 3])]
            + [action("c", 1, i, page=p) for i, p in enumerate([2, 3])])
    got = page_flow_conversion(actions_df(spark, rows), [1, 2, 3], max_rows=3).orderBy("step").collect()
    assert [(r.page_pair, r.transitions, r.base, r.conversion_rate) for r in got] == [
        ("1_2", 2, 3, 0.67), ("2_3", 2, 2, 1.0)]


def test_action_gaps(spark):
    rows = [action("a", 1, 0), action("a", 1, 7), action("a", 1, 20), action("b", 1, 5)]
    got = sorted(((r.session_id, r.gap_seconds) for r in action_gaps(actions_df(spark, rows), 2).collect()),
                 key=repr)
    assert got == sorted([("a", None), ("a", 7), ("a", 13), ("b", None)], key=repr)


def test_time_rollups(spark):
    from sessionscope.operators.rollups import actions_per_minute, daily_rollup, sessions_per_hour
    rows = [action("a", 1, 0), action("a", 1, 30), action("a", 1, 3700),   # starts 05:00, ends 06:01:40
            action("b", 2, 65), action("c", 1, 3600)]
    acts = actions_df(spark, rows)
    sessions = rollup_sessions(acts)
    hours = {r.date_hour: (r.sessions, r.actions) for r in sessions_per_hour(sessions).collect()}
    assert hours == {"2024-01-01_05": (2, 4), "2024-01-01_06": (1, 1)}
    minutes = {r.minute_key: (r.actions, r.sessions) for r in actions_per_minute(acts).collect()}
    assert minutes == {"202401010500": (2, 1), "202401010501": (1, 1), "202401010600": (1, 1),
                       "202401010601": (1, 1)}
    day = daily_rollup(sessions).first()
    assert (day.date_key, day.date, day.sessions, day.actions, day.users, day.longest_visit) == (
        "20240101", "2024-01-01", 3, 5, 2, 3700)


def test_sessions_without_a_time_are_sampled(spark):
    rows = [action("timed", 1, 0), action("untimed", 2, 0, time_text="junk"), action("blank", 3, 0, time_text="?")]
    sessions = rollup_sessions(actions_df(spark, rows))
    got = {r.session_id: (r.date_hour, r.rank, r.quota) for r in random_extract(sessions, 2, "seed").collect()}
    assert got["timed"] == ("2024-01-01_05", 1, 2)
    assert {got["untimed"][0], got["blank"][0]} == {"none"} and {got["untimed"][1], got["blank"][1]} == {1, 2}


def test_stored_columns_and_types(spark):
    acts = actions_df(spark, [action("s1", 1, 0, category=3), action("s1", 1, 5), action("s2", 2, 0, category=3)])
    params = TaskParams.of("2024-01-01", "2024-01-02", task_id=7)
    out = task_outputs(acts, users_df(spark, [user(1), user(2)]), params)
    assert out["top10_category"].dtypes == [("task_id", "bigint"), ("category_id", "bigint"), ("click_count", "bigint"),
                                            ("order_count", "bigint"), ("pay_count", "bigint")]
    assert out["top10_category_session"].dtypes == [("task_id", "bigint"), ("category_id", "bigint"),
                                                    ("session_id", "string"), ("click_count", "bigint")]
    assert out["session_random_extract"].dtypes == [("task_id", "bigint"), ("session_id", "string"),
                                                    ("start_time", "string"), ("end_time", "string"),
                                                    ("search_keywords", "string")]
    assert out["session_detail"].dtypes == [
        ("task_id", "bigint"), ("user_id", "bigint"), ("session_id", "string"), ("page_id", "bigint"),
        ("action_time", "string"), ("search_keyword", "string"), ("click_category_id", "bigint"),
        ("click_product_id", "bigint"), ("order_category_ids", "string"), ("order_product_ids", "string"),
        ("pay_category_ids", "string"), ("pay_product_ids", "string")]
    assert {r.action_time for r in out["session_detail"].collect()} == {"2024-01-01 05:00:00", "2024-01-01 05:00:05"}
    # the counts are read from the checkpoint, not computed again
    for name in ("top10_category", "top10_category_session"):
        plan = out[name]._jdf.queryExecution().executedPlan().toString()
        assert "ExistingRDD" in plan and "Generate" not in plan


def test_actions_around_a_moment(spark):
    acts = actions_df(spark, [action("s", 1, 0), action("s", 1, 10), action("s", 1, 20), action("s", 1, 0, time_text="x"),
                              action(None, 1, 0)])
    (r,) = actions_around(acts, F.lit("2024-01-01 05:00:10").cast("timestamp_ntz")).collect()
    assert (r.session_id, r.actions_before, r.actions_after) == ("s", 1, 1)
