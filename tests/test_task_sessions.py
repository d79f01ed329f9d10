"""Many tasks at once: elementary intervals, list tables, all results by task."""

import contextlib
import datetime as dt
import io
import json
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from fixtures import action, actions_df, user, users_df
from sessionscope.functions.bloom import bloom_filter
from sessionscope.operators.extract import random_extract
from sessionscope.operators.intervals import elementary_intervals
from sessionscope.operators.sessions import rollup_sessions
from sessionscope.operators.task_sessions import interval_actions, session_intervals, task_sessions
from sessionscope.plans.job import filtered_sessions, task_outputs
from sessionscope.plans.outputs import all_outputs
from sessionscope.sources.tasks import load_task, load_tasks, task_table
from sessionscope.sources.testdata import load_actions, load_users


def _tasks(spark, rows):
    return spark.createDataFrame([(i, json.dumps({k: [v] for k, v in p.items()})) for i, p in rows],
                                 "task_id long, task_param string")


def _dates(lo, hi):
    return {"startDate": f"2024-01-{lo:02d}", "endDate": f"2024-01-{hi:02d}"}


ROWS = [
    (1, _dates(1, 31)), (2, _dates(5, 12)), (3, _dates(7, 9) | {"sex": "female"}), (4, _dates(12, 20) | {"keywords": "kw1,kw2,kw3"}),
    (5, _dates(9, 4)), (6, _dates(9, 9) | {"startAge": "20", "endAge": "45"}), (7, _dates(2, 28) | {"categoryIds": "1,2,3,4,5,6,7,8,9"}),
    (8, _dates(1, 31) | {"professionals": "BUILDING,MACHINERY", "cities": "NATION_1,NATION_2,NATION_3,NATION_4"}),
    (9, _dates(1, 31) | {"keywords": ","}), (10, _dates(3, 26) | {"startAge": "30"}),
]


def test_intervals_cover_exactly_the_tasks_days(spark):
    found = elementary_intervals(task_table(_tasks(spark, ROWS)).rows)
    epoch = dt.date(1970, 1, 1).toordinal()
    for i, p in ROWS:
        lo, hi = (dt.date.fromisoformat(p[k]).toordinal() - epoch for k in ("startDate", "endDate"))
        days = set(range(lo, hi + 1))
        a, b = found.runs.get(i, (0, -1))
        assert {d for x, y in found.days[a:b + 1] for d in range(x, y + 1)} == days
    assert len(found.days) < 2 * len(ROWS)
    assert elementary_intervals([]).dates is None
    apart = task_table(_tasks(spark, [(1, _dates(1, 2)), (2, _dates(20, 21))]))
    assert len(elementary_intervals(apart.rows).days) == 2      # days of no task are in no interval


@pytest.mark.parametrize("clock", ["hour", "month"])
def test_sessions_of_every_task_equal_the_single_task(spark, clock):
    acts, users = load_actions(spark, SF001, clock), load_users(spark, SF001)
    tasks = _tasks(spark, ROWS)
    columns = ["session_id", "user_id", "start_time", "end_time", "visit_length", "step_length", "age", "professional",
               "city", "sex"]
    got = {}
    for r in task_sessions(acts, users, task_table(tasks)).collect():
        got.setdefault(r.task_id, []).append(tuple(r[c] for c in columns))
    for i, _ in ROWS:
        want = filtered_sessions(acts, users, load_task(tasks, i)).select(*columns).collect()
        assert sorted(got.get(i, [])) == sorted(map(tuple, want)), i
    assert len(got[1]) > len(got[8]) > 0 and len(got[4]) > 0 and 5 not in got and 9 not in got


def test_sessions_of_several_users_and_users_listed_twice(spark):
    rows = [("2024-01-0" + str(d), u, "s", 0, f"2024-01-0{d} 5:00:0{u}", None, None, None, None, None, None, None)
            for d, u in ((1, 3), (2, 2), (3, 1), (4, 4))]
    from sessionscope.sources.schemas import RAW_ACTION_SCHEMA
    from sessionscope.sources.tables import normalize_actions
    acts = normalize_actions(spark.createDataFrame(rows, RAW_ACTION_SCHEMA))
    users = users_df(spark, [user(1), user(2, age=50), user(3), user(3, city="c2"), user(4)])
    tasks = _tasks(spark, [(1, _dates(1, 1)), (2, _dates(1, 2)), (3, _dates(1, 4)), (4, _dates(4, 4)),
                           (5, _dates(1, 2) | {"startAge": "20", "endAge": "40"})])
    found = task_sessions(acts, users, task_table(tasks)).collect()
    assert sorted((r.task_id, r.user_id, r.step_length, r.city) for r in found) == [
        (1, 3, 1, "c1"), (1, 3, 1, "c2"), (2, 2, 2, "c1"), (3, 1, 4, "c1"), (4, 4, 1, "c1")]


def test_a_thousand_overlapping_tasks_do_not_multiply_the_log(spark):
    acts = load_actions(spark, SF001, "month")
    table = task_table(_tasks(spark, [(i, _dates(1 + i % 9, 20 + i % 11)) for i in range(1000)]))
    intervals = elementary_intervals(table.rows)
    rows = session_intervals(interval_actions(acts, intervals))
    sessions = rows.select("session_id").distinct().count()
    assert rows.count() <= sessions * len(intervals.days) and len(intervals.days) < 40
    per_task = task_sessions(acts, load_users(spark, SF001), table).groupBy("task_id").count().collect()
    assert len(per_task) == 1000


def test_long_lists_are_data_and_not_plan(spark):
    def plan(n):
        tasks = _tasks(spark, [(1, _dates(1, 31) | {"keywords": ",".join(f"kw{2 * i}" for i in range(n)),
                                                    "cities": ",".join(f"NATION_{i}" for i in range(n))})])
        found = task_sessions(load_actions(spark, SF001, "hour"), load_users(spark, SF001), task_table(tasks))
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            found.explain()
        # the filters' bits are one literal of fixed size
        return found, len(re.sub(r"\[[-0-9,]+\]", "[]", out.getvalue()))

    few, small = plan(2000)
    many, large = plan(100_000)
    assert large < small + 200
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect())) and few.count() > 0


def test_bloom_filter_passes_every_value_and_few_others(spark):
    values = spark.range(0, 100_000).selectExpr("concat('v', id) AS v")
    test = bloom_filter(values, "v")
    others = spark.range(100_000, 200_000).selectExpr("concat('v', id) AS v")
    assert values.where(test(F.col("v"))).count() == 100_000
    assert others.where(test(F.col("v"))).count() < 12_000
    sharper = bloom_filter(values, "v", hashes=3)
    assert values.where(sharper(F.col("v"))).count() == 100_000 and others.where(sharper(F.col("v"))).count() < 5_000
    assert spark.sql("SELECT CAST(NULL AS STRING) v").where(test(F.col("v"))).count() == 0
    none = bloom_filter(values.where("false"), "v", bits=64)
    assert others.where(none(F.col("v"))).count() == 0
    with pytest.raises(ValueError):
        bloom_filter(values, "v", bits=100)


@pytest.mark.parametrize("per_day, spare", [(5, 4.0), (5, -50.0), (0, 4.0), (10_000, 4.0)])
def test_hours_that_fall_short_are_ranked_in_full(spark, per_day, spare):
    rows = [action(f"a{i}", 1, 10 * i) for i in range(400)] + [action(f"x{i}", 1, 0, time_text="junk") for i in range(30)]
    sessions = rollup_sessions(actions_df(spark, rows)).select("session_id", "start_time")
    got = random_extract(sessions, per_day, "s", spare=spare)     # a negative spare leaves no candidates
    want = random_extract(sessions, per_day, "s", spare=1e9)      # this one leaves all of them
    key = lambda r: (r.session_id, r.date_hour, r.rank, r.quota)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect())) and want.count() > 0


def test_all_outputs_equal_the_single_tasks(spark):
    acts, users = load_actions(spark, SF001, "hour"), load_users(spark, SF001)
    rows = [(i, p | {"targetPageFlow": "1,2,3,4"}) for i, p in ROWS[:5]] + [(11, _dates(1, 31) | {"targetPageFlow": "9,8"}),
                                                                           (12, _dates(2, 3) | {"targetPageFlow": "9"})]
    tasks = _tasks(spark, rows)
    found = {name: df.collect() for name, df in all_outputs(acts, users, task_table(tasks), 3).items()}
    for params in load_tasks(tasks):
        single = task_outputs(acts, users, params, 3, seed=str(params.task_id), checkpoint=False)
        for name, df in single.items():
            own = sorted(str(r) for r in found[name] if r.task_id == params.task_id)
            assert own == sorted(map(str, df.collect())), (params.task_id, name)
        if "page_flow_conversion" not in single:
            assert not [r for r in found["page_flow_conversion"] if r.task_id == params.task_id]


def test_the_log_is_read_a_fixed_number_of_times(spark):
    acts, users = load_actions(spark, SF001, "hour"), load_users(spark, SF001)

    def reads(n):
        rows = [(i, _dates(1 + i % 20, 28) | {"targetPageFlow": "1,2", "keywords": "kw1"}) for i in range(n)]
        outputs = all_outputs(acts, users, task_table(_tasks(spark, rows)), checkpoint=False)
        return {name: df._jdf.queryExecution().executedPlan().toString().count("events.parquet") for name, df in outputs.items()}

    assert reads(2) == reads(60)
