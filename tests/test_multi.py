"""Many tasks in one job equal one job per task."""

import pytest
from pyspark.sql import functions as F

from fixtures import user, users_df
from sessionscope.operators.multi import multi_task_stat
from sessionscope.plans.job import session_stats
from sessionscope.sources.schemas import RAW_ACTION_SCHEMA
from sessionscope.sources.tables import normalize_actions
from sessionscope.sources.tasks import load_task

TASKS = [
    (1, '{"startDate":["2024-01-01"],"endDate":["2024-01-02"]}'),
    (2, '{"startDate":["2024-01-02"],"endDate":["2024-01-03"],"keywords":["k1"]}'),
    (3, '{"startDate":["2024-01-01"],"endDate":["2024-01-03"],"sex":["female"],"startAge":["20"],"endAge":["40"]}'),
    (4, '{"startDate":["2024-02-01"],"endDate":["2024-02-03"]}'),
]


def _actions(spark):
    rows = []
    for i in range(12):
        day = 1 + i % 3
        sid = f"s{i % 5}"                      # sessions recur on several days
        rows.append((f"2024-01-0{day}", i % 4, sid, i % 3, f"2024-01-0{day} {i % 24}:0{i % 6}:1{i % 10}",
                     f"k{i % 3}" if i % 2 else None, i % 7, None, None, None, None, None))
    return normalize_actions(spark.createDataFrame(rows, RAW_ACTION_SCHEMA))


def test_multi_task_equals_single_tasks(spark):
    acts = _actions(spark)
    users = users_df(spark, [user(0), user(1, sex="female", age=25), user(2, age=50), user(3, sex="female")])
    tasks = spark.createDataFrame(TASKS, "task_id long, task_param string")
    multi = {r.task_id: r.asDict() for r in multi_task_stat(acts, users, tasks).collect()}
    for tid, _ in TASKS:
        params = load_task(tasks, tid)
        single = session_stats(acts, users, params).withColumn("task_id", F.lit(tid).cast("long")).first()
        assert multi[tid] == single.asDict(), tid
    assert multi[4]["session_count"] == 0


def _same_as_single(spark, rows):
    acts, users = _actions(spark), users_df(spark, [user(0), user(1, sex="female", age=25), user(2, age=50), user(3)])
    tasks = spark.createDataFrame(rows, "task_id long, task_param string")
    multi = {r.task_id: r.asDict() for r in multi_task_stat(acts, users, tasks).collect()}
    for tid, _ in rows:
        assert multi[tid] == session_stats(acts, users, load_task(tasks, tid)).first().asDict(), tid
    return multi


def test_lists_without_entries_match_nothing_in_both_paths(spark):
    dates = '"startDate":["2024-01-01"],"endDate":["2024-01-03"]'
    names = ("cities", "professionals", "keywords", "categoryIds")
    rows = [(i, f'{{{dates},"{name}":[","]}}') for i, name in enumerate(names)]
    rows += [(10 + i, f'{{{dates},"{name}":[""]}}') for i, name in enumerate(names)]
    lists = '"keywords":["k1,k2"],"categoryIds":["1,2"],"cities":["c1"],"professionals":["p1,p2"]'
    rows += [(20, f'{{{dates},{lists}}}'), (21, f'{{{dates},"keywords":["nothing"]}}'), (22, '{"startDate":["2024-01-03"],"endDate":["2024-01-01"]}'), (30, f"{{{dates}}}")]
    multi = _same_as_single(spark, rows)
    assert all(multi[i]["session_count"] == 0 for i in range(4))       # an entry-less list
    assert all(multi[10 + i]["session_count"] == multi[30]["session_count"] > 0 for i in range(4))  # an empty text is no parameter
    assert multi[20]["session_count"] > 0 and multi[22]["session_count"] == 0


def test_missing_repeated_and_too_many_ids_raise(spark):
    acts, users = _actions(spark), users_df(spark, [user(0)])
    tasks = spark.createDataFrame(TASKS, "task_id long, task_param string")
    with pytest.raises(ValueError, match="99"):
        multi_task_stat(acts, users, tasks, [1, 99])
    with pytest.raises(ValueError, match="unique: 1"):
        multi_task_stat(acts, users, tasks.unionAll(tasks.where("task_id = 1")))
    with pytest.raises(ValueError, match="more than 2"):
        multi_task_stat(acts, users, tasks, max_tasks=2)
    bad = spark.createDataFrame([(1, '{"startDate":["x"],"endDate":["2024-01-02"]}')], tasks.schema)
    with pytest.raises(ValueError, match="startDate"):
        multi_task_stat(acts, users, bad)
    assert multi_task_stat(acts, users, tasks.where("false")).collect() == []
    assert [r.task_id for r in multi_task_stat(acts, users, tasks, [3, 1]).orderBy("task_id").collect()] == [1, 3]
