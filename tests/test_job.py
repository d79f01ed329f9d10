"""The command-line job over parquet inputs in the upstream text form."""

import os
import tempfile

import pytest

from fixtures import action, user
from sessionscope.plans.job import main
from sessionscope.sources.published import read_published
from sessionscope.sources.schemas import RAW_ACTION_SCHEMA, USER_SCHEMA


def _inputs(spark, root):
    rows = []
    for i in range(6):
        rows += [action(f"s{i}", i % 3, 0, keyword=f"k{i % 2}", category=i),
                 action(f"s{i}", i % 3, 5 + 100 * i, category=i, order_ids=str(i)),
                 action(f"s{i}", i % 3, 10 + 100 * i, pay_ids=str(i))]
    spark.createDataFrame(rows, RAW_ACTION_SCHEMA).write.parquet(f"{root}/actions")
    spark.createDataFrame([user(0), user(1, sex="female"), user(2, age=70)], USER_SCHEMA).write.parquet(f"{root}/users")
    spark.createDataFrame(
        [(7, "t", None, None, None, None, None,
          '{"startDate":["2024-01-01"],"endDate":["2024-01-01"],"startAge":["18"],"endAge":["60"],'
          '"targetPageFlow":["0,1,2"]}')],
        "task_id long, task_name string, create_time string, start_time string, finish_time string, "
        "task_type string, task_status string, task_param string").write.parquet(f"{root}/tasks")


def _published(spark, root, name):
    return read_published(spark, f"{root}/out", name, "task_id")


def test_job_writes_the_task_row(spark):
    root = tempfile.mkdtemp(prefix="sessionscope-job-")
    _inputs(spark, root)
    args = ["7", "--actions", f"{root}/actions", "--users", f"{root}/users", "--tasks", f"{root}/tasks",
            "--out", f"{root}/out"]
    main(args)
    main(args)                                   # a re-run replaces the row
    rows = spark.read.parquet(f"{root}/out").collect()
    assert len(rows) == 1 and rows[0].task_id == 7 and rows[0].session_count == 4   # user 2 is 70


def test_job_runs_several_tasks_at_once(spark):
    root = tempfile.mkdtemp(prefix="sessionscope-job-")
    _inputs(spark, root)
    spark.createDataFrame([(8, '{"startDate":["2024-01-01"],"endDate":["2024-01-01"],"sex":["female"]}')],
                          "task_id long, task_param string").write.mode("append").parquet(f"{root}/tasks")
    main(["7,8", "--actions", f"{root}/actions", "--users", f"{root}/users", "--tasks", f"{root}/tasks",
          "--out", f"{root}/out"])
    rows = {r.task_id: r.session_count for r in spark.read.parquet(f"{root}/out").collect()}
    assert rows == {7: 4, 8: 2}


def test_job_writes_all_outputs(spark):
    root = tempfile.mkdtemp(prefix="sessionscope-job-")
    _inputs(spark, root)
    main(["7", "--actions", f"{root}/actions", "--users", f"{root}/users", "--tasks", f"{root}/tasks",
          "--out", f"{root}/out", "--all-outputs", "--extract-per-day", "2"])
    names = sorted(os.listdir(f"{root}/out/data"))
    assert names == ["page_flow_conversion", "session_aggr_stat", "session_detail", "session_random_extract",
                     "top10_category", "top10_category_session"]
    flow = _published(spark, root, "page_flow_conversion").orderBy("step").collect()
    assert [r.page_pair for r in flow] == ["0_1", "1_2"] and flow[0].task_id == 7
    top = _published(spark, root, "top10_category").collect()
    assert sorted(r.category_id for r in top) == [0, 1, 3, 4]
    sample = _published(spark, root, "session_random_extract").count()
    detail = _published(spark, root, "session_detail").count()
    assert 1 <= sample <= 4 and detail == 3 * sample


def test_read_table_prefers_catalog_names(spark):
    from sessionscope.sources.tables import read_actions, read_users
    rows = [action("a", 1, 0, keyword="x"), action("a", 1, 9)]
    spark.createDataFrame(rows, RAW_ACTION_SCHEMA).createOrReplaceTempView("user_visit_action")
    spark.createDataFrame([user(1)], USER_SCHEMA).createOrReplaceTempView("user_info")
    acts = read_actions(spark, "user_visit_action")
    assert acts.count() == 2 and dict(acts.dtypes)["action_time"] == "timestamp_ntz"
    assert dict(acts.dtypes)["date"] == "date" and acts.where("action_id IS NULL").count() == 0
    assert read_users(spark, "user_info").first().user_id == 1


def _job(spark, root, ids, *more):
    main([ids, "--actions", f"{root}/actions", "--users", f"{root}/users", "--tasks", f"{root}/tasks",
          "--out", f"{root}/out", *more])


def test_job_writes_all_outputs_of_several_tasks(spark, tmp_path):
    root = str(tmp_path)
    _inputs(spark, root)
    spark.createDataFrame([(8, '{"startDate":["2024-01-01"],"endDate":["2024-01-01"],"sex":["female"]}')],
                          "task_id long, task_param string").write.mode("append").parquet(f"{root}/tasks")
    _job(spark, root, "7,8", "--all-outputs", "--extract-per-day", "2")
    for name in ("session_aggr_stat", "session_detail", "session_random_extract", "top10_category",
                 "top10_category_session"):
        assert {r.task_id for r in _published(spark, root, name).collect()} == {7, 8}, name


def test_job_refuses_unknown_ids_and_flags_it_cannot_apply(spark, tmp_path):
    root = str(tmp_path)
    _inputs(spark, root)
    for ids in ("7,99", "99"):
        with pytest.raises(ValueError, match="99"):
            _job(spark, root, ids)
    for ids, flags in (("7,8", ["--prefilter-users"]), ("7", ["--prefilter-users", "--all-outputs"])):
        with pytest.raises(SystemExit):
            _job(spark, root, ids, *flags)
    assert not os.path.exists(f"{root}/out")
