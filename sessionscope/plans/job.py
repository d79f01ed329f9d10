"""The session statistics job: task → actions → sessions → users → filter →
statistics → sink, declared as one DataFrame plan with one action (the write).

    python -m sessionscope.plans.job <task_id> --actions … --users … --tasks … --out … [--all-outputs]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionscope.functions.timefmt import format_time
from sessionscope.operators.extract import random_extract, session_detail

from sessionscope.operators.filters import USER_PREDICATES, category_match, conjunction, keyword_match, user_predicate
from sessionscope.operators.flow import page_flow_conversion
from sessionscope.operators.intervals import elementary_intervals
from sessionscope.operators.multi import multi_task_stat
from sessionscope.operators.sessions import actions_in_range, rollup_sessions, with_users
from sessionscope.operators.stats import session_aggr_stat
from sessionscope.operators.topn import counts_of_sessions, top_categories, top_sessions_per_category
from sessionscope.plans.outputs import SESSION_DETAIL_COLUMNS, all_outputs
from sessionscope.session import ensure_checkpoint_dir, job_session
from sessionscope.sources.published import publish
from sessionscope.sources.sinks import stat_columns_for_storage, write_session_aggr_stat
from sessionscope.sources.tables import USER_COLUMNS, read_actions, read_table, read_users
from sessionscope.sources.tasks import TaskParams, load_task, task_ids_from_text, task_table


def filtered_sessions(actions: DataFrame, users: DataFrame, params: TaskParams,
                      prefilter_users: bool = False) -> DataFrame:
    """Session records of the task's date range that pass its predicates.

    ``prefilter_users`` drops the actions of users that fail the user
    predicates *before* the session shuffle (a left-semi join on user_id).
    Catalyst cannot do this itself, since the session's user is an
    aggregate, not a grouping key. It returns the same sessions whenever
    every session belongs to one user, and shrinks the shuffle by the
    selectivity of the user predicates.
    """
    acts = actions_in_range(actions, params.start_date, params.end_date)
    users = users.select(*USER_COLUMNS)
    flags = {name: c for name, c in (("_keyword_met", keyword_match(params)), ("_category_met", category_match(params)))
             if c is not None}
    if prefilter_users and any(f(params) is not None for f in USER_PREDICATES):
        wanted = users.where(user_predicate(params)).select("user_id")
        acts = acts.join(wanted, "user_id", "left_semi")
    kept = with_users(rollup_sessions(acts, flags), users).where(user_predicate(params))
    return kept.where(conjunction([F.col(c) for c in flags])).drop(*flags)


def session_stats(actions: DataFrame, users: DataFrame, params: TaskParams,
                  prefilter_users: bool = False) -> DataFrame:
    """The one-row ``session_aggr_stat`` result of a task."""
    return session_aggr_stat(filtered_sessions(actions, users, params, prefilter_users), params.task_id)


TOP_SESSION_COLUMNS = ("category_id", "session_id", "click_count")


def task_outputs(actions: DataFrame, users: DataFrame, params: TaskParams, extract_per_day: int = 100,
                 seed: str = "0", top_n: int = 10, checkpoint: bool = True) -> dict[str, DataFrame]:
    """Every result of a task in its stored columns, from one set of filtered
    sessions (and, when the task names a ``targetPageFlow``, its page-flow
    conversion over the task's actions).

    With ``checkpoint`` the filtered sessions and the session-category counts,
    which feed several results, are written once to the cluster's checkpoint
    folder (``spark.checkpoint.dir``, a reliable checkpoint, not a local one),
    so later results neither recompute them nor depend on their lineage when
    executors are lost. Spark removes the files with the session if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    acts = actions_in_range(actions, params.start_date, params.end_date)
    sessions = filtered_sessions(actions, users, params)
    if checkpoint:
        ensure_checkpoint_dir(sessions.sparkSession)
        sessions = sessions.checkpoint(eager=True)
    counts = counts_of_sessions(acts, sessions)
    if checkpoint:
        counts = counts.checkpoint(eager=True)
    tid = F.lit(params.task_id).cast("long").alias("task_id")
    top = top_categories(counts, top_n)
    extracted = random_extract(sessions, extract_per_day, seed)
    detail = session_detail(acts, extracted).withColumn("action_time", format_time(F.col("action_time")))
    outputs = {
        "session_aggr_stat": session_aggr_stat(sessions, params.task_id),
        "top10_category": top.select(tid, "*"),
        "top10_category_session": top_sessions_per_category(counts, top, top_n).select(tid, *TOP_SESSION_COLUMNS),
        "session_random_extract": extracted.select(
            tid, "session_id", format_time(F.col("start_time")).alias("start_time"),
            format_time(F.col("end_time")).alias("end_time"),
            F.array_join("search_keywords", ",").alias("search_keywords")),
        "session_detail": detail.select(tid, *SESSION_DETAIL_COLUMNS),
    }
    if params.target_page_flow and len(params.target_page_flow) >= 2:
        outputs["page_flow_conversion"] = page_flow_conversion(acts, params.target_page_flow).select(tid, "*")
    return outputs


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="session statistics of one task, or of several in one plan")
    ap.add_argument("task_ids", help="a task id, or several separated by commas (one job for all)")
    ap.add_argument("--actions", default="user_visit_action", help="action log: catalog table or parquet path")
    ap.add_argument("--users", default="user_info", help="user table: catalog table or parquet path")
    ap.add_argument("--tasks", default="task", help="task table: catalog table or parquet path")
    ap.add_argument("--out", required=True, help="output folder (shared storage); rows are kept per task_id")
    ap.add_argument("--prefilter-users", action="store_true",
                    help="one task: drop actions of non-matching users before the session shuffle")
    ap.add_argument("--all-outputs", action="store_true",
                    help="also write top categories, top sessions, the sample, its actions and the page flow")
    ap.add_argument("--extract-per-day", type=int, default=100, help="sample size per day for the session sample")
    ap.add_argument("--hive", action="store_true", help="resolve table names in the Hive metastore")
    args = ap.parse_args(argv)
    task_ids = task_ids_from_text(args.task_ids)
    if args.prefilter_users and (len(task_ids) > 1 or args.all_outputs):
        ap.error("--prefilter-users applies to the statistics of a single task")

    spark = job_session("session-stats", hive=args.hive)
    tasks = read_table(spark, args.tasks)
    table = task_table(tasks, task_ids)
    dates = elementary_intervals(table.rows).dates or (table.rows[0].start_date, table.rows[0].end_date)
    actions, users = read_actions(spark, args.actions, start=dates[0], end=dates[1]), read_users(spark, args.users)
    if args.all_outputs:
        outputs = all_outputs(actions, users, table, args.extract_per_day)
        outputs["session_aggr_stat"] = stat_columns_for_storage(outputs["session_aggr_stat"])
        publish(outputs, args.out, "task_id", task_ids)
    elif len(task_ids) > 1:
        write_session_aggr_stat(multi_task_stat(actions, users, tasks, task_ids), args.out)
    else:
        params = load_task(tasks, task_ids[0])
        write_session_aggr_stat(session_stats(actions, users, params, args.prefilter_users), args.out)


if __name__ == "__main__":
    main()
