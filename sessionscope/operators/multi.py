"""Statistics of many tasks in one job.

The tasks' sessions come from ``operators.task_sessions``: actions are added up
once per session and elementary date interval, so overlapping tasks multiply
neither the shuffles nor the rows in front of the user predicates, and list
parameters of any length are joined as rows. A task whose filters keep nothing
still gets its row (count 0, NULL ratios).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionscope.operators.stats import bucket_counts, ratios_from_counts
from sessionscope.operators.task_sessions import task_sessions
from sessionscope.sources.tasks import TaskTable, task_table


def task_stats(sessions: DataFrame, table: TaskTable) -> DataFrame:
    """One ``session_aggr_stat`` row per task from the tasks' sessions."""
    wanted = sessions.sparkSession.createDataFrame([(t.task_id,) for t in table.rows], "task_id long")
    counts = bucket_counts(sessions, by=["task_id"])
    count_cols = [c for c in counts.columns if c != "task_id"]
    filled = (wanted.join(counts, "task_id", "left")
              .select("task_id", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in count_cols]))
    return ratios_from_counts(filled)


def multi_task_stat(actions: DataFrame, users: DataFrame, tasks: DataFrame,
                    task_ids: list[int] | None = None, max_tasks: int = 1000) -> DataFrame:
    """One ``session_aggr_stat`` row per task of the table (or per id given).

    Missing or repeated ids and invalid tasks raise ``ValueError``.
    """
    table = task_table(tasks, task_ids, max_tasks)
    return task_stats(task_sessions(actions, users, table), table)
