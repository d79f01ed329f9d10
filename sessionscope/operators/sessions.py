"""Actions to sessions.

``rollup_sessions`` is one ``groupBy(session_id)`` whose aggregates all have
partial (map-side) forms: a session is reduced inside every map task before
the shuffle, so a very hot session costs one small partial row per task,
never a buffer of all its actions. ``with_users`` joins user attributes on
``user_id``; Catalyst/AQE broadcast the user side when its measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merge join
with skew splitting.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionscope.functions.timefmt import format_time, seconds_between
from sessionscope.sources.tables import USER_COLUMNS, date_range_predicate


def actions_in_range(actions: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Actions whose ``date`` lies in ``[start, end]``."""
    return actions.where(date_range_predicate(F.col("date"), start, end))


def rollup_sessions(actions: DataFrame, flags: dict[str, Column] | None = None) -> DataFrame:
    """One row per session id.

    user_id          smallest user id met (a session belongs to one user)
    search_keywords  distinct non-empty keywords, sorted
    click_category_ids distinct clicked categories, sorted
    start_time, end_time  first and last parseable action time
    visit_length     whole seconds from start to end
    step_length      number of actions (also those without a time)

    ``flags`` adds further aggregates, such as whether a keyword was met: a
    yes or no costs a fixed-width column where the lists would be built.
    Actions without a session id are dropped.
    """
    sessions = (
        actions.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.min("user_id").alias("user_id"),
            F.sort_array(F.collect_set(F.nullif(F.col("search_keyword"), F.lit("")))).alias("search_keywords"),
            F.sort_array(F.collect_set("click_category_id")).alias("click_category_ids"),
            F.min("action_time").alias("start_time"),
            F.max("action_time").alias("end_time"),
            F.count(F.lit(1)).alias("step_length"),
            *[c.alias(name) for name, c in (flags or {}).items()],
        )
    )
    return sessions.withColumn("visit_length", seconds_between(F.col("start_time"), F.col("end_time")))


def with_users(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Inner join on ``user_id``: sessions of unknown users drop out, a user
    listed twice doubles its sessions (as any inner join)."""
    columns = ["session_id", "user_id", "search_keywords", "click_category_ids", "start_time",
               "end_time", "visit_length", "step_length"]
    flags = [c for c in sessions.columns if c not in columns]
    return sessions.join(users.select(*USER_COLUMNS), "user_id", "inner").select(
        *columns, "age", "professional", "city", "sex", *flags)


def session_records(actions: DataFrame, users: DataFrame, start=None, end=None) -> DataFrame:
    """Date range → rollup → user join: the full session record."""
    if start is not None and end is not None:
        actions = actions_in_range(actions, start, end)
    return with_users(rollup_sessions(actions), users)


def render_lists(sessions: DataFrame) -> DataFrame:
    """Lists and times as text (comma-joined lists, ``yyyy-MM-dd HH:mm:ss``),
    the stored and exchanged form of a session record."""
    out = sessions
    if "search_keywords" in sessions.columns:
        out = out.withColumn("search_keywords", F.array_join("search_keywords", ","))
    if "click_category_ids" in sessions.columns:
        out = out.withColumn("click_category_ids", F.array_join("click_category_ids", ","))
    for c in ("start_time", "end_time"):
        if c in sessions.columns:
            out = out.withColumn(c, format_time(F.col(c)))
    return out
