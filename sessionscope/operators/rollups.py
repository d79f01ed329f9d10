"""Time rollups of actions and sessions, keyed by text time keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionscope.functions.timefmt import (
    date_hour, date_key, format_date, minute_key, parse_date_key, seconds_between, time_after, time_before,
)
from sessionscope.operators.sequence import MAX_ROWS, with_previous


def action_gaps(actions: DataFrame, max_rows: int = MAX_ROWS,
                keep: list[str] | None = None) -> DataFrame:
    """Every action with ``gap_seconds``: seconds since the previous action
    of its session (NULL for a session's first action).

    ``keep`` names the action columns to carry (all by default). The
    rows of a group are ordered together, so narrowing here keeps unused
    columns out of that exchange.
    """
    acts = actions.where(F.col("session_id").isNotNull())
    if keep is not None:
        acts = acts.select(*dict.fromkeys(["session_id", "action_time", "action_id", *keep]))
    prev = with_previous(acts, "session_id", ["action_time", "action_id"], ["action_time"],
                         max_rows)
    return prev.withColumn("gap_seconds", seconds_between(F.col("prev_action_time"), F.col("action_time")))


def actions_around(actions: DataFrame, moment: Column) -> DataFrame:
    """Per session: actions strictly before and strictly after ``moment`` (a
    time, such as noon of the action's day); an action at the moment or
    without a time is in neither."""
    at = F.col("action_time")
    return (actions.where(F.col("session_id").isNotNull()).groupBy("session_id")
            .agg(F.count_if(time_before(at, moment)).alias("actions_before"),
                 F.count_if(time_after(at, moment)).alias("actions_after")))


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """Sessions by the ``yyyy-MM-dd_HH`` hour of their start."""
    return (sessions.groupBy(date_hour(F.col("start_time")).alias("date_hour"))
            .agg(F.count(F.lit(1)).alias("sessions"),
                 F.sum("step_length").alias("actions")))


def actions_per_minute(actions: DataFrame) -> DataFrame:
    """Actions by ``yyyyMMddHHmm`` minute."""
    return (actions.groupBy(minute_key(F.col("action_time")).alias("minute_key"))
            .agg(F.count(F.lit(1)).alias("actions"),
                 F.count_distinct("session_id").alias("sessions")))


def daily_rollup(sessions: DataFrame) -> DataFrame:
    """Per ``yyyyMMdd`` day of session start: sessions, actions, users and
    the day read back from its key."""
    daily = (sessions.groupBy(date_key(F.col("start_time")).alias("date_key"))
             .agg(F.count(F.lit(1)).alias("sessions"),
                  F.sum("step_length").alias("actions"),
                  F.count_distinct("user_id").alias("users"),
                  F.max("visit_length").alias("longest_visit")))
    return daily.withColumn("date", format_date(parse_date_key(F.col("date_key"))))
