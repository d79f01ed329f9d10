"""Stored session states by date, merged on demand.

A session's record over a date range is made of what each date contributes:
smallest user, first and last time, number of actions, and the distinct values
met. These states are mergeable, so they are stored once per date and the
actions are read again only for dates whose log has changed. The two tables of
a date (``sessions``, ``values``) are published together (``sources.published``).

Which dates have changed is told by a digest of each date's actions, one
aggregate over the log without moving its rows, kept with the date's commit; or
by the caller, who then spares that pass.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionscope.functions.timefmt import seconds_between
from sessionscope.operators.lists import MAX_VALUES, session_values, value_slices, with_lists
from sessionscope.sources.published import current, publish, read_published
from sessionscope.sources.tables import as_date

_STATE = ("user_id", "search_keyword", "click_category_id", "action_time", "session_id")


def date_digests(actions: DataFrame) -> DataFrame:
    """(date, digest): how many actions a date has and the sum of their hashes."""
    row = F.xxhash64(*[F.col(c) for c in _STATE]).cast("decimal(20,0)")
    return (actions.where(F.col("date").isNotNull()).groupBy("date")
            .agg(F.concat_ws(":", F.count(F.lit(1)), F.sum(row)).alias("digest")))


def session_states(actions: DataFrame) -> dict[str, DataFrame]:
    """A row per (date, session), and the distinct values of each."""
    acts = actions.where(F.col("session_id").isNotNull())
    return {
        "sessions": acts.groupBy("date", "session_id").agg(
            F.min("user_id").alias("user_id"), F.min("action_time").alias("start_time"),
            F.max("action_time").alias("end_time"), F.count(F.lit(1)).alias("step_length")),
        "values": session_values(actions, by=("date", "session_id")),
    }


def changed_dates(actions: DataFrame, root: str) -> dict[dt.date, str | None]:
    """Dates whose stored states do not stand for ``actions``, with the digest of their log now.

    A date that is stored but has no actions any more is among them, without a digest.
    """
    stored = current(actions.sparkSession, root).select(F.to_date("key").alias("date"), F.col("note").alias("_stored"))
    both = date_digests(actions).join(stored, "date", "full_outer")
    changed = both.where(~F.col("digest").eqNullSafe(F.col("_stored")))
    return {r["date"]: r["digest"] for r in changed.collect()}  # a row per date


def refresh_states(actions: DataFrame, root: str, dates: list[str | dt.date] | None = None) -> list[dt.date]:
    """Rebuild the states of ``dates``, or of those that have changed; returns them.

    Only the actions of these dates are read. All of them appear together.
    """
    if dates is None:
        found = changed_dates(actions, root)
    else:
        wanted = [as_date(d) for d in dates]
        digests = {r["date"]: r["digest"] for r in date_digests(actions.where(F.col("date").isin(wanted))).collect()}
        found = {d: digests.get(d) for d in wanted}
    if found:
        own = actions.where(F.col("date").isin(sorted(found)))
        publish(session_states(own), root, "date", {d.isoformat(): digest for d, digest in found.items()})
    return sorted(found)


def stored_sessions(spark: SparkSession, root: str, start: str | dt.date, end: str | dt.date,
                    max_values: int = MAX_VALUES) -> DataFrame:
    """Session records of a date range from the stored states alone.

    The columns of ``sessions.rollup_sessions``; a list of more than
    ``max_values`` values is NULL (``lists.value_slices`` of the stored values has it).
    """
    inside = F.to_date("key").between(F.lit(as_date(start)), F.lit(as_date(end)))
    merged = (read_published(spark, root, "sessions", "date", inside).groupBy("session_id")
              .agg(F.min("user_id").alias("user_id"), F.min("start_time").alias("start_time"),
                   F.max("end_time").alias("end_time"), F.sum("step_length").alias("step_length"))
              .withColumn("visit_length", seconds_between(F.col("start_time"), F.col("end_time"))))
    values = read_published(spark, root, "values", "date", inside) \
        .select("session_id", "kind", "keyword", "category").distinct()
    records = with_lists(merged, value_slices(values, max_values))
    return records.select("session_id", "user_id", "search_keywords", "click_category_ids", "start_time", "end_time",
                          "visit_length", "step_length")
