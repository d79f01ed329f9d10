"""Which sessions pass which tasks, for many tasks at once.

1. Actions are reduced to one fixed-width row per session and elementary
   interval (``operators.intervals``): at most sessions x intervals rows,
   whatever the number of tasks.
2. A session's rows become one array, with a sparse table of minima and maxima
   over its runs of 1, 2, 4, ... intervals and running sums of its steps. Any
   task's record is then two lookups and a difference.
3. Users are told which tasks they pass once per user: list parameters
   (professions, cities) are rows joined on the value, ages and sexes are
   compared with the tasks' scalars, a literal of the plan.
4. Keyword and category lists are rows too, joined with the values that the
   log met; where lists are long, values first pass a Bloom filter made of
   them, so that little of the log is moved.
5. Only the tasks that a session's user passes are unfolded.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionscope.functions.bloom import bloom_filter
from sessionscope.functions.timefmt import seconds_between
from sessionscope.operators.intervals import Intervals, elementary_intervals
from sessionscope.operators.sessions import actions_in_range
from sessionscope.sources.tables import USER_COLUMNS
from sessionscope.sources.tasks import TaskTable

FEW_INTERVALS = 32  # told by comparing the date; more are joined as a calendar
BLOOM_FROM = 1000  # list values from which the log is filtered before its shuffle


def interval_actions(actions: DataFrame, intervals: Intervals) -> DataFrame:
    """The actions on covered days, with their ``interval``; the scan is bounded by the first and last of them."""
    if intervals.dates is None:
        return actions.where(F.lit(False)).withColumn("interval", F.lit(0))
    inside = actions_in_range(actions.where(F.col("session_id").isNotNull()), *intervals.dates)
    if len(intervals.days) <= FEW_INTERVALS:
        return inside.withColumn("interval", intervals.place(F.col("date"))).where(F.col("interval").isNotNull())
    return inside.join(intervals.calendar(actions.sparkSession), "date")


def session_intervals(acts: DataFrame) -> DataFrame:
    """A row per (session_id, interval): user_id, start_time, end_time, step_length."""
    return acts.groupBy("session_id", "interval").agg(
        F.min("user_id").alias("user_id"), F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"), F.count(F.lit(1)).alias("step_length"))


def _task_literal(table: TaskTable, intervals: Intervals) -> Column:
    rows = [{"i": i, "id": t.task_id, "a": intervals.runs[t.task_id][0], "b": intervals.runs[t.task_id][1],
             "low": t.start_age, "high": t.end_age, "sex": t.sex, **{k: n is not None for k, n in t.sizes.items()}}
            for i, t in enumerate(r for r in table.rows if r.task_id in intervals.runs)]
    kinds = ", ".join(f"{k}: boolean" for k in ("professionals", "cities", "keywords", "category_ids"))
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<i: int, id: bigint, a: int, b: int, low: int, high: int, "
                                                f"sex: string, {kinds}>>")  # folded when planned


def _listed(tasks: Column, held: str, kind: str, task: Column) -> Column:
    """The task has no list of the kind, or is among the tasks in the column ``held``."""
    return ~task[kind] | F.coalesce(F.array_contains(held, task["id"]), F.lit(False))


def users_of_tasks(users: DataFrame, table: TaskTable, tasks: Column) -> DataFrame:
    """Users with ``tasks``: places of the tasks whose user predicates they pass; others are left out."""
    out = users.select(*USER_COLUMNS)
    lists = [k for k in (("professional", "professionals"), ("city", "cities")) if table.has(k[1])]
    for column, kind in lists:
        held = table.by_value(kind).withColumnsRenamed({"value": column, "tasks": f"_{kind}"})
        out = out.join(held, column, "left")

    def passes(t: Column) -> Column:
        age = t["low"].isNull() | t["high"].isNull() | F.coalesce(F.col("age").between(t["low"], t["high"]), F.lit(False))
        found = age & (t["sex"].isNull() | F.coalesce(F.col("sex") == t["sex"], F.lit(False)))
        for _, kind in lists:
            found = found & _listed(tasks, f"_{kind}", kind, t)
        return found

    return (out.withColumn("tasks", F.transform(F.filter(tasks, passes), lambda t: t["i"]))
            .where(F.size("tasks") > 0).drop(*[f"_{kind}" for _, kind in lists]))


_MET = {"keywords": "search_keyword", "category_ids": "click_category_id"}


def sessions_meeting(acts: DataFrame, table: TaskTable, intervals: Intervals) -> DataFrame:
    """(session_id, _<kind>): the tasks of whose lists of a kind a session met a value on a day they cover."""
    kinds = [k for k in _MET if table.has(k)]
    if table.short is not None:
        wanted = acts.sparkSession.createDataFrame(
            [(t, k, v, *intervals.runs[t]) for t, k, v in table.short if k in kinds and t in intervals.runs],
            "task_id long, kind string, value string, a int, b int")
    else:
        wanted = table.lists.where(F.col("kind").isin(kinds)).join(intervals.table(acts.sparkSession), "task_id")
    given = []
    for kind in kinds:
        met = F.col(_MET[kind]).cast("string")
        passes = met.isNotNull()
        if table.size(kind) >= BLOOM_FROM:
            passes = bloom_filter(wanted.where(F.col("kind") == kind), "value")(met)
        given.append(F.when(passes, F.struct(F.lit(kind).alias("kind"), met.alias("value"))))
    met = (acts.select("session_id", "interval", F.explode(F.array_compact(F.array(*given))).alias("m"))
           .select("session_id", "interval", "m.kind", "m.value")
           .join(wanted, ["kind", "value"]).where(F.col("interval").between(F.col("a"), F.col("b"))))
    # at most the number of tasks in a set
    return met.groupBy("session_id").agg(*[F.collect_set(F.when(F.col("kind") == k, F.col("task_id"))).alias(f"_{k}")
                                           for k in kinds])


def _merged(left: Column, right: Column) -> Column:
    return F.struct(F.least(left["start"], right["start"]).alias("start"),
                    F.greatest(left["end"], right["end"]).alias("end"),
                    F.least(left["user"], right["user"]).alias("user"))


def _sparse_table(sessions: DataFrame, most: int) -> DataFrame:
    """Add ``runs``: by level j, the merged states of every 2^j neighbouring parts (at most ``most`` parts)."""
    level = F.transform("parts", lambda p: F.struct(p["start_time"].alias("start"), p["end_time"].alias("end"),
                                                    p["user_id"].alias("user")))
    out, width, names = sessions.withColumn("_level0", level), 1, ["_level0"]
    while 2 * width <= most:
        last, own = F.col(names[-1]), f"_level{len(names)}"
        n = F.greatest(F.size(last) - F.lit(width), F.lit(0))
        out = out.withColumn(own, F.zip_with(F.slice(last, F.lit(1), n), F.slice(last, F.lit(1 + width), n), _merged))
        names.append(own)
        width *= 2
    return out.withColumn("runs", F.array(*names)).drop(*names)


def task_sessions(actions: DataFrame, users: DataFrame, table: TaskTable) -> DataFrame:
    """The sessions of every task that pass its predicates.

    Columns: task_id, session_id, user_id, start_time, end_time, visit_length,
    step_length, age, professional, city, sex. A user listed twice doubles its
    sessions, as in any inner join.
    """
    intervals = elementary_intervals(table.rows)
    tasks = _task_literal(table, intervals)
    acts = interval_actions(actions, intervals)
    so_far = Window.partitionBy("session_id").orderBy("interval").rowsBetween(Window.unboundedPreceding, 0)
    parts = F.struct("interval", "user_id", "start_time", "end_time", F.col("_steps").alias("steps"))
    sessions = (session_intervals(acts).withColumn("_steps", F.sum("step_length").over(so_far))
                .groupBy("session_id").agg(F.array_sort(F.collect_list(parts)).alias("parts")))
    sessions = _sparse_table(sessions, len(intervals.days))
    checks = [kind for kind in _MET if table.has(kind)]
    if checks:
        sessions = sessions.join(sessions_meeting(acts, table, intervals), "session_id", "left")
    # a session belongs to one user; where it does not, to the smallest on the days of the task
    owners = F.array_distinct(F.transform("parts", lambda p: p["user_id"]))
    owned = sessions.select("*", F.explode(owners).alias("user_id")) \
        .join(users_of_tasks(users, table, tasks), "user_id")

    def unfolded(i: Column) -> Column:
        t = tasks[i]
        return F.struct(t["id"].alias("id"),
                        F.size(F.filter("parts", lambda p: p["interval"] < t["a"])).alias("lo"),
                        F.size(F.filter("parts", lambda p: p["interval"] <= t["b"])).alias("hi"))

    def asked(i: Column) -> Column:
        found = F.lit(True)
        for kind in checks:
            found = found & _listed(tasks, f"_{kind}", kind, tasks[i])
        return found

    spans = F.filter(F.transform(F.filter("tasks", asked), unfolded), lambda r: r["hi"] > r["lo"])
    each = owned.select("session_id", "user_id", "parts", "runs", "age", "professional", "city", "sex",
                        F.explode(spans).alias("r"))
    level = F.expr("length(bin(r.hi - r.lo)) - 1")
    run = F.col("runs")[level]
    state = _merged(run[F.col("r.lo")], run[F.expr("r.hi - cast(shiftleft(1, length(bin(r.hi - r.lo)) - 1) as int)")])
    steps = F.expr("parts[r.hi - 1].steps - if(r.lo > 0, parts[r.lo - 1].steps, 0L)")
    return (each.select(F.col("r.id").alias("task_id"), "session_id", "user_id", state.alias("_s"),
                        steps.alias("step_length"), "age", "professional", "city", "sex")
            .where(F.col("_s.user") == F.col("user_id"))
            .select("task_id", "session_id", "user_id", F.col("_s.start").alias("start_time"),
                    F.col("_s.end").alias("end_time"), seconds_between(F.col("_s.start"), F.col("_s.end")).alias("visit_length"),
                    "step_length", "age", "professional", "city", "sex"))
