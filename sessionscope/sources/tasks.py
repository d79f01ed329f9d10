"""Analysis tasks and their parameters.

A task row carries ``task_param``: a JSON object whose values are arrays of
text; only the first element of each array counts, and list-valued
parameters are comma-separated inside it, e.g.
``{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"cities":["c1,c2"]}``.

Parameters are parsed by Spark (``from_json``) into typed columns, so a
table of many tasks is parsed in one pass (see ``operators.multi``); a
single task is that same parse of one row, brought to the driver as a
``TaskParams`` whose values become literals in the query plan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parameter names inside task_param.
PARAM_START_DATE = "startDate"
PARAM_END_DATE = "endDate"
PARAM_START_AGE = "startAge"
PARAM_END_AGE = "endAge"
PARAM_PROFESSIONALS = "professionals"
PARAM_CITIES = "cities"
PARAM_SEX = "sex"
PARAM_KEYWORDS = "keywords"
PARAM_CATEGORY_IDS = "categoryIds"
PARAM_TARGET_PAGE_FLOW = "targetPageFlow"

ALL_PARAMS = (PARAM_START_DATE, PARAM_END_DATE, PARAM_START_AGE, PARAM_END_AGE,
              PARAM_PROFESSIONALS, PARAM_CITIES, PARAM_SEX, PARAM_KEYWORDS,
              PARAM_CATEGORY_IDS, PARAM_TARGET_PAGE_FLOW)

PARAM_MAP_TYPE = "map<string,array<string>>"


@dataclass(frozen=True)
class TaskParams:
    """Typed parameters of one task. ``None`` means the parameter is absent
    and its predicate passes every session; an empty list passes none."""

    start_date: dt.date
    end_date: dt.date
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[int, ...] | None = None
    target_page_flow: tuple[int, ...] | None = None
    task_id: int = 0

    def __post_init__(self):
        if self.start_date is None or self.end_date is None:
            raise ValueError("a task needs both startDate and endDate")

    @classmethod
    def of(cls, start_date, end_date, **kw) -> "TaskParams":
        def tup(v, conv=str):
            if v is None:
                return None
            if isinstance(v, str):
                v = [x for x in v.split(",") if x != ""]
            return tuple(conv(x) for x in v)
        return cls(
            start_date=_as_date(start_date), end_date=_as_date(end_date),
            start_age=kw.get("start_age"), end_age=kw.get("end_age"),
            professionals=tup(kw.get("professionals")), cities=tup(kw.get("cities")),
            sex=kw.get("sex"), keywords=tup(kw.get("keywords")),
            category_ids=tup(kw.get("category_ids"), int),
            target_page_flow=tup(kw.get("target_page_flow"), int),
            task_id=kw.get("task_id", 0),
        )


def _as_date(v) -> dt.date:
    if v is None or isinstance(v, dt.date):
        return v
    return dt.date.fromisoformat(v)


def _first(params: Column, name: str) -> Column:
    """First array element of a parameter; an empty value counts as absent."""
    return F.nullif(F.try_element_at(F.try_element_at(params, F.lit(name)), F.lit(1)), F.lit(""))


def _list(text: Column) -> Column:
    return F.filter(F.split(text, ","), lambda x: x != "")


def task_param_columns(tasks: DataFrame, param_col: str = "task_param") -> DataFrame:
    """Add typed parameter columns and ``param_error`` (NULL when valid).

    Columns: start_date, end_date (date), start_age, end_age (int),
    professionals, cities, keywords (array<string>), sex (string),
    category_ids, target_page_flow (array<bigint>).
    """
    m = F.from_json(F.col(param_col), PARAM_MAP_TYPE)
    tmp = tasks.withColumn("_params", m)
    p = F.col("_params")
    first = {name: _first(p, name) for name in ALL_PARAMS}

    def as_date(c):
        return F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("timestamp_ntz").cast("date")

    def as_longs(c):
        return F.transform(_list(c), lambda x: x.try_cast("bigint"))

    typed = {
        "start_date": as_date(first[PARAM_START_DATE]),
        "end_date": as_date(first[PARAM_END_DATE]),
        "start_age": first[PARAM_START_AGE].try_cast("int"),
        "end_age": first[PARAM_END_AGE].try_cast("int"),
        "professionals": _list(first[PARAM_PROFESSIONALS]),
        "cities": _list(first[PARAM_CITIES]),
        "sex": first[PARAM_SEX],
        "keywords": _list(first[PARAM_KEYWORDS]),
        "category_ids": as_longs(first[PARAM_CATEGORY_IDS]),
        "target_page_flow": as_longs(first[PARAM_TARGET_PAGE_FLOW]),
    }
    checks = [
        F.when(p.isNull(), F.lit("task_param is not a JSON object of arrays")),
        F.when(typed["start_date"].isNull(), F.lit("startDate missing or not yyyy-MM-dd")),
        F.when(typed["end_date"].isNull(), F.lit("endDate missing or not yyyy-MM-dd")),
        F.when(first[PARAM_START_AGE].isNotNull() & typed["start_age"].isNull(), F.lit("startAge not an integer")),
        F.when(first[PARAM_END_AGE].isNotNull() & typed["end_age"].isNull(), F.lit("endAge not an integer")),
        F.when(F.exists(typed["category_ids"], lambda x: x.isNull()), F.lit("categoryIds not integers")),
        F.when(F.exists(typed["target_page_flow"], lambda x: x.isNull()), F.lit("targetPageFlow not integers")),
        F.when(F.exists(F.map_values(p), lambda a: F.size(a) > 1),
               F.lit("a parameter has more than one array element; join values with commas")),
    ]
    return (tmp.withColumns(typed)
            .withColumn("param_error", F.concat_ws("; ", *checks))
            .withColumn("param_error", F.when(F.col("param_error") != "", F.col("param_error")))
            .drop("_params"))


def params_from_row(row) -> TaskParams:
    d = row.asDict()
    if d.get("param_error"):
        raise ValueError(f"task {d.get('task_id')}: {d['param_error']}")

    def opt(v):
        # an absent parameter is NULL; a list without entries (",") matches nothing
        return None if v is None else tuple(v)

    return TaskParams(
        start_date=d["start_date"], end_date=d["end_date"],
        start_age=d["start_age"], end_age=d["end_age"],
        professionals=opt(d["professionals"]), cities=opt(d["cities"]), sex=d["sex"],
        keywords=opt(d["keywords"]), category_ids=opt(d["category_ids"]),
        target_page_flow=opt(d["target_page_flow"]), task_id=d.get("task_id") or 0,
    )


def load_task(tasks: DataFrame, task_id: int) -> TaskParams:
    """Look a task up by id (first matching row) and parse its parameters."""
    rows = task_param_columns(tasks.where(F.col("task_id") == F.lit(task_id))).take(1)
    if not rows:
        raise ValueError(f"no task with id {task_id}")
    return params_from_row(rows[0])


def load_tasks(tasks: DataFrame, task_ids: list[int] | None = None, max_tasks: int = 1000) -> list[TaskParams]:
    """Parse several tasks (all by default) in one read, by id.

    Raises if an id is missing or repeated, a task is invalid, or there are
    more than ``max_tasks``: every task adds expressions to the plan.
    """
    if task_ids is not None:
        tasks = tasks.where(F.col("task_id").isin(task_ids))
    rows = task_param_columns(tasks).orderBy("task_id").limit(max_tasks + 1).collect()
    _check_ids([r["task_id"] for r in rows], task_ids, max_tasks)
    return [params_from_row(r) for r in rows]


SHORT_LIST = 100  # values; a longer list stays in Spark
LIST_KINDS = ("professionals", "cities", "keywords", "category_ids")


@dataclass(frozen=True)
class TaskRow:
    """A task without the values of its lists: only how many each has, None for an absent one."""

    task_id: int
    start_date: dt.date
    end_date: dt.date
    start_age: int | None
    end_age: int | None
    sex: str | None
    target_page_flow: tuple[int, ...] | None
    sizes: dict[str, int | None]


@dataclass(frozen=True)
class TaskTable:
    """Tasks as data: their scalars on the driver, list values as rows (task_id, kind, value)."""

    rows: list[TaskRow]
    lists: DataFrame
    short: list[tuple[int, str, str]] | None = None  # the same rows where all lists are short

    def has(self, kind: str) -> bool:
        return any(r.sizes[kind] is not None for r in self.rows)

    def size(self, kind: str) -> int:
        return sum(r.sizes[kind] or 0 for r in self.rows)

    def by_value(self, kind: str) -> DataFrame:
        """(value, tasks): which tasks list a value of one kind."""
        if self.short is not None:
            held: dict[str, list[int]] = {}
            for task_id, own, value in self.short:
                if own == kind:
                    held.setdefault(value, []).append(task_id)
            return self.lists.sparkSession.createDataFrame(list(held.items()), "value string, tasks array<long>")
        return (self.lists.where(F.col("kind") == kind).groupBy("value")
                .agg(F.collect_set("task_id").alias("tasks")))


def task_table(tasks: DataFrame, task_ids: list[int] | None = None, max_tasks: int = 1000) -> TaskTable:
    """Parse several tasks whose lists may be long: long lists never come to the driver or into a plan.

    Raises like ``load_tasks``.
    """
    if task_ids is not None:
        tasks = tasks.where(F.col("task_id").isin(task_ids))
    typed = task_param_columns(tasks)
    size = {k: F.when(F.col(k).isNotNull(), F.size(k)) for k in LIST_KINDS}
    few = [F.when(size[k] <= SHORT_LIST, F.col(k).cast("array<string>")).alias(f"_{k}") for k in LIST_KINDS]
    rows = typed.select("task_id", "start_date", "end_date", "start_age", "end_age", "sex", "target_page_flow",
                        "param_error", *[size[k].alias(k) for k in LIST_KINDS], *few) \
        .orderBy("task_id").limit(max_tasks + 1).collect()
    _check_ids([r["task_id"] for r in rows], task_ids, max_tasks)
    for r in rows:
        if r["param_error"]:
            raise ValueError(f"task {r['task_id']}: {r['param_error']}")
    if all(r[k] is None or r[k] <= SHORT_LIST for r in rows for k in LIST_KINDS):
        short = sorted({(r["task_id"], k, v) for r in rows for k in LIST_KINDS for v in r[f"_{k}"] or ()})
        lists = tasks.sparkSession.createDataFrame(short, "task_id long, kind string, value string")
    else:
        short = None
        lists = typed.select("task_id", F.explode(F.array(*[
            F.struct(F.lit(k).alias("kind"), F.col(k).cast("array<string>").alias("values")) for k in LIST_KINDS]))
            .alias("l")).select("task_id", "l.kind", F.explode("l.values").alias("value")).distinct()
    return TaskTable([TaskRow(r["task_id"], r["start_date"], r["end_date"], r["start_age"], r["end_age"], r["sex"],
                              tuple(r["target_page_flow"]) if r["target_page_flow"] is not None else None,
                              {k: r[k] for k in LIST_KINDS}) for r in rows], lists, short)


def _check_ids(found: list, task_ids: list[int] | None, max_tasks: int) -> None:
    if len(found) > max_tasks:
        raise ValueError(f"more than {max_tasks} tasks in one job")
    missing = sorted(set(task_ids or ()) - set(found))
    if missing:
        raise ValueError(f"no task with id {', '.join(map(str, missing))}")
    if None in found or len(set(found)) < len(found):
        raise ValueError("task ids must be given and unique: "
                         + ", ".join(sorted({str(t) for t in found if t is None or found.count(t) > 1})))


def task_ids_from_text(text: str) -> list[int]:
    """Task ids of a job argument: one, or several separated by commas."""
    parts = [p.strip() for p in text.split(",") if p.strip()]
    if not parts:
        raise ValueError("a job needs a task id")
    try:
        ids = [int(p) for p in parts]
    except ValueError as exc:
        raise ValueError(f"task ids must be integers, got {text!r}") from exc
    return list(dict.fromkeys(ids))
