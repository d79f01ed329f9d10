"""Registered queries over the driver's test tables, each with a DuckDB
oracle that computes the same result independently in SQL.

Every query reads whole tables (``events``, ``customer``, ``nation``)
through the adapters of ``sources.testdata``. Results are rendered to plain
types (text dates, times and lists) so the two engines compare value for
value; column names match between each query and its oracle.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionscope.functions.buckets import STEP_BUCKETS, VISIT_BUCKETS
from sessionscope.functions.timefmt import format_action_time, format_date, format_time
from sessionscope.operators.sessions import (
    actions_in_range, render_lists, rollup_sessions, session_records,
)
from sessionscope.operators.stats import bucket_counts, session_aggr_stat
from sessionscope.functions.records import decode_sessions, encode_sessions
from sessionscope.operators.extract import random_extract, session_detail
from sessionscope.operators.flow import page_flow_conversion
from sessionscope.operators.lists import rollup_any_size, session_values, value_slices
from sessionscope.operators.multi import multi_task_stat
from sessionscope.operators.rollups import (
    action_gaps, actions_around, actions_per_minute, daily_rollup, sessions_per_hour,
)
from sessionscope.operators.states import refresh_states, stored_sessions
from sessionscope.operators.task_sessions import task_sessions
from sessionscope.operators.topn import counts_of_sessions, top_categories, top_sessions_per_category
from sessionscope.plans.job import filtered_sessions
from sessionscope.plans.outputs import all_outputs
from sessionscope.session import ensure_checkpoint_dir
from sessionscope.sources.published import publish, read_published, write_run
from sessionscope.sources.sinks import read_action_log, save_action_log
from sessionscope.sources.tables import normalize_actions
from sessionscope.sources.tasks import TaskParams, task_table
from sessionscope.sources.testdata import USERS_SQL, actions_sql, load_actions, load_users

# ---------------------------------------------------------------- tasks --
# The month the test tables cover, and the parameters of the filter queries.
MONTH = TaskParams.of("2024-01-01", "2024-01-31", task_id=1)
STAT_CLOCKS = ("minute", "hour", "month")    # every bucket holds sessions under one of them
TWO_WEEKS = TaskParams.of("2024-01-08", "2024-01-21", task_id=2)
FILTER_TASKS: dict[str, TaskParams] = {
    "filter_age": TaskParams.of("2024-01-01", "2024-01-31", start_age=25, end_age=40),
    "filter_professional": TaskParams.of("2024-01-01", "2024-01-31", professionals="BUILDING,FURNITURE"),
    "filter_city": TaskParams.of("2024-01-01", "2024-01-31",
                                 cities="NATION_1,NATION_3,NATION_5,NATION_7,NATION_11,NATION_13"),
    "filter_sex": TaskParams.of("2024-01-01", "2024-01-31", sex="female"),
    "filter_keywords": TaskParams.of("2024-01-01", "2024-01-31",
                                     keywords="kw1,kw2,kw3,kw5,kw8,kw13,kw21,kw34,kw55,kw89"),
    "filter_categories": TaskParams.of("2024-01-01", "2024-01-31",
                                       category_ids="0,7,14,21,28,35,42,49,56,63,70,77,84,91,98"),
    "filter_all": TaskParams.of(
        "2024-01-03", "2024-01-28", start_age=20, end_age=60,
        professionals="BUILDING,FURNITURE,MACHINERY,AUTOMOBILE",
        cities=",".join(f"NATION_{i}" for i in range(0, 25, 2)), sex="male",
        keywords=",".join(f"kw{i}" for i in range(0, 100, 2)),
        category_ids=",".join(str(i) for i in range(0, 100, 3)), task_id=3),
}


# ------------------------------------------------------------ spark side --
def _actions(spark, sf, p: TaskParams | None = None, clock="minute"):
    acts = load_actions(spark, sf, clock)
    return acts if p is None else actions_in_range(acts, p.start_date, p.end_date)


def _render_actions(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "date": format_date(F.col("date")),
        "action_time": format_time(F.col("action_time")),
    })


def q_actions_by_date(spark, sf):
    return _render_actions(_actions(spark, sf, TWO_WEEKS))


def q_session_rollup(spark, sf):
    return render_lists(rollup_sessions(_actions(spark, sf, MONTH)))


def q_session_user_join(spark, sf):
    return render_lists(session_records(_actions(spark, sf, MONTH), load_users(spark, sf)))


def _filter_query(name):
    def q(spark, sf):
        p = FILTER_TASKS[name]
        return render_lists(filtered_sessions(_actions(spark, sf), load_users(spark, sf), p))
    q.__name__ = f"q_{name}"
    return q


def q_session_counts(spark, sf):
    p = FILTER_TASKS["filter_all"]
    return bucket_counts(filtered_sessions(_actions(spark, sf), load_users(spark, sf), p))


def _histogram(kind: str, buckets):
    """The histogram under every clock; together they fill all buckets."""
    def q(spark, sf):
        users = load_users(spark, sf)
        pairs = ", ".join(f"'{b.name}', `{kind}_{b.name}`" for b in buckets)
        parts = [bucket_counts(session_records(_actions(spark, sf, MONTH, clock), users))
                 .selectExpr(f"'{clock}' AS clock", f"stack({len(buckets)}, {pairs}) AS (bucket, sessions)")
                 for clock in STAT_CLOCKS]
        return reduce(DataFrame.unionByName, parts)
    return q


def q_session_aggr_stat(spark, sf):
    """The flagship statistics, one task per clock."""
    users = load_users(spark, sf)
    parts = [session_aggr_stat(filtered_sessions(_actions(spark, sf, clock=clock), users, MONTH), task_id)
             for task_id, clock in enumerate(STAT_CLOCKS, start=1)]
    return reduce(DataFrame.unionByName, parts)


# ----------------------------------------------------------- oracle side --
def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _q(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def uva_cte(clock="minute") -> str:
    return f"uva AS ({actions_sql(clock)})"


USERS_CTE = f"users AS ({USERS_SQL})"


def sessions_cte(p: TaskParams | None) -> str:
    where = "session_id IS NOT NULL"
    if p is not None:
        where += f" AND date BETWEEN {_d(p.start_date)} AND {_d(p.end_date)}"
    return f"""sessions AS (
      SELECT session_id, min(user_id) AS user_id,
             coalesce(list_sort(list(DISTINCT search_keyword)
                      FILTER (WHERE search_keyword IS NOT NULL AND search_keyword <> '')), []) AS search_keywords,
             coalesce(list_sort(list(DISTINCT click_category_id)
                      FILTER (WHERE click_category_id IS NOT NULL)), []) AS click_category_ids,
             min(action_time) AS start_time, max(action_time) AS end_time,
             date_diff('second', min(action_time), max(action_time)) AS visit_length,
             count(*) AS step_length
      FROM uva WHERE {where} GROUP BY session_id)"""


RECORDS_CTE = """records AS (
      SELECT s.session_id, s.user_id, s.search_keywords, s.click_category_ids, s.start_time,
             s.end_time, s.visit_length, s.step_length, u.age, u.professional, u.city, u.sex
      FROM sessions s JOIN users u ON s.user_id = u.user_id)"""

RENDERED_RECORD = """session_id, user_id, array_to_string(search_keywords, ',') AS search_keywords,
       array_to_string(click_category_ids, ',') AS click_category_ids,
       strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
       strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time, visit_length, step_length"""


def where_sql(p: TaskParams) -> str:
    conds = []
    if p.start_age is not None and p.end_age is not None:
        conds.append(f"age BETWEEN {p.start_age} AND {p.end_age}")
    if p.professionals:
        conds.append(f"professional IN ({_q(p.professionals)})")
    if p.cities:
        conds.append(f"city IN ({_q(p.cities)})")
    if p.sex is not None:
        conds.append(f"sex = {_q([p.sex])}")
    if p.keywords:
        conds.append(f"list_has_any(search_keywords, [{_q(p.keywords)}])")
    if p.category_ids:
        conds.append(f"list_has_any(click_category_ids, CAST([{', '.join(map(str, p.category_ids))}] AS BIGINT[]))")
    return " AND ".join(conds) or "TRUE"


def with_sql(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def filtered_cte(p: TaskParams) -> str:
    return f"filtered AS (SELECT * FROM records WHERE {where_sql(p)})"


# The buckets' edges as the statistics define them, written out
# here so that the oracle does not depend on the library's own table.
VISIT_EDGES_SQL = {
    "1s_3s": "visit_length >= 1 AND visit_length <= 3",
    "4s_6s": "visit_length >= 4 AND visit_length <= 6",
    "7s_9s": "visit_length >= 7 AND visit_length <= 9",
    "10s_30s": "visit_length >= 10 AND visit_length <= 30",
    "30s_60s": "visit_length > 30 AND visit_length <= 60",
    "1m_3m": "visit_length > 60 AND visit_length <= 180",
    "3m_10m": "visit_length > 180 AND visit_length <= 600",
    "10m_30m": "visit_length > 600 AND visit_length <= 1800",
    "30m": "visit_length > 1800",
}
STEP_EDGES_SQL = {
    "1_3": "step_length >= 1 AND step_length <= 3",
    "4_6": "step_length >= 4 AND step_length <= 6",
    "7_9": "step_length >= 7 AND step_length <= 9",
    "10_30": "step_length >= 10 AND step_length <= 30",
    "30_60": "step_length > 30 AND step_length <= 60",
    "60": "step_length > 60",
}
COUNTS_SELECT = ", ".join(
    ["count(*) AS session_count"]
    + [f"count(*) FILTER (WHERE {e}) AS visit_{b}" for b, e in VISIT_EDGES_SQL.items()]
    + [f"count(*) FILTER (WHERE {e}) AS step_{b}" for b, e in STEP_EDGES_SQL.items()]
)


def half_up_sql(part: str, total: str) -> str:
    """DuckDB: the double ``part / total`` rounded half-up by its exact binary value.

    From 2**-8 on a double below 2**40 times 2**60 is an exact integer, so the
    rounding is integer arithmetic; anything smaller rounds to 0.
    """
    q = f"(CAST({part} AS DOUBLE) / CAST({total} AS DOUBLE))"
    one = 1 << 60
    exact = f"((CAST({q} * {one}.0::DOUBLE AS HUGEINT) * 200 + {one}) // {2 * one})"
    return (f"CASE WHEN {total} = 0 THEN NULL WHEN {q} < 0.00390625 THEN 0.0::DOUBLE "
            f"ELSE CAST({exact} AS DOUBLE) / 100.0::DOUBLE END")


def _stat_sql(p: TaskParams, clock="minute", task_id=None) -> str:
    ratios = [f"{half_up_sql(f'visit_{b}', 'session_count')} AS visit_length_{b}_ratio" for b in VISIT_EDGES_SQL]
    ratios += [f"{half_up_sql(f'step_{b}', 'session_count')} AS step_length_{b}_ratio" for b in STEP_EDGES_SQL]
    return with_sql(uva_cte(clock), USERS_CTE, sessions_cte(p), RECORDS_CTE, filtered_cte(p),
                    f"counts AS (SELECT {COUNTS_SELECT} FROM filtered)",
                    body=f"SELECT CAST({task_id or p.task_id} AS BIGINT) AS task_id, session_count, "
                         f"{', '.join(ratios)} FROM counts")


def _histogram_sql(kind: str, edges) -> str:
    parts = []
    for clock in STAT_CLOCKS:
        rows = " UNION ALL ".join(f"SELECT '{clock}' AS clock, '{b}' AS bucket, {kind}_{b} AS sessions FROM counts"
                                  for b in edges)
        parts.append(with_sql(uva_cte(clock), USERS_CTE, sessions_cte(MONTH), RECORDS_CTE,
                              f"counts AS (SELECT {COUNTS_SELECT} FROM records)", body=rows))
    return _union_sql(parts)


def _union_sql(parts) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({x})" for x in parts)


ACTION_COLUMNS_SQL = """action_id, strftime(date, '%Y-%m-%d') AS date, user_id, session_id, page_id,
       strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time, search_keyword,
       click_category_id, click_product_id, order_category_ids, order_product_ids,
       pay_category_ids, pay_product_ids"""


def _oracles() -> dict[str, str]:
    o = {
        "actions_by_date": with_sql(uva_cte(), body=f"SELECT {ACTION_COLUMNS_SQL} FROM uva "
                                    f"WHERE date BETWEEN {_d(TWO_WEEKS.start_date)} AND {_d(TWO_WEEKS.end_date)}"),
        "session_rollup": with_sql(uva_cte(), sessions_cte(MONTH), body=f"SELECT {RENDERED_RECORD} FROM sessions"),
        "session_user_join": with_sql(uva_cte(), USERS_CTE, sessions_cte(MONTH), RECORDS_CTE,
                                      body=f"SELECT {RENDERED_RECORD}, age, professional, city, sex FROM records"),
        "session_counts": with_sql(uva_cte(), USERS_CTE, sessions_cte(FILTER_TASKS["filter_all"]), RECORDS_CTE,
                                   filtered_cte(FILTER_TASKS["filter_all"]),
                                   body=f"SELECT {COUNTS_SELECT} FROM filtered"),
        "visit_histogram": _histogram_sql("visit", VISIT_EDGES_SQL),
        "step_histogram": _histogram_sql("step", STEP_EDGES_SQL),
        "session_aggr_stat": _union_sql([_stat_sql(MONTH, clock, i) for i, clock in enumerate(STAT_CLOCKS, start=1)]),
    }
    for name, p in FILTER_TASKS.items():
        o[name] = with_sql(uva_cte(), USERS_CTE, sessions_cte(p), RECORDS_CTE, filtered_cte(p),
                           body=f"SELECT {RENDERED_RECORD}, age, professional, city, sex FROM filtered")
    return o


# ------------------------------------------------ further operations --
TOP_TASK = TaskParams.of("2024-01-01", "2024-01-31", start_age=20, end_age=55, task_id=4)
EXTRACT_PER_DAY = 20
EXTRACT_SEED = "sessionscope"
PAGE_FLOW = (1, 2, 3, 4, 5, 6, 7)
TASK_ROWS = (
    (11, '{"startDate":["2024-01-01"],"endDate":["2024-01-31"]}'),
    (12, '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"startAge":["20"],"endAge":["40"],'
         '"sex":["female"]}'),
    (13, '{"startDate":["2024-01-10"],"endDate":["2024-01-30"],"professionals":["BUILDING,MACHINERY"],'
         '"cities":["NATION_2,NATION_4,NATION_6,NATION_8"],"keywords":["kw1,kw2,kw3,kw4,kw5,kw6,kw7"]}'),
    (14, '{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"categoryIds":["5,15,25,35"],"startAge":["30"]}'),
    (15, '{"startDate":["2025-03-01"],"endDate":["2025-03-07"]}'),
)


def _task_params_from_json(task_id: int, text: str) -> TaskParams:
    """Oracle-side reading of a task row (plain Python json)."""
    d = {k: v[0] for k, v in json.loads(text).items()}
    return TaskParams.of(
        d["startDate"], d["endDate"],
        start_age=int(d["startAge"]) if "startAge" in d else None,
        end_age=int(d["endAge"]) if "endAge" in d else None,
        professionals=d.get("professionals"), cities=d.get("cities"), sex=d.get("sex"),
        keywords=d.get("keywords"), category_ids=d.get("categoryIds"), task_id=task_id)


def q_user_info(spark, sf):
    return load_users(spark, sf)


def q_raw_action_log(spark, sf):
    """Actions written as the raw text log and read back: one-digit hours, and
    for some actions one-digit fields throughout or milliseconds."""
    acts = load_actions(spark, sf, "second")
    text, way = format_action_time(F.col("action_time")), F.col("action_id") % 3
    short = F.regexp_replace(text, "(?<=[- :])0(?=[0-9])", "")
    raw = acts.withColumns({
        "date": format_date(F.col("date")),
        "action_time": F.when(way == 0, text).when(way == 1, short).otherwise(F.concat(text, F.lit(".123"))),
    })
    return _render_actions(normalize_actions(raw))


def q_decode_session_records(spark, sf):
    records = render_lists(session_records(_actions(spark, sf, MONTH), load_users(spark, sf)))
    return decode_sessions(encode_sessions(records))


def q_action_gaps(spark, sf):
    gaps = action_gaps(_actions(spark, sf, MONTH, clock="second"), keep=[])
    return gaps.select("action_id", "session_id",
                       format_time(F.col("action_time")).alias("action_time"),
                       format_time(F.col("prev_action_time")).alias("prev_action_time"),
                       "gap_seconds")


def _real_sessions(spark, sf, p=MONTH):
    return filtered_sessions(_actions(spark, sf, clock="second"), load_users(spark, sf), p)


def q_sessions_per_hour(spark, sf):
    return sessions_per_hour(_real_sessions(spark, sf))


def q_actions_per_minute(spark, sf):
    return actions_per_minute(_actions(spark, sf, MONTH, clock="second"))


def q_actions_around_noon(spark, sf):
    """Actions of each session before and after noon of the action's day."""
    noon = F.col("date").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")
    return actions_around(_actions(spark, sf, MONTH, clock="second"), noon)


def q_daily_rollup(spark, sf):
    return daily_rollup(_real_sessions(spark, sf))


def _top_counts(spark, sf):
    acts = _actions(spark, sf, TOP_TASK)
    return counts_of_sessions(acts, filtered_sessions(acts, load_users(spark, sf), TOP_TASK))


def q_top10_category(spark, sf):
    return top_categories(_top_counts(spark, sf), 10)


def q_top10_category_session(spark, sf):
    counts = _top_counts(spark, sf)
    return top_sessions_per_category(counts, top_categories(counts, 10), 10).withColumn(
        "rank", F.col("rank").cast("long"))


def _extracted(spark, sf):
    return random_extract(_real_sessions(spark, sf), EXTRACT_PER_DAY, EXTRACT_SEED)


def q_session_random_extract(spark, sf):
    ex = _extracted(spark, sf)
    return render_lists(ex).select("session_id", "start_time", "end_time", "search_keywords", "date_hour",
                                   F.col("rank").cast("long").alias("rank"), F.col("quota").cast("long").alias("quota"))


def q_session_detail(spark, sf):
    acts = _actions(spark, sf, MONTH, clock="second")
    return _render_actions(session_detail(acts, _extracted(spark, sf)))


def q_page_flow_conversion(spark, sf):
    return page_flow_conversion(_actions(spark, sf, MONTH, clock="second"), PAGE_FLOW)


def task_table_rows(spark):
    return _tasks(spark, TASK_ROWS)


def q_multi_task_stat(spark, sf):
    return multi_task_stat(load_actions(spark, sf, "minute"), load_users(spark, sf), task_table_rows(spark))


# ------------------------------------------- stored and many-task forms --
def _folder(spark, name):
    """A new folder in the cluster's shared one."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _tasks(spark, rows):
    return spark.createDataFrame([(tid, f"task{tid}", txt) for tid, txt in rows],
                                 "task_id long, task_name string, task_param string")


def q_stored_session_states(spark, sf):
    """States by date, from a log that had half of a day at first; then that day is replaced and a range merged."""
    acts, root = _actions(spark, sf, clock="hour"), _folder(spark, "states")
    late = (F.col("date") == F.lit(dt.date(2024, 1, 10))) & (F.col("action_id") % 2 == 0)
    refresh_states(acts.where(~late), root)
    refresh_states(acts, root)
    return render_lists(stored_sessions(spark, root, TWO_WEEKS.start_date, TWO_WEEKS.end_date))


LIST_SIZE = 50


def _hot_actions(spark, sf):
    """A third of all actions in one session, whose keywords grow with the log."""
    hot = F.col("action_id") % 3 == 0
    keyword = F.concat_ws("-", "search_keyword", F.expr("CAST(action_id div 10 AS STRING)"))
    return _actions(spark, sf, clock="month").withColumns({
        "session_id": F.when(hot, "hot").otherwise(F.col("session_id")),
        "search_keyword": F.when(hot & F.col("search_keyword").isNotNull(), keyword).otherwise(F.col("search_keyword"))})


def q_session_list_slices(spark, sf):
    slices = value_slices(session_values(_hot_actions(spark, sf)), LIST_SIZE)
    return slices.withColumn("values", F.array_join("values", ","))


def q_session_rollup_any_size(spark, sf):
    sessions, _ = rollup_any_size(_hot_actions(spark, sf), LIST_SIZE)
    return render_lists(sessions)


def many_tasks(n: int = 200) -> list[dict]:
    """Overlapping, nested and empty tasks with every kind of parameter, by formula."""
    out = []
    for i in range(n):
        start = dt.date(2024, 1, 1) + dt.timedelta(days=i * 7 % 30)
        out.append({"task_id": 1000 + i, "start": start, "end": start + dt.timedelta(days=i * 5 % 13 - 1),
                    "age": (18 + i % 20, 45 + i % 20) if i % 3 == 0 else None, "sex": (None, "male", None, "female")[i % 4],
                    "professionals": ["BUILDING", "MACHINERY"] if i % 6 == 0 else None,
                    "cities": [f"NATION_{k}" for k in range(i % 5, 25, 2)] if i % 9 == 0 else None,
                    "keywords": [f"kw{k}" for k in range(i % 10, 100, 10)] if i % 5 == 0 else None,
                    "categories": list(range(i % 7, 100, 7)) if i % 7 == 0 else None})
    return out


def _as_json(t: dict) -> str:
    p = {"startDate": [t["start"].isoformat()], "endDate": [t["end"].isoformat()]}
    if t["age"]:
        p |= {"startAge": [str(t["age"][0])], "endAge": [str(t["age"][1])]}
    if t["sex"]:
        p["sex"] = [t["sex"]]
    for key, name in (("professionals",) * 2, ("cities",) * 2, ("keywords",) * 2, ("categories", "categoryIds")):
        if t[key] is not None:
            p[name] = [",".join(map(str, t[key]))]
    return json.dumps(p)


def q_many_task_stat(spark, sf):
    tasks = _tasks(spark, [(t["task_id"], _as_json(t)) for t in many_tasks()])
    return multi_task_stat(load_actions(spark, sf, "hour"), load_users(spark, sf), tasks)


LONG_LIST = 100_000


def q_filter_long_lists(spark, sf):
    """One task whose keyword, category and city lists have 100,000 entries each."""
    task = {"startDate": ["2024-01-02"], "endDate": ["2024-01-29"],
            "keywords": [",".join(f"kw{3 * i}" for i in range(LONG_LIST))],
            "categoryIds": [",".join(str(7 * i) for i in range(LONG_LIST))],
            "cities": [",".join(f"NATION_{2 * i}" for i in range(LONG_LIST))]}
    table = task_table(_tasks(spark, [(21, json.dumps(task))]))
    found = task_sessions(load_actions(spark, sf, "hour"), load_users(spark, sf), table)
    return render_lists(found)


def q_bucketed_session_rollup(spark, sf):
    """The log stored by date and session bucket, and rolled up from there."""
    table = f"action_log_{uuid.uuid4().hex}"
    save_action_log(_actions(spark, sf), table, buckets=8, path=_folder(spark, "action-log"))
    return render_lists(rollup_sessions(actions_in_range(read_action_log(spark, table), TWO_WEEKS.start_date,
                                                         TWO_WEEKS.end_date)))


def q_published_task_stat(spark, sf):
    """Statistics of five tasks, published again behind an earlier publication and a run that died."""
    acts, users, root = load_actions(spark, sf, "minute"), load_users(spark, sf), _folder(spark, "published")
    ids = [tid for tid, _ in TASK_ROWS]
    stats = multi_task_stat(acts, users, task_table_rows(spark)).checkpoint(eager=True)
    other = stats.withColumn("session_count", F.col("session_count") + 1)
    publish({"session_aggr_stat": other}, root, "task_id", ids)
    write_run({"session_aggr_stat": other}, root, "task_id")
    publish({"session_aggr_stat": stats}, root, "task_id", ids)
    return read_published(spark, root, "session_aggr_stat", "task_id")


def q_published_top_categories(spark, sf):
    """The top categories of five tasks, published with the top sessions and read back."""
    root = _folder(spark, "published")
    found = all_outputs(load_actions(spark, sf, "minute"), load_users(spark, sf), task_table(task_table_rows(spark)),
                        names=("top10_category", "top10_category_session"))
    publish(found, root, "task_id", [tid for tid, _ in TASK_ROWS])
    return read_published(spark, root, "top10_category", "task_id")


# ------------------------------------------------ further oracles --
def _sessions_body(p, clock):
    return [uva_cte(clock), USERS_CTE, sessions_cte(p), RECORDS_CTE, filtered_cte(p)]


CATEGORY_COUNTS_CTE = """ce AS (
      SELECT session_id, click_category_id AS category_id, 'click' AS kind FROM uva_r WHERE click_category_id IS NOT NULL
      UNION ALL
      SELECT session_id, TRY_CAST(trim(x) AS BIGINT), 'order' FROM
        (SELECT session_id, unnest(string_split(order_category_ids, ',')) AS x FROM uva_r) WHERE trim(x) <> ''
      UNION ALL
      SELECT session_id, TRY_CAST(trim(x) AS BIGINT), 'pay' FROM
        (SELECT session_id, unnest(string_split(pay_category_ids, ',')) AS x FROM uva_r) WHERE trim(x) <> ''),
    counts AS (
      SELECT session_id, category_id,
             count(*) FILTER (WHERE kind = 'click') AS click_count,
             count(*) FILTER (WHERE kind = 'order') AS order_count,
             count(*) FILTER (WHERE kind = 'pay') AS pay_count
      FROM ce WHERE category_id IS NOT NULL AND session_id IN (SELECT session_id FROM filtered)
      GROUP BY session_id, category_id),
    top AS (
      SELECT category_id, CAST(sum(click_count) AS BIGINT) AS click_count,
             CAST(sum(order_count) AS BIGINT) AS order_count, CAST(sum(pay_count) AS BIGINT) AS pay_count
      FROM counts GROUP BY category_id
      ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id ASC LIMIT 10)"""


def _range_cte(name, p):
    return f"{name} AS (SELECT * FROM uva WHERE date BETWEEN {_d(p.start_date)} AND {_d(p.end_date)})"


def _extract_ctes():
    p = MONTH
    return _sessions_body(p, "second") + [f"""keyed AS (
      SELECT *, strftime(start_time, '%Y-%m-%d_%H') AS date_hour, strftime(start_time, '%Y-%m-%d') AS day,
             md5(session_id || '{EXTRACT_SEED}') AS rank_key FROM filtered)""",
        """hours AS (SELECT date_hour, day, count(*) AS hour_n FROM keyed GROUP BY date_hour, day)""",
        f"""quotas AS (SELECT date_hour, CAST(greatest(1, ({EXTRACT_PER_DAY} * hour_n) //
             sum(hour_n) OVER (PARTITION BY day)) AS BIGINT) AS quota FROM hours)""",
        """ranked AS (SELECT *, row_number() OVER (PARTITION BY date_hour ORDER BY rank_key, session_id) AS rank
             FROM keyed)""",
        """extracted AS (SELECT r.*, q.quota FROM ranked r JOIN quotas q USING (date_hour) WHERE r.rank <= q.quota)"""]


def _flow_sql():
    steps = list(zip(PAGE_FLOW[:-1], PAGE_FLOW[1:]))
    counted = ", ".join([f"count(*) FILTER (WHERE page_id = {PAGE_FLOW[0]}) AS first_page_views"]
                        + [f"count(*) FILTER (WHERE prev_page_id = {a} AND page_id = {b}) AS t{i}"
                           for i, (a, b) in enumerate(steps, start=1)])
    rows = " UNION ALL ".join(
        f"SELECT {i} AS step, '{a}_{b}' AS page_pair, t{i} AS transitions, "
        f"{'first_page_views' if i == 1 else f't{i - 1}'} AS base FROM counted"
        for i, (a, b) in enumerate(steps, start=1))
    return with_sql(
        uva_cte("second"), _range_cte("uva_r", MONTH),
        """pairs AS (SELECT page_id, lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, action_id)
                     AS prev_page_id FROM uva_r WHERE session_id IS NOT NULL)""",
        f"counted AS (SELECT {counted} FROM pairs)", f"steps AS ({rows})",
        body=f"SELECT CAST(step AS INTEGER) AS step, page_pair, transitions, base, "
             f"{half_up_sql('transitions', 'base')} AS conversion_rate FROM steps")


def _multi_sql():
    return _union_sql([_stat_sql(_task_params_from_json(tid, text)) for tid, text in TASK_ROWS])


def _many_sql() -> str:
    def listed(values) -> str:
        return "NULL" if values is None else f"[{_q(values)}]"

    rows = ", ".join(
        f"({t['task_id']}, {_d(t['start'])}, {_d(t['end'])}, {t['age'][0] if t['age'] else 'NULL'}, "
        f"{t['age'][1] if t['age'] else 'NULL'}, {_q([t['sex']]) if t['sex'] else 'NULL'}, {listed(t['professionals'])}, "
        f"{listed(t['cities'])}, {listed(t['keywords'])}, {listed(t['categories'])})" for t in many_tasks())
    ratios = [f"{half_up_sql(f'visit_{b}', 'session_count')} AS visit_length_{b}_ratio" for b in VISIT_EDGES_SQL]
    ratios += [f"{half_up_sql(f'step_{b}', 'session_count')} AS step_length_{b}_ratio" for b in STEP_EDGES_SQL]
    counts = COUNTS_SELECT.replace("count(*) AS session_count", "count(session_id) AS session_count")
    return with_sql(
        uva_cte("hour"), USERS_CTE,
        f"tasks AS (SELECT * FROM (VALUES {rows}) t(task_id, s, e, lo, hi, tsex, profs, towns, kws, cats))",
        """each AS (
          SELECT task_id, session_id, min(user_id) AS user_id, count(*) AS step_length,
                 date_diff('second', min(action_time), max(action_time)) AS visit_length,
                 list(DISTINCT search_keyword) FILTER (WHERE search_keyword <> '') AS ks,
                 list(DISTINCT CAST(click_category_id AS VARCHAR)) FILTER (WHERE click_category_id IS NOT NULL) AS cs
          FROM tasks JOIN uva ON date BETWEEN s AND e WHERE session_id IS NOT NULL GROUP BY task_id, session_id)""",
        """passed AS (
          SELECT each.* FROM each JOIN tasks USING (task_id) JOIN users USING (user_id)
          WHERE (lo IS NULL OR age BETWEEN lo AND hi) AND (tsex IS NULL OR sex = tsex)
            AND (profs IS NULL OR list_contains(profs, professional)) AND (towns IS NULL OR list_contains(towns, city))
            AND (kws IS NULL OR list_has_any(coalesce(ks, []), kws))
            AND (cats IS NULL OR list_has_any(coalesce(cs, []), cats)))""",
        f"counts AS (SELECT task_id, {counts} FROM tasks LEFT JOIN passed USING (task_id) GROUP BY task_id)",
        body=f"SELECT CAST(task_id AS BIGINT) AS task_id, session_count, {', '.join(ratios)} FROM counts")


HOT_CTE = """hot AS (
      SELECT * REPLACE (
        CASE WHEN action_id % 3 = 0 THEN 'hot' ELSE session_id END AS session_id,
        CASE WHEN action_id % 3 = 0 AND search_keyword IS NOT NULL
             THEN search_keyword || '-' || CAST(action_id // 10 AS VARCHAR) ELSE search_keyword END AS search_keyword)
      FROM uva)"""


def _slices_sql() -> str:
    return with_sql(uva_cte("month"), HOT_CTE, """met AS (
          SELECT DISTINCT session_id, 'keyword' AS kind, search_keyword AS k, CAST(NULL AS BIGINT) AS c FROM hot
          WHERE search_keyword <> ''
          UNION ALL SELECT DISTINCT session_id, 'category', NULL, click_category_id FROM hot
          WHERE click_category_id IS NOT NULL)""",
        """ranked AS (SELECT *, row_number() OVER (PARTITION BY session_id, kind ORDER BY k, c) - 1 AS r,
             count(*) OVER (PARTITION BY session_id, kind) AS n FROM met)""",
        body=f"""SELECT session_id, kind, CAST(r // {LIST_SIZE} AS INTEGER) AS slice,
             CAST((min(n) + {LIST_SIZE - 1}) // {LIST_SIZE} AS INTEGER) AS slices,
             string_agg(coalesce(k, CAST(c AS VARCHAR)), ',' ORDER BY r) AS values
             FROM ranked GROUP BY session_id, kind, r // {LIST_SIZE}""")


def _any_size_sql() -> str:
    own = sessions_cte(None).replace("FROM uva", "FROM hot")
    lists = ", ".join(
        f"CASE WHEN len({c}) <= {LIST_SIZE} THEN array_to_string({c}, ',') END AS {c}, "
        f"CAST((len({c}) + {LIST_SIZE - 1}) // {LIST_SIZE} AS INTEGER) AS {c}_slices"
        for c in ("search_keywords", "click_category_ids"))
    return with_sql(uva_cte("month"), HOT_CTE, own, body=f"""
        SELECT session_id, user_id, {lists}, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
               strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time, visit_length, step_length FROM sessions""")


def _long_lists_sql() -> str:
    p = TaskParams.of("2024-01-02", "2024-01-29")
    return with_sql(uva_cte("hour"), USERS_CTE, sessions_cte(p), RECORDS_CTE, body=f"""
        SELECT CAST(21 AS BIGINT) AS task_id, session_id, user_id, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
               strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time, visit_length, step_length, age, professional, city, sex
        FROM records
        WHERE len(list_filter(search_keywords, lambda k: CAST(substr(k, 3) AS BIGINT) % 3 = 0
                              AND CAST(substr(k, 3) AS BIGINT) < {3 * LONG_LIST})) > 0
          AND len(list_filter(click_category_ids, lambda c: c % 7 = 0 AND c < {7 * LONG_LIST})) > 0
          AND CAST(substr(city, 8) AS BIGINT) % 2 = 0""")


def _published_top_sql() -> str:
    parts = []
    for tid, text in TASK_ROWS:
        p = _task_params_from_json(tid, text)
        parts.append(with_sql(*_sessions_body(p, "minute"), _range_cte("uva_r", p), CATEGORY_COUNTS_CTE,
                              body=f"SELECT CAST({tid} AS BIGINT) AS task_id, * FROM top"))
    return _union_sql(parts)


def _more_oracles() -> dict[str, str]:
    return {
        "stored_session_states": with_sql(uva_cte("hour"), sessions_cte(TWO_WEEKS),
                                          body=f"SELECT {RENDERED_RECORD} FROM sessions"),
        "session_list_slices": _slices_sql(),
        "session_rollup_any_size": _any_size_sql(),
        "many_task_stat": _many_sql(),
        "filter_long_lists": _long_lists_sql(),
        "bucketed_session_rollup": with_sql(uva_cte(), sessions_cte(TWO_WEEKS),
                                            body=f"SELECT {RENDERED_RECORD} FROM sessions"),
        "published_task_stat": _multi_sql(),
        "published_top_categories": _published_top_sql(),
        "user_info": USERS_SQL,
        "raw_action_log": with_sql(uva_cte("second"), body=f"SELECT {ACTION_COLUMNS_SQL} FROM uva"),
        "decode_session_records": with_sql(
            uva_cte(), USERS_CTE, sessions_cte(MONTH), RECORDS_CTE,
            body="""SELECT session_id, nullif(array_to_string(search_keywords, ','), '') AS search_keywords,
                    nullif(array_to_string(click_category_ids, ','), '') AS click_category_ids,
                    visit_length, step_length, age, professional, city, sex FROM records"""),
        "action_gaps": with_sql(uva_cte("second"), _range_cte("uva_r", MONTH), body="""
            SELECT action_id, session_id, strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time,
                   strftime(prev_action_time, '%Y-%m-%d %H:%M:%S') AS prev_action_time,
                   date_diff('second', prev_action_time, action_time) AS gap_seconds
            FROM (SELECT *, lag(action_time) OVER (PARTITION BY session_id ORDER BY action_time, action_id)
                  AS prev_action_time FROM uva_r WHERE session_id IS NOT NULL)"""),
        "sessions_per_hour": with_sql(*_sessions_body(MONTH, "second"), body="""
            SELECT strftime(start_time, '%Y-%m-%d_%H') AS date_hour, count(*) AS sessions,
                   CAST(sum(step_length) AS BIGINT) AS actions FROM filtered GROUP BY 1"""),
        "actions_per_minute": with_sql(uva_cte("second"), _range_cte("uva_r", MONTH), body="""
            SELECT strftime(action_time, '%Y%m%d%H%M') AS minute_key, count(*) AS actions,
                   count(DISTINCT session_id) AS sessions FROM uva_r GROUP BY 1"""),
        "actions_around_noon": with_sql(uva_cte("second"), _range_cte("uva_r", MONTH), body="""
            SELECT session_id, count(*) FILTER (WHERE hour(action_time) < 12) AS actions_before,
                   count(*) FILTER (WHERE action_time > date_trunc('day', action_time) + INTERVAL 12 HOUR)
                   AS actions_after FROM uva_r GROUP BY session_id"""),
        "daily_rollup": with_sql(*_sessions_body(MONTH, "second"), body="""
            SELECT strftime(start_time, '%Y%m%d') AS date_key, count(*) AS sessions,
                   CAST(sum(step_length) AS BIGINT) AS actions, count(DISTINCT user_id) AS users,
                   max(visit_length) AS longest_visit, strftime(min(start_time), '%Y-%m-%d') AS date
            FROM filtered GROUP BY 1"""),
        "top10_category": with_sql(*_sessions_body(TOP_TASK, "minute"), _range_cte("uva_r", TOP_TASK),
                                   CATEGORY_COUNTS_CTE, body="SELECT * FROM top"),
        "top10_category_session": with_sql(
            *_sessions_body(TOP_TASK, "minute"), _range_cte("uva_r", TOP_TASK), CATEGORY_COUNTS_CTE,
            """ranked AS (SELECT category_id, session_id, click_count, order_count, pay_count,
                 CAST(row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS BIGINT)
                 AS rank FROM counts WHERE click_count > 0 AND category_id IN (SELECT category_id FROM top))""",
            body="SELECT * FROM ranked WHERE rank <= 10"),
        "session_random_extract": with_sql(*_extract_ctes(), body="""
            SELECT session_id, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
                   strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time,
                   array_to_string(search_keywords, ',') AS search_keywords, date_hour,
                   CAST(rank AS BIGINT) AS rank, quota FROM extracted"""),
        "session_detail": with_sql(*_extract_ctes(), _range_cte("uva_r", MONTH), body=f"""
            SELECT {ACTION_COLUMNS_SQL} FROM uva_r WHERE session_id IN (SELECT session_id FROM extracted)"""),
        "page_flow_conversion": _flow_sql(),
        "multi_task_stat": _multi_sql(),
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "actions_by_date": q_actions_by_date,
        "user_info": q_user_info,
        "raw_action_log": q_raw_action_log,
        "session_rollup": q_session_rollup,
        "session_user_join": q_session_user_join,
    }
    for name in FILTER_TASKS:
        q[name] = _filter_query(name)
    q.update({
        "session_counts": q_session_counts,
        "visit_histogram": _histogram("visit", VISIT_BUCKETS),
        "step_histogram": _histogram("step", STEP_BUCKETS),
        "session_aggr_stat": q_session_aggr_stat,
        "decode_session_records": q_decode_session_records,
        "action_gaps": q_action_gaps,
        "sessions_per_hour": q_sessions_per_hour,
        "actions_per_minute": q_actions_per_minute,
        "actions_around_noon": q_actions_around_noon,
        "daily_rollup": q_daily_rollup,
        "top10_category": q_top10_category,
        "top10_category_session": q_top10_category_session,
        "session_random_extract": q_session_random_extract,
        "session_detail": q_session_detail,
        "page_flow_conversion": q_page_flow_conversion,
        "multi_task_stat": q_multi_task_stat,
        "stored_session_states": q_stored_session_states,
        "session_list_slices": q_session_list_slices,
        "session_rollup_any_size": q_session_rollup_any_size,
        "many_task_stat": q_many_task_stat,
        "filter_long_lists": q_filter_long_lists,
        "bucketed_session_rollup": q_bucketed_session_rollup,
        "published_task_stat": q_published_task_stat,
        "published_top_categories": q_published_top_categories,
    })
    return q


def oracle_sql() -> dict[str, str]:
    o = _oracles()
    o.update(_more_oracles())
    return o
