"""Every result of several tasks from one set of tables.

The tasks' sessions (``operators.task_sessions``) and the category counts of
every session and date interval are computed once for all tasks; each result is
one plan grouped by task. The log is read a fixed number of times, however many
tasks there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionscope.functions.numbers import ratio_half_up
from sessionscope.functions.timefmt import format_time
from sessionscope.operators.extract import random_extract
from sessionscope.operators.intervals import Intervals, elementary_intervals
from sessionscope.operators.multi import task_stats
from sessionscope.operators.sequence import MAX_ROWS, with_previous
from sessionscope.operators.task_sessions import interval_actions, task_sessions
from sessionscope.operators.topn import KINDS, session_category_counts
from sessionscope.session import ensure_checkpoint_dir
from sessionscope.sources.tasks import TaskTable

# Columns of the stored results, behind task_id.
SESSION_DETAIL_COLUMNS = ("user_id", "session_id", "page_id", "action_time", "search_keyword", "click_category_id",
                          "click_product_id", "order_category_ids", "order_product_ids", "pay_category_ids",
                          "pay_product_ids")


def task_category_counts(acts: DataFrame, sessions: DataFrame, runs: DataFrame) -> DataFrame:
    """(task_id, session_id, category_id, click_count, order_count, pay_count) over each task's own days.

    ``acts`` have their interval, ``runs`` are the tasks' intervals (task_id, a, b).
    """
    counts = session_category_counts(acts, keep=("session_id", "interval"))
    pairs = sessions.select("task_id", "session_id").distinct().join(runs, "task_id")
    return (counts.join(pairs, "session_id").where(F.col("interval").between(F.col("a"), F.col("b")))
            .groupBy("task_id", "session_id", "category_id")
            .agg(*[F.sum(f"{k}_count").alias(f"{k}_count") for k in KINDS]))


def top_categories_by_task(counts: DataFrame, n: int = 10) -> DataFrame:
    """Per task the top ``n`` categories by clicks, then orders, then pays, then id."""
    per_category = counts.groupBy("task_id", "category_id").agg(
        *[F.sum(f"{k}_count").alias(f"{k}_count") for k in KINDS])
    order = Window.partitionBy("task_id").orderBy(*[F.desc(f"{k}_count") for k in KINDS], "category_id")
    return per_category.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).drop("rank")


def top_sessions_by_task(counts: DataFrame, top: DataFrame, n: int = 10) -> DataFrame:
    """Per task and top category the ``n`` sessions with most clicks on it, ties by session id."""
    order = Window.partitionBy("task_id", "category_id").orderBy(F.desc("click_count"), "session_id")
    return (counts.where(F.col("click_count") > 0)
            .join(top.select("task_id", "category_id"), ["task_id", "category_id"], "left_semi")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n))


def page_flows_by_task(acts: DataFrame, table: TaskTable, intervals: Intervals, max_rows: int = MAX_ROWS) -> DataFrame:
    """(task_id, step, page_pair, transitions, base, conversion_rate) of every task that names a flow of two pages or more.

    Tasks of the same days share one sequence of their sessions' actions.
    """
    spark = acts.sparkSession
    flows = [t for t in table.rows if t.target_page_flow and len(t.target_page_flow) >= 2]
    spans = sorted({intervals.runs[t.task_id] for t in flows if t.task_id in intervals.runs})
    place = {span: i for i, span in enumerate(spans)}
    steps = [(t.task_id, place.get(intervals.runs.get(t.task_id), -1), i, a, b)
             for t in flows for i, (a, b) in enumerate(zip(t.target_page_flow, t.target_page_flow[1:]), start=1)]
    ranges = spark.createDataFrame([(i, a, b) for (a, b), i in place.items()], "range int, a int, b int")
    keyed = (acts.join(ranges, F.col("interval").between(F.col("a"), F.col("b")))
             .select("range", F.concat_ws("|", "range", "session_id").alias("_key"), "action_time", "action_id", "page_id"))
    pairs = with_previous(keyed, "_key", ["action_time", "action_id"], ["page_id"], max_rows)
    counts = pairs.groupBy("range", "prev_page_id", "page_id").agg(F.count(F.lit(1)).alias("n"))
    views = counts.groupBy("range", F.col("page_id").alias("from_page")).agg(F.sum("n").alias("views"))
    wanted = spark.createDataFrame(steps, "task_id long, range int, step int, from_page long, to_page long")
    met = counts.select("range", F.col("prev_page_id").alias("from_page"), F.col("page_id").alias("to_page"),
                        F.col("n").alias("transitions"))
    found = (wanted.join(met, ["range", "from_page", "to_page"], "left").join(views, ["range", "from_page"], "left")
             .withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("transitions", "views")}))
    before = F.lag("transitions").over(Window.partitionBy("task_id").orderBy("step"))  # a flow's few steps
    base = F.when(F.col("step") == 1, F.col("views")).otherwise(before)
    return found.select("task_id", "step", F.concat_ws("_", F.col("from_page").cast("string"),
                                                       F.col("to_page").cast("string")).alias("page_pair"),
                        "transitions", base.alias("base")) \
        .withColumn("conversion_rate", ratio_half_up("transitions", "base"))


def all_outputs(actions: DataFrame, users: DataFrame, table: TaskTable, extract_per_day: int = 100,
                top_n: int = 10, checkpoint: bool = True, names: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """Every result of every task, or those of ``names``, in their stored columns with task_id in front.

    With ``checkpoint`` the tasks' sessions, their category counts and the
    sample, which feed several results, are written once to
    ``spark.checkpoint.dir``. A task's sample is drawn with its id for a seed.
    """
    spark = actions.sparkSession

    def shared(df: DataFrame) -> DataFrame:
        return df.checkpoint(eager=True) if checkpoint else df

    def asked(*some: str) -> bool:
        return names is None or bool({*names} & {*some})

    if checkpoint:
        ensure_checkpoint_dir(spark)
    intervals = elementary_intervals(table.rows)
    runs = intervals.table(spark)
    acts = interval_actions(actions, intervals)
    sessions = shared(task_sessions(actions, users, table))
    outputs = {}
    if asked("session_aggr_stat"):
        outputs["session_aggr_stat"] = task_stats(sessions, table)
    if asked("top10_category", "top10_category_session"):
        counts = shared(task_category_counts(acts, sessions, runs))
        top = top_categories_by_task(counts, top_n)
        outputs["top10_category"] = top.select("task_id", "category_id", *[f"{k}_count" for k in KINDS])
        outputs["top10_category_session"] = top_sessions_by_task(counts, top, top_n) \
            .select("task_id", "category_id", "session_id", "click_count")
    if asked("session_random_extract", "session_detail"):
        once = sessions.select("task_id", "session_id", "start_time", "end_time").distinct()
        sample = shared(random_extract(once, extract_per_day, F.col("task_id"), by=("task_id",)))
        own = (acts.join(sample.select("task_id", "session_id").join(runs, "task_id"), "session_id")
               .where(F.col("interval").between(F.col("a"), F.col("b"))))
        keywords = (own.where(F.nullif(F.col("search_keyword"), F.lit("")).isNotNull())
                    .select("task_id", "session_id", "search_keyword").distinct()
                    .groupBy("task_id", "session_id").agg(F.array_sort(F.collect_list("search_keyword")).alias("_k")))
        outputs["session_random_extract"] = sample.join(keywords, ["task_id", "session_id"], "left").select(
            "task_id", "session_id", format_time(F.col("start_time")).alias("start_time"),
            format_time(F.col("end_time")).alias("end_time"),
            F.coalesce(F.array_join("_k", ","), F.lit("")).alias("search_keywords"))
        outputs["session_detail"] = own.withColumn("action_time", format_time(F.col("action_time"))) \
            .select("task_id", *SESSION_DETAIL_COLUMNS)
    flows = any(t.target_page_flow and len(t.target_page_flow) >= 2 for t in table.rows)
    if flows and asked("page_flow_conversion"):
        outputs["page_flow_conversion"] = page_flows_by_task(acts, table, intervals)
    return {name: df for name, df in outputs.items() if asked(name)}
