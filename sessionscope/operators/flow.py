"""Page-flow conversion.

For a target flow ``p1, p2, …, pk`` count, over consecutive actions of each
session, the transitions ``pi → pi+1``. The rate of the first step is its
transitions over the views of ``p1``; every later step is taken over the
transitions of the step before it. Consecutive actions come from
``sequence.with_previous`` (no task holds a whole session).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionscope.functions.numbers import ratio_half_up
from sessionscope.operators.sequence import MAX_ROWS, with_previous


def page_flow_conversion(actions: DataFrame, flow: list[int] | tuple[int, ...],
                         max_rows: int = MAX_ROWS) -> DataFrame:
    flow = [int(p) for p in flow]
    if len(flow) < 2:
        raise ValueError("a page flow needs at least two pages")
    steps = list(zip(flow[:-1], flow[1:]))
    acts = actions.where(F.col("session_id").isNotNull()).select("session_id", "action_time", "action_id", "page_id")
    pairs = with_previous(acts, "session_id", ["action_time", "action_id"], ["page_id"], max_rows)
    prev, page = F.col("prev_page_id"), F.col("page_id")
    # one global aggregate: views of the first page and every step's transitions
    counted = pairs.agg(
        F.count_if(page == flow[0]).alias("first_page_views"),
        *[F.count_if((prev == a) & (page == b)).alias(f"t{i}") for i, (a, b) in enumerate(steps, start=1)])
    stack = ", ".join(f"{i}, {a}L, {b}L, t{i}" for i, (a, b) in enumerate(steps, start=1))
    long = counted.selectExpr("first_page_views", f"stack({len(steps)}, {stack}) AS (step, from_page, to_page, transitions)")
    w = Window.orderBy("step")  # at most len(flow) - 1 rows
    base = F.coalesce(F.lag("transitions").over(w), F.col("first_page_views"))
    return long.select(
        F.col("step").cast("int").alias("step"),
        F.concat_ws("_", F.col("from_page").cast("string"), F.col("to_page").cast("string")).alias("page_pair"),
        "transitions",
        base.alias("base"),
    ).withColumn("conversion_rate", ratio_half_up("transitions", "base"))
