"""A session's keywords and categories, however many there are.

``collect_set`` keeps all values of a session in one aggregation buffer of
every task. Here the log is first reduced to distinct (session, value) rows, a
hash aggregate of fixed width with a partial form. The rows are put in order
over all tasks (a hot session spans several), which gives every value its rank
in its session's list, and lists are built from ranks: in slices of at most
``max_values``, so no buffer holds more. A session's list is the first slice if
that is all there is; longer lists stay rows (session, kind, slice, values).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionscope.functions.timefmt import seconds_between
from sessionscope.session import ensure_checkpoint_dir

MAX_VALUES = 10_000
KEYWORD, CATEGORY = "keyword", "category"


def session_values(actions: DataFrame, by: tuple[str, ...] = ("session_id",)) -> DataFrame:
    """Distinct (``by``, kind, keyword, category): a non-empty keyword or a category a session met."""
    keyword = F.nullif(F.col("search_keyword"), F.lit(""))
    none = F.lit(None)
    met = F.array(
        F.struct(F.lit(KEYWORD).alias("kind"), keyword.alias("keyword"), none.cast("bigint").alias("category")),
        F.struct(F.lit(CATEGORY).alias("kind"), none.cast("string").alias("keyword"),
                 F.col("click_category_id").alias("category")))
    # an action mostly has one of them or none
    given = F.filter(met, lambda v: v["keyword"].isNotNull() | v["category"].isNotNull())
    return (actions.where(F.col("session_id").isNotNull() & (keyword.isNotNull() | F.col("click_category_id").isNotNull()))
            .select(*by, F.explode(given).alias("v"))
            .select(*by, "v.kind", "v.keyword", "v.category").distinct())


def value_slices(values: DataFrame, max_values: int = MAX_VALUES) -> DataFrame:
    """(session_id, kind, slice, slices, values): the ordered list of every session and kind, cut into slices.

    Keywords are ordered bytewise, categories by number; ``values`` are text.
    Slice ``i`` holds the values of rank ``i * max_values`` and up.
    """
    order = ["session_id", "kind", "keyword", "category"]
    ensure_checkpoint_dir(values.sparkSession)
    # written once: what follows reads the same tasks' rows again
    ordered = (values.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("_id", F.monotonically_increasing_id()).checkpoint(eager=True)
               .withColumn("_task", F.shiftright("_id", 33)))
    # only the first list of a task can continue one of earlier tasks: at most a row per task
    counts = ordered.groupBy("session_id", "kind", "_task").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("session_id", "kind").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    continued = (counts.select("session_id", "kind", "_task", F.sum("_n").over(earlier).alias("_before"))
                 .where(F.col("_before") > 0))
    total = counts.groupBy("session_id", "kind").agg(F.sum("_n").alias("_total"))
    place = Window.partitionBy("session_id", "kind", "_task").orderBy("_id")  # a part of one task's rows
    value = F.coalesce(F.col("keyword"), F.col("category").cast("string"))
    ranked = (ordered.withColumn("_place", F.row_number().over(place) - 1)
              .join(continued, ["session_id", "kind", "_task"], "left")
              .withColumn("_rank", F.col("_place") + F.coalesce("_before", F.lit(0))))
    slices = (ranked.groupBy("session_id", "kind", F.expr(f"cast(_rank div {int(max_values)} as int)").alias("slice"))
              .agg(F.array_sort(F.collect_list(F.struct("_rank", value.alias("value")))).alias("_values")))
    return slices.join(total, ["session_id", "kind"]).select(
        "session_id", "kind", "slice",
        F.expr(f"cast((_total + {int(max_values) - 1}) div {int(max_values)} as int)").alias("slices"),
        F.transform("_values", lambda v: v["value"]).alias("values"))


def with_lists(sessions: DataFrame, slices: DataFrame) -> DataFrame:
    """``sessions`` with search_keywords, click_category_ids and the slices of each.

    A list of several slices is NULL here and read from ``slices``; a session
    without values has an empty list of no slices.
    """
    out = sessions
    for kind, name, cast in ((KEYWORD, "search_keywords", "array<string>"), (CATEGORY, "click_category_ids", "array<bigint>")):
        own = slices.where((F.col("kind") == kind) & (F.col("slice") == 0)).select(
            "session_id", F.col("slices").alias(f"{name}_slices"), F.col("values").alias("_values"))
        size = F.coalesce(F.col(f"{name}_slices"), F.lit(0))
        out = out.join(own, "session_id", "left").withColumns({
            name: F.when(size == 0, F.array().cast(cast)).when(size == 1, F.col("_values").cast(cast)),
            f"{name}_slices": size}).drop("_values")
    return out


def rollup_any_size(actions: DataFrame, max_values: int = MAX_VALUES) -> tuple[DataFrame, DataFrame]:
    """(sessions, slices): the rollup of ``sessions.rollup_sessions`` for sessions of any size.

    No aggregation buffer over the log holds values; see ``with_lists`` for long lists.
    """
    scalars = (actions.where(F.col("session_id").isNotNull()).groupBy("session_id")
               .agg(F.min("user_id").alias("user_id"), F.min("action_time").alias("start_time"),
                    F.max("action_time").alias("end_time"), F.count(F.lit(1)).alias("step_length"))
               .withColumn("visit_length", seconds_between(F.col("start_time"), F.col("end_time"))))
    slices = value_slices(session_values(actions), max_values)
    return with_lists(scalars, slices), slices
