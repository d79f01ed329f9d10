"""Top categories and, per top category, the sessions that clicked it most.

Actions are first reduced to one row per (session, category) with three
counts — partial aggregation bounds the cost of a hot session — and only
those rows meet the filtered sessions. The top-10 list has at most ten rows
and is broadcast; the per-category session ranking is a ``row_number``
limit that Spark evaluates partially before its shuffle (``WindowGroupLimit``),
so a hot category moves at most ten rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("click", "order", "pay")


def _ids(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, ","), lambda x: F.trim(x) != ""),
                       lambda x: F.trim(x).try_cast("bigint"))


def category_events(actions: DataFrame, keep: tuple[str, ...] = ("session_id",)) -> DataFrame:
    """(session_id, category_id, kind) for every clicked, ordered or paid
    category of every action; the order and pay id lists are comma-separated.
    ``keep`` names the action's columns in front.

    An entry of a list that is not a number names no category and is skipped.
    """
    def tagged(ids: Column, kind: str) -> Column:
        return F.transform(ids, lambda c: F.struct(c.alias("category_id"), F.lit(kind).alias("kind")))

    events = F.concat(
        tagged(F.when(F.col("click_category_id").isNotNull(), F.array(F.col("click_category_id")))
               .otherwise(F.array().cast("array<bigint>")), "click"),
        tagged(F.coalesce(_ids(F.col("order_category_ids")), F.array().cast("array<bigint>")), "order"),
        tagged(F.coalesce(_ids(F.col("pay_category_ids")), F.array().cast("array<bigint>")), "pay"),
    )
    return (actions.select(*keep, F.explode(events).alias("e"))
            .select(*keep, "e.category_id", "e.kind")
            .where(F.col("category_id").isNotNull()))


def session_category_counts(actions: DataFrame, keep: tuple[str, ...] = ("session_id",)) -> DataFrame:
    """One row per (session, category): click, order and pay counts."""
    return (category_events(actions, keep)
            .groupBy(*keep, "category_id")
            .agg(*[F.count_if(F.col("kind") == k).alias(f"{k}_count") for k in KINDS]))


def counts_of_sessions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Session-category counts restricted to the given sessions."""
    return session_category_counts(actions).join(sessions.select("session_id"), "session_id", "left_semi")


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` categories by clicks, then orders, then pays, then id."""
    per_cat = counts.groupBy("category_id").agg(
        *[F.sum(f"{k}_count").alias(f"{k}_count") for k in KINDS])
    return per_cat.orderBy(F.desc("click_count"), F.desc("order_count"),
                           F.desc("pay_count"), F.asc("category_id")).limit(n)


def top_sessions_per_category(counts: DataFrame, categories: DataFrame, n: int = 10) -> DataFrame:
    """For each given category, the ``n`` sessions with most clicks on it
    (ties by session id); sessions without a click on it are not ranked.

    All three counts are kept so that this ranking and ``top_categories``
    read the same session-category aggregate (one shared exchange).
    """
    cats = F.broadcast(categories.select("category_id"))  # at most the top-n list
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), F.asc("session_id"))
    return (counts.where(F.col("click_count") > 0)
            .join(cats, "category_id", "left_semi")
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n)
            .select("category_id", "session_id", "click_count", "order_count", "pay_count", "rank"))
