"""Session statistics over a stream of actions.

A session is closed once the event-time watermark passes the end of the
tumbling ``horizon`` window its actions fall in (one day for day-long
sessions). ``session_rollup_stream`` emits each closed session once, in
append mode, with the same columns as the batch rollup; its state is
bounded by the sessions still open.

``start_stat_increments`` turns every micro-batch of closed sessions into
bucket counts per task (join users, apply the task's predicates, count) and
writes them under ``batch_id=<n>``; a replayed batch overwrites its own
folder, so the increments stay exact after a failure. The current
statistics are the sum of all increments, read back with
``stats_from_increments``.

As in batch, a session equals the batch rollup when none of its actions
cross a ``horizon`` boundary; later actions than the watermark allows are
dropped by Spark as late data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionscope.functions.timefmt import seconds_between
from sessionscope.operators.filters import session_predicate
from sessionscope.operators.sessions import with_users
from sessionscope.operators.stats import bucket_counts, ratios_from_counts
from sessionscope.sources.tables import date_range_predicate
from sessionscope.sources.tasks import TaskParams


def session_rollup_stream(actions: DataFrame, horizon: str = "1 day", watermark: str = "1 hour",
                          params: TaskParams | None = None) -> DataFrame:
    """Closed sessions of a streaming action log (append mode), of the task's
    dates when ``params`` are given. An action without a time counts as a
    step on its date."""
    # the dates select inside the aggregates: a filter would also hold back the
    # watermark, and the last wanted day would never close
    wanted = F.lit(True) if params is None else \
        F.coalesce(date_range_predicate(F.col("date"), params.start_date, params.end_date), F.lit(False))
    time = F.coalesce("action_time", F.col("date").cast("timestamp_ntz"))

    def own(c: str) -> Column:
        return F.when(wanted, F.col(c))

    return (actions.where(F.col("session_id").isNotNull())
            # the watermark needs a zoned timestamp: read the wall-clock time
            # as UTC, so windows align with the log's days in any session zone
            .withColumn("_event_time", F.timestamp_seconds(F.unix_timestamp(time)))
            .withWatermark("_event_time", watermark)
            .groupBy(F.window("_event_time", horizon).alias("_horizon"), "session_id")
            .agg(F.min(own("user_id")).alias("user_id"),
                 F.sort_array(F.collect_set(F.nullif(own("search_keyword"), F.lit("")))).alias("search_keywords"),
                 F.sort_array(F.collect_set(own("click_category_id"))).alias("click_category_ids"),
                 F.min(own("action_time")).alias("start_time"),
                 F.max(own("action_time")).alias("end_time"),
                 F.count_if(wanted).alias("step_length"))
            .where(F.col("step_length") > 0)
            .withColumn("visit_length", seconds_between(F.col("start_time"), F.col("end_time")))
            .drop("_horizon"))


def start_stat_increments(sessions: DataFrame, users: DataFrame, params: TaskParams, out_path: str,
                          checkpoint_location: str, trigger: dict | None = None) -> StreamingQuery:
    """Start the query writing per-batch bucket counts of ``params``' task.

    ``sessions`` is the stream of ``session_rollup_stream`` for the same
    ``params``, so only actions of the task's dates are in it.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        counts = (bucket_counts(with_users(batch, users).where(session_predicate(params)))
                  .withColumn("task_id", F.lit(params.task_id).cast("long")))
        (counts.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}"))

    writer = (sessions.writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint_location)
              .foreachBatch(write_batch))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def stats_from_increments(spark: SparkSession, out_path: str) -> DataFrame:
    """Sum the increments and compute the ratios: one row per task."""
    inc = spark.read.parquet(out_path)
    count_cols = [c for c in inc.columns if c not in ("task_id", "batch_id")]
    totals = inc.groupBy("task_id").agg(*[F.sum(c).cast("long").alias(c) for c in count_cols])
    return ratios_from_counts(totals)
