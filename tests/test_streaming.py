import tempfile

from pyspark.sql import functions as F

from conftest import SF01
from sessionscope.operators.stats import session_aggr_stat
from sessionscope.plans.job import filtered_sessions
from sessionscope.sources.tasks import TaskParams
from sessionscope.sources.testdata import actions_from_events, load_actions, load_users
from sessionscope.streaming import session_rollup_stream, start_stat_increments, stats_from_increments


def test_stream_statistics_equal_batch_for_closed_days(spark):
    events_schema = spark.read.parquet(f"{SF01}/events.parquet").schema
    stream = spark.readStream.schema(events_schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{SF01}/events*.parquet")
    params = TaskParams.of("2024-01-03", "2024-01-28", sex="female", task_id=5)
    untimed = F.when(F.col("action_id") % 7 != 0, F.col("action_time"))  # some actions have no time
    actions = actions_from_events(stream, "minute").withColumn("action_time", untimed)
    sessions = session_rollup_stream(actions, "1 day", "1 hour", params)
    # minute clock: a day's actions lie in its first 24 minutes, so the
    # watermark (latest time - 1 hour) has closed every day up to 2024-01-28
    out = tempfile.mkdtemp(prefix="sessionscope-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="sessionscope-stream-ckpt-")
    q = start_stat_increments(sessions, load_users(spark, SF01), params, out, ckpt)
    q.awaitTermination(600)
    assert q.exception() is None
    got = stats_from_increments(spark, out).first().asDict()
    expect = session_aggr_stat(
        filtered_sessions(load_actions(spark, SF01, "minute").withColumn("action_time", untimed),
                          load_users(spark, SF01), params), 5).first().asDict()
    assert got == expect and got["session_count"] > 0


def test_late_actions_after_the_watermark_are_dropped(spark):
    events = spark.read.parquet(f"{SF01}/events.parquet")
    src = tempfile.mkdtemp(prefix="sessionscope-stream-src-")
    day = F.dayofmonth("ts")
    # three files, read one per micro-batch in order: days 1-10, days 20-25,
    # then day 2 again (late: its window closed when day 25 arrived)
    for i, cond in enumerate([(day <= 10), (day >= 20) & (day <= 25), (day == 2)]):
        events.where(cond).coalesce(1).write.parquet(f"{src}/part{i}")
    stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    sessions = session_rollup_stream(actions_from_events(stream, "second"), "1 day", "1 hour")
    params = TaskParams.of("2024-01-01", "2024-01-31", task_id=6)
    out = tempfile.mkdtemp(prefix="sessionscope-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="sessionscope-stream-ckpt-")
    q = start_stat_increments(sessions, load_users(spark, SF01), params, out, ckpt)
    q.awaitTermination(600)
    assert q.exception() is None
    got = stats_from_increments(spark, out).first().asDict()
    # closed by the final watermark: days 1-10 and 20-24 (day 25 is still open)
    acts = load_actions(spark, SF01, "second").where(
        (F.dayofmonth("date") <= 10) | ((F.dayofmonth("date") >= 20) & (F.dayofmonth("date") <= 24)))
    expect = session_aggr_stat(filtered_sessions(acts, load_users(spark, SF01), params), 6).first().asDict()
    assert got == expect
