import tempfile

from pyspark.sql import functions as F

from sessionscope.functions.buckets import STEP_BUCKETS, VISIT_BUCKETS
from sessionscope.sources.sinks import write_session_aggr_stat


def _stat(spark, task_id, count):
    cols = {f"visit_length_{b.name}_ratio": 0.5 for b in VISIT_BUCKETS}
    cols.update({f"step_length_{b.name}_ratio": 0.25 for b in STEP_BUCKETS})
    return spark.range(1).select(F.lit(task_id).cast("long").alias("task_id"),
                                 F.lit(count).cast("long").alias("session_count"),
                                 *[F.lit(v).alias(k) for k, v in cols.items()])


def test_rerun_of_a_task_replaces_its_row(spark):
    out = tempfile.mkdtemp(prefix="sessionscope-sink-")
    write_session_aggr_stat(_stat(spark, 1, 10), out)
    write_session_aggr_stat(_stat(spark, 2, 20), out)
    write_session_aggr_stat(_stat(spark, 1, 11), out)        # re-run of task 1
    rows = sorted((r.task_id, r.session_count) for r in spark.read.parquet(out).collect())
    assert rows == [(1, 11), (2, 20)]
    stored = spark.read.parquet(out).columns
    assert "1s_3s" in stored and "60" in stored and "visit_length_1s_3s_ratio" not in stored


def test_bucketed_action_log_makes_the_rollup_shuffle_free(spark):
    import contextlib
    import io

    from conftest import SF01
    from sessionscope.operators.sessions import actions_in_range, rollup_sessions
    from sessionscope.sources.sinks import save_action_log
    from sessionscope.sources.testdata import load_actions

    acts = load_actions(spark, SF01, "minute")
    save_action_log(acts, "uva_bucketed", buckets=8)
    stored = spark.table("uva_bucketed")
    rolled = rollup_sessions(actions_in_range(stored, "2024-01-05", "2024-01-09"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        rolled.explain()
    plan = buf.getvalue()
    assert "Exchange" not in plan, plan
    assert "PartitionFilters: [isnotnull(date" in plan
    expect = rollup_sessions(actions_in_range(acts, "2024-01-05", "2024-01-09"))
    key = lambda r: r.session_id
    assert sorted(rolled.collect(), key=key) == sorted(expect.select(*rolled.columns).collect(), key=key)


def test_a_log_with_a_hot_session_is_read_without_its_buckets(spark, tmp_path):
    import contextlib
    import io

    from fixtures import action, actions_df
    from sessionscope.operators.sessions import rollup_sessions
    from sessionscope.sources.sinks import read_action_log, save_action_log

    acts = actions_df(spark, [action("hot" if i % 3 == 0 else f"s{i % 7}", 1, i, keyword=f"k{i % 5}") for i in range(90)])
    save_action_log(acts, "uva_hot", buckets=4, path=str(tmp_path / "log"))

    def plan(df):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
        return out.getvalue()

    key = lambda r: r.session_id
    want = sorted(rollup_sessions(acts).collect(), key=key)
    for limit, shuffled in ((30, False), (29, True)):       # the hot session has 30 actions
        rolled = rollup_sessions(read_action_log(spark, "uva_hot", limit))
        assert ("Exchange" in plan(rolled)) == shuffled
        assert sorted(rolled.collect(), key=key) == want
    assert "PartitionFilters: [isnotnull(date" in plan(read_action_log(spark, "uva_hot", 29).where("date = '2024-01-02'"))
