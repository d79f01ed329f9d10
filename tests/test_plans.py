"""The physical plans keep the properties the design relies on."""

import contextlib
import io
import re

import __spark_entry__ as entry
from conftest import SF01
from fixtures import action, actions_df
from pyspark.sql import functions as F

from sessionscope.operators.extract import SPARE, _bound, random_extract
from sessionscope.operators.sessions import rollup_sessions
from sessionscope.sources.schemas import RAW_ACTION_SCHEMA
from sessionscope.sources.tables import read_actions

QUERIES = entry.queries()


def plan(spark, name, execute=False):
    df = QUERIES[name](spark, SF01)
    if execute:
        df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_flagship_prunes_columns_and_pushes_the_date_range(spark):
    p = plan(spark, "session_aggr_stat")
    scan = [line for line in p.splitlines() if "FileScan parquet" in line and "events" in line]
    assert scan, p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in scan[0]
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), GreaterThanOrEqual\(ts,2024-01-01T00:00\), "
                     r"LessThan\(ts,2024-02-01T00:00\)\]", scan[0])
    # the session rollup is aggregated before its shuffle
    assert "partial_min(user_id" in p and "partial_count(1)" in p


def test_user_predicates_reach_the_user_scans(spark):
    p = plan(spark, "filter_all")
    assert re.search(r"PushedFilters: \[IsNotNull\(c_custkey\), In\(c_mktsegment", p)


def test_top_sessions_and_sample_limit_before_the_shuffle(spark):
    # the sample is ranked before the query's plan: see the test of its candidates
    for name in ("top10_category_session",):
        p = plan(spark, name)
        assert re.search(r"WindowGroupLimit .* Partial", p), name
        assert re.search(r"WindowGroupLimit .* Final", p), name


def test_top_sessions_share_one_category_aggregate(spark):
    assert "ReusedExchange" in plan(spark, "top10_category_session", execute=True)


def test_previous_row_is_a_native_window(spark):
    p = plan(spark, "page_flow_conversion", execute=True)
    assert "Window" in p and "Python" not in p and "Arrow" not in p


def test_statistics_with_lists_build_no_arrays(spark):
    p = plan(spark, "session_counts")
    assert "ObjectHashAggregate" not in p and "collect_set" not in p


def test_multi_task_bounds_the_scans_and_keeps_rows_narrow(spark):
    p = plan(spark, "multi_task_stat")
    scan = [line for line in p.splitlines() if "FileScan parquet" in line and "events" in line]
    # sessions from one scan, lists met from another; the same two for any number of tasks
    assert len(scan) == 2 == sum("events" in line for line in plan(spark, "many_task_stat").splitlines() if "FileScan" in line)
    assert all(re.search(r"GreaterThanOrEqual\(ts,2024-01-01T00:00\), LessThan\(ts,2025-03-08T00:00\)", x) for x in scan)
    # the log is aggregated by session and interval in fixed width; nothing is shuffled by task and session
    assert re.search(r"HashAggregate\(keys=\[session_id#\d+, interval#\d+\], functions=\[partial_min", p)
    assert not re.search(r"hashpartitioning\(task_id#\d+L?, session_id", p)


def test_text_dates_are_pushed_to_the_scan(spark, tmp_path):
    rows = [action("s1", 1, 0), action("s2", 1, 5)]
    path = str(tmp_path / "log")
    spark.createDataFrame(rows, RAW_ACTION_SCHEMA).write.parquet(path)
    found = read_actions(spark, path, start="2024-01-01", end="2024-01-31")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        found.explain()
    assert re.search(r"PushedFilters: \[IsNotNull\(date\), GreaterThanOrEqual\(date,2024-01-01\), "
                     r"LessThanOrEqual\(date,2024-01-31\)\]", buf.getvalue())
    assert found.count() == 2
    assert read_actions(spark, path, start="2024-01-02", end="2024-01-31").count() == 0


def test_only_the_sample_meets_the_sessions_again(spark):
    """Counts, candidates and ranks come from checkpoints; the plan joins the sample to its sessions."""
    p = plan(spark, "session_random_extract")
    assert p.count("events.parquet") == 1 and "Window" not in p and "ExistingRDD" in p


def test_candidates_of_the_sample_follow_its_size(spark):
    """Rows that are ranked: in proportion to the quotas, not to the sessions."""
    rows = [action(f"s{i}", 1, i) for i in range(3000)]
    sessions = rollup_sessions(actions_df(spark, rows)).select("session_id", "start_time")
    share = F.conv(F.substring(F.md5(F.concat("session_id", F.lit("x"))), 1, 15), 16, 10).cast("double") / float(1 << 60)
    quota, n = F.lit(10.0), F.lit(3000.0)
    under = sessions.where(share < _bound(quota, n, SPARE)).count()
    assert 10 <= under <= 80
    found = random_extract(sessions, 10, "x")
    assert found.count() == 10
