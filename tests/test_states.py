import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001
from sessionscope.operators.sessions import actions_in_range, render_lists, rollup_sessions
from sessionscope.operators.states import changed_dates, refresh_states, stored_sessions
from sessionscope.sources.published import read_published
from sessionscope.sources.testdata import load_actions


def _rows(df):
    return sorted(map(tuple, render_lists(df.select(*sorted(df.columns))).collect()), key=str)


def _same(spark, acts, root, start, end):
    want = rollup_sessions(actions_in_range(acts, start, end))
    assert _rows(stored_sessions(spark, root, start, end)) == _rows(want)


def test_only_changed_dates_are_rebuilt(spark, tmp_path):
    root, acts = str(tmp_path), load_actions(spark, SF001, "hour")
    day, gone = dt.date(2024, 1, 10), dt.date(2024, 1, 12)
    first = acts.where((F.col("date") != F.lit(day)) | (F.col("action_id") % 2 == 0))
    built = refresh_states(first, root)
    assert len(built) == first.select("date").distinct().count()
    _same(spark, first, root, "2024-01-08", "2024-01-21")
    assert refresh_states(first, root) == []                                  # nothing has changed
    assert refresh_states(acts, root) == [day]
    _same(spark, acts, root, "2024-01-08", "2024-01-21")
    fewer = acts.where(F.col("date") != F.lit(gone))                          # a date loses all its actions
    assert changed_dates(fewer, root) == {gone: None} and refresh_states(fewer, root) == [gone]
    _same(spark, fewer, root, "2024-01-01", "2024-01-31")
    assert {r.date for r in read_published(spark, root, "sessions", "date").select("date").collect()} == set(built) - {gone}


def test_the_caller_may_name_the_dates(spark, tmp_path):
    root, acts = str(tmp_path), load_actions(spark, SF001, "hour")
    assert refresh_states(acts, root, ["2024-01-03", "2024-01-02", "2030-01-01"]) == [
        dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2030, 1, 1)]
    _same(spark, acts.where(F.col("date") <= F.lit(dt.date(2024, 1, 3))), root, "2024-01-02", "2024-01-31")
    assert stored_sessions(spark, root, "2025-01-01", "2025-01-31").collect() == []


def test_a_changed_keyword_alone_is_noticed(spark, tmp_path):
    root, acts = str(tmp_path), load_actions(spark, SF001, "second")
    refresh_states(acts, root)
    other = acts.withColumn("search_keyword", F.when(F.col("action_id") == 5, F.lit("new")).otherwise(F.col("search_keyword")))
    day = acts.where("action_id = 5").first().date
    assert list(changed_dates(other, root)) == [day]
