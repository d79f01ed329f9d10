import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from sessionscope.operators.sequence import _bounds, with_previous
from sessionscope.sources.testdata import load_actions


def _expected(df):
    w = Window.partitionBy("session_id").orderBy("action_time", "action_id")
    return sorted(map(tuple, df.select("action_id", F.lag("action_time").over(w).alias("p"),
                                       F.lag("page_id").over(w).alias("q")).collect()))


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("max_rows", [40, 700, 10**6])
def test_previous_row_matches_window_lag(spark, max_rows, hot, reuse):
    acts = load_actions(spark, SF01, "minute")
    if hot:  # one session holds a third of all actions
        acts = acts.withColumn("session_id", F.when(F.col("action_id") % 3 == 0, F.lit("HOT"))
                               .otherwise(F.col("session_id")))
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = with_previous(acts, "session_id", ["action_time", "action_id"], ["action_time", "page_id"], max_rows)
        rows = sorted(map(tuple, got.select("action_id", "prev_action_time", "prev_page_id").collect()))
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert rows == _expected(acts)
    assert got.columns == [*acts.columns, "prev_action_time", "prev_page_id"]


def test_a_hot_session_is_cut_into_even_slices(spark):
    acts = load_actions(spark, SF01, "minute").withColumn("session_id", F.lit("ONE"))
    (row,) = _bounds(acts, "session_id", ["action_time", "action_id"], 1000).collect()
    at = F.struct("action_time", "action_id")
    kind = "session_id string, b array<struct<action_time:timestamp_ntz,action_id:bigint>>"
    sliced = acts.withColumn("at", at).join(spark.createDataFrame([row], kind), "session_id")
    sizes = [r["count"] for r in sliced.groupBy(F.size(F.filter("b", lambda b: b <= F.col("at")))).count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 2000


def test_null_keys_null_times_and_ties(spark):
    rows = [("s", None, 1, 10), ("s", 5, 2, 20), ("s", 5, 3, 30), ("s", None, 4, 40), (None, 1, 5, 50), (None, 1, 6, 60),
            ("t", 1, 7, None), ("t", 2, 8, 80), ("t", 3, 9, 90)]
    df = spark.createDataFrame(rows, "session_id string, at long, action_id long, page_id long")
    want = [(1, None), (2, 40), (3, 20), (4, 10), (5, None), (6, None), (7, None), (8, None), (9, 80)]
    for max_rows in (1, 2, 100):
        got = with_previous(df, "session_id", ["at", "action_id"], ["page_id"], max_rows)
        assert sorted((r.action_id, r.prev_page_id) for r in got.collect()) == want
    empty = with_previous(df.where("false"), "session_id", ["action_id"], ["page_id"], 1)
    assert empty.collect() == [] and "prev_page_id" in empty.columns
