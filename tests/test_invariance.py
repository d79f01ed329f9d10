"""Registered queries give the same rows whatever the shuffle partitioning."""

import os
import sys

import pytest

import __spark_entry__ as entry
from conftest import ROOT, SF01

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import canonical  # noqa: E402

SENSITIVE = ["session_aggr_stat", "action_gaps", "page_flow_conversion", "top10_category_session",
             "session_random_extract", "session_detail", "multi_task_stat", "daily_rollup"]


@pytest.mark.parametrize("name", SENSITIVE)
def test_same_rows_for_1_and_13_shuffle_partitions(spark, name):
    fn = entry.queries()[name]
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = fn(spark, SF01)
            results.append(canonical(df.columns, [tuple(r) for r in df.collect()]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1]
