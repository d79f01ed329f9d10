"""The oracle is independent: a library with a moved edge or another rounding rule fails it."""

import dataclasses
import sys
from decimal import ROUND_HALF_UP, Decimal

import duckdb
import pytest
from conftest import ROOT, SF01
from pyspark.sql import functions as F

sys.path.insert(0, f"{ROOT}/tools")
import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, duck  # noqa: E402
from sessionscope.functions import numbers  # noqa: E402
from sessionscope.operators import stats  # noqa: E402
from sessionscope.plans import registry  # noqa: E402


def status(spark, name):
    return compare(spark, SF01, name, entry.queries()[name], entry.oracle_sql()[name], duck(SF01))["status"]


@pytest.mark.parametrize("query,buckets,index,move", [
    ("visit_histogram", "VISIT_BUCKETS", 6, 5), ("visit_histogram", "VISIT_BUCKETS", 8, 2_500_000),
    ("step_histogram", "STEP_BUCKETS", 5, 5), ("session_aggr_stat", "VISIT_BUCKETS", 6, 60),
    ("multi_task_stat", "VISIT_BUCKETS", 6, 60)])
def test_a_moved_edge_turns_the_row_red(spark, monkeypatch, query, buckets, index, move):
    assert status(spark, query) == "ok"
    moved = list(getattr(stats, buckets))
    moved[index] = dataclasses.replace(moved[index], low=moved[index].low + move)
    monkeypatch.setattr(stats, buckets, tuple(moved))
    assert status(spark, query) != "ok"


# midpoints stored below, above and exactly on themselves, and quotients above 1
PAIRS = [(3, 40), (1, 200), (1, 8), (7, 200), (23, 200), (57, 200), (41, 40), (43, 40), (201, 200), (2047, 40), (41001, 40),
         (1, 3), (2, 3), (1, 1000), (0, 5), (5, 5), (7, 0), (10**9 + 7, 3 * 10**9)] + \
        [(2 * m + 1, 200) for m in range(0, 1500, 7)]


def rounded(k, n):
    return float(Decimal(k / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) if n else None


def in_spark(spark):
    frame = spark.createDataFrame([(i, k, n) for i, (k, n) in enumerate(PAIRS)], "i long, k long, n long")
    return [r.r for r in frame.select("i", numbers.ratio_half_up("k", "n").alias("r")).orderBy("i").collect()]


def test_library_and_oracle_round_the_exact_double(spark):
    want = [rounded(k, n) for k, n in PAIRS]
    values = ", ".join(f"({i}, {k}::BIGINT, {n}::BIGINT)" for i, (k, n) in enumerate(PAIRS))
    oracle = duckdb.sql(f"SELECT {registry.half_up_sql('k', 'n')} FROM (VALUES {values}) t(i, k, n) ORDER BY i").fetchall()
    assert [r[0] for r in oracle] == want
    assert in_spark(spark) == want


def test_another_midpoint_rule_differs(spark, monkeypatch):
    want = [rounded(k, n) for k, n in PAIRS]
    monkeypatch.setattr(numbers, "ratio_half_up", lambda k, n: F.expr(
        f"round(CAST({k} AS DECIMAL(19,0)) / nullif({n}, 0), 2)").cast("double"))
    assert in_spark(spark) != want


def test_every_bucket_holds_sessions(spark):
    for name in ("visit_histogram", "step_histogram"):
        full = entry.queries()[name](spark, SF01).groupBy("bucket").agg(F.max("sessions").alias("n")).collect()
        assert all(r.n > 0 for r in full)
