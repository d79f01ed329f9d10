"""Session statistics: counts, bucket histograms, ratios.

One global aggregate computes the session count and all fifteen bucket
counts (partial per task, one row exchanged per task, one final row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionscope.functions.buckets import STEP_BUCKETS, VISIT_BUCKETS, bucket_sql
from sessionscope.functions.numbers import ratio_half_up


def _count_aggs():
    aggs = [F.count(F.lit(1)).alias("session_count")]
    aggs += [F.expr(f"count_if({bucket_sql('visit_length', b)})").alias(f"visit_{b.name}")
             for b in VISIT_BUCKETS]
    aggs += [F.expr(f"count_if({bucket_sql('step_length', b)})").alias(f"step_{b.name}")
             for b in STEP_BUCKETS]
    return aggs


def bucket_counts(sessions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Session count and the 15 bucket counts (``visit_1s_3s`` … ``step_60``),
    overall or per ``by`` key."""
    if by:
        return sessions.groupBy(*by).agg(*_count_aggs())
    return sessions.agg(*_count_aggs())


def ratios_from_counts(counts: DataFrame, task_id=None) -> DataFrame:
    """Counts to the session_aggr_stat record: count and 15 rounded ratios."""
    keys = [c for c in counts.columns if c == "task_id"]
    cols = [F.col(k) for k in keys]
    if task_id is not None and not keys:
        cols.append(F.lit(task_id).cast("long").alias("task_id"))
    cols.append(F.col("session_count"))
    cols += [ratio_half_up(f"visit_{b.name}", "session_count").alias(f"visit_length_{b.name}_ratio")
             for b in VISIT_BUCKETS]
    cols += [ratio_half_up(f"step_{b.name}", "session_count").alias(f"step_length_{b.name}_ratio")
             for b in STEP_BUCKETS]
    return counts.select(*cols)


def session_aggr_stat(sessions: DataFrame, task_id=None) -> DataFrame:
    """One row: session count and the 15 ratios (NULL ratios when empty)."""
    return ratios_from_counts(bucket_counts(sessions), task_id)
