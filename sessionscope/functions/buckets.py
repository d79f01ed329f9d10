"""Visit-length and step-length buckets of the session statistics.

A bucket is ``lower < x <= upper`` with open ends given as ``None``; the
integer edges are written the way the buckets are defined, so ``1s_3s`` is
``1 <= v <= 3`` and ``30s_60s`` is ``30 < v <= 60``. A value of 0 falls in
no bucket, so the bucket counts need not add up to the session count.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Bucket:
    name: str          # suffix used in result columns
    low: int           # inclusive lower edge
    high: int | None   # inclusive upper edge, None for open


# Bucket names and inclusive edges of the result schema.
# Visit length in seconds:
#   1s_3s 1..3, 4s_6s 4..6, 7s_9s 7..9, 10s_30s 10..30, 30s_60s 31..60,
#   1m_3m 61..180, 3m_10m 181..600, 10m_30m 601..1800, 30m 1801..
# Step length in actions:
#   1_3 1..3, 4_6 4..6, 7_9 7..9, 10_30 10..30, 30_60 31..60, 60 61..
VISIT_BUCKETS: tuple[Bucket, ...] = (
    Bucket("1s_3s", 1, 3),
    Bucket("4s_6s", 4, 6),
    Bucket("7s_9s", 7, 9),
    Bucket("10s_30s", 10, 30),
    Bucket("30s_60s", 31, 60),
    Bucket("1m_3m", 61, 180),
    Bucket("3m_10m", 181, 600),
    Bucket("10m_30m", 601, 1800),
    Bucket("30m", 1801, None),
)
STEP_BUCKETS: tuple[Bucket, ...] = (
    Bucket("1_3", 1, 3),
    Bucket("4_6", 4, 6),
    Bucket("7_9", 7, 9),
    Bucket("10_30", 10, 30),
    Bucket("30_60", 31, 60),
    Bucket("60", 61, None),
)


def bucket_sql(value: str, bucket: Bucket) -> str:
    """``value`` lies in ``bucket``, as Spark SQL text for ``count_if`` (NULL never does)."""
    if bucket.high is None:
        return f"{value} >= {bucket.low}"
    return f"{value} BETWEEN {bucket.low} AND {bucket.high}"
