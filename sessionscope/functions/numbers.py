"""Ratio rounding.

The statistics report ``part / total`` rounded half-up to two decimals, where
the rounding is applied to the *binary double* nearest the quotient (a decimal
built from that double, then ``HALF_UP``). Away from an exact midpoint
``(2m+1)/200`` this equals exact rational rounding, because the quotient is at
least ``1/(200 n)`` from any midpoint, far more than double error for any
realistic ``n`` (< 10**13). At a midpoint the double lies on it or just above
or below it; that is decided by comparing the double with the midpoint in
exact integers, for quotients of any size below 2**21.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_half_up(part: str, total: str) -> Column:
    """``round_half_up(part / total, 2)`` as a double; NULL when total is 0.

    ``part`` and ``total`` name non-negative integer columns (or are SQL
    expressions over them). One SQL expression keeps plan building cheap.
    """
    k, n = f"CAST({part} AS BIGINT)", f"nullif(CAST({total} AS BIGINT), 0)"  # NULL divisor, NULL ratio
    hundredths = f"((200 * {k}) div (2 * {n}))"
    # scaled by a power of two the double becomes an exact integer
    below = " OR ".join(
        f"({k} >= {low} * {n} AND {k} < {high} * {n} AND "
        f"CAST(CAST(CAST({k} AS DOUBLE) / {n} * {2 ** bits}D AS BIGINT) AS DECIMAL(19, 0)) * 200 "
        f"< CAST(2 * {hundredths} + 1 AS DECIMAL(19, 0)) * CAST({2 ** bits} AS DECIMAL(19, 0)))"
        for low, high, bits in ((0, 1, 60), (1, 512, 52), (512, 1 << 21, 42)))
    return F.expr(
        f"CAST(CASE WHEN (200 * {k}) % (2 * {n}) = {n} AND ({below}) THEN {hundredths} "
        f"ELSE (200 * {k} + {n}) div (2 * {n}) END AS DOUBLE) / CAST(100 AS DOUBLE)")
