"""Reading the action log and the user table.

The caller's session decides where tables live: a catalog table name is read
with ``spark.table`` (Hive or any catalog), anything else as a path in the
given format. Raw action logs keep dates and times as text; ``normalize_actions``
types them once at the edge.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionscope.functions.timefmt import DATE_FORMAT, parse_action_time
from sessionscope.sources.schemas import ACTION_SCHEMA, USER_SCHEMA

USER_COLUMNS = ("user_id", "age", "professional", "city", "sex")


def read_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table (``db.table`` or a bare name) or a path."""
    if "/" not in source and spark.catalog.tableExists(source):
        return spark.table(source)
    return spark.read.format(fmt).load(source)


def normalize_actions(raw: DataFrame) -> DataFrame:
    """Raw action log (text date and time) to the library's action schema.

    ``action_id`` is kept when present; otherwise it is a hash of the whole
    row, which is stable under re-execution and only ties for identical rows.
    """
    cols = raw.columns
    action_id = F.col("action_id") if "action_id" in cols else F.xxhash64(*[F.col(c) for c in cols])
    date_col = F.col("date")
    if dict(raw.dtypes).get("date") == "string":
        date_col = F.try_to_timestamp(date_col, F.lit(DATE_FORMAT)).cast("timestamp_ntz").cast("date")
    time_col = F.col("action_time")
    if dict(raw.dtypes).get("action_time") == "string":
        time_col = parse_action_time(time_col)
    typed = raw.withColumns({"action_id": action_id, "date": date_col, "action_time": time_col})
    return typed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ACTION_SCHEMA.fields])


def read_actions(spark: SparkSession, source: str, fmt: str = "parquet",
                 start: str | dt.date | None = None, end: str | dt.date | None = None) -> DataFrame:
    """The action log; with ``start`` and ``end`` only those dates.

    A log that keeps dates as text is filtered on the text before it is typed
    (``yyyy-MM-dd`` sorts like the date), so the bounds reach the scan.
    """
    raw = read_table(spark, source, fmt)
    if start is None or end is None:
        return normalize_actions(raw)
    if dict(raw.dtypes).get("date") == "string":
        raw = raw.where(F.col("date").between(as_date(start).isoformat(), as_date(end).isoformat()))
    actions = normalize_actions(raw)
    return actions.where(date_range_predicate(F.col("date"), start, end))


def read_users(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    users = read_table(spark, source, fmt)
    return users.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in USER_SCHEMA.fields])


def as_date(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def date_range_predicate(date_col: Column, start: str | dt.date, end: str | dt.date) -> Column:
    """``start <= date <= end``, both ends inclusive."""
    return date_col.between(F.lit(as_date(start)), F.lit(as_date(end)))
