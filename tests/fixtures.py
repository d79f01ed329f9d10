"""Hand-written action and user rows (text form, as an upstream log has them)."""

from __future__ import annotations

import datetime as dt

from sessionscope.sources.schemas import RAW_ACTION_SCHEMA, USER_SCHEMA
from sessionscope.sources.tables import normalize_actions

DAY = "2024-01-01"


def t(seconds: int) -> str:
    """Action time ``seconds`` after 2024-01-01 05:00:00, written with a
    one-digit hour where it has one."""
    base = dt.datetime(2024, 1, 1, 5, 0, 0) + dt.timedelta(seconds=seconds)
    return f"{base:%Y-%m-%d} {base.hour}:{base:%M:%S}"


def action(session, user, seconds, keyword=None, category=None, page=0,
           order_ids=None, pay_ids=None, time_text=None):
    return (DAY, user, session, page, time_text or t(seconds), keyword, category, None,
            order_ids, None, pay_ids, None)


def actions_df(spark, rows):
    return normalize_actions(spark.createDataFrame(rows, RAW_ACTION_SCHEMA))


def users_df(spark, rows):
    return spark.createDataFrame(rows, USER_SCHEMA)


def user(uid, age=30, professional="p1", city="c1", sex="male"):
    return (uid, f"user{uid}", f"name{uid}", age, professional, city, sex)
