"""Task-parameter predicates on session records.

Each predicate is a Column; an absent parameter contributes ``true``. The
age range applies only when both bounds are given. A NULL attribute never
matches. Because they are plain column predicates, Catalyst pushes the
user-attribute ones below the user join to the user scan.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionscope.sources.tasks import TaskParams


def age_predicate(p: TaskParams) -> Column | None:
    if p.start_age is None or p.end_age is None:
        return None
    return F.col("age").between(F.lit(p.start_age), F.lit(p.end_age))


def professional_predicate(p: TaskParams) -> Column | None:
    return F.col("professional").isin(list(p.professionals)) if p.professionals is not None else None


def city_predicate(p: TaskParams) -> Column | None:
    return F.col("city").isin(list(p.cities)) if p.cities is not None else None


def sex_predicate(p: TaskParams) -> Column | None:
    return (F.col("sex") == F.lit(p.sex)) if p.sex is not None else None


def keyword_predicate(p: TaskParams) -> Column | None:
    if p.keywords is None:
        return None
    wanted = F.array(*[F.lit(k) for k in p.keywords]).cast("array<string>")
    return F.coalesce(F.arrays_overlap(F.col("search_keywords"), wanted), F.lit(False))


def category_predicate(p: TaskParams) -> Column | None:
    if p.category_ids is None:
        return None
    wanted = F.array(*[F.lit(int(c)) for c in p.category_ids]).cast("array<bigint>")
    return F.coalesce(F.arrays_overlap(F.col("click_category_ids"), wanted), F.lit(False))


USER_PREDICATES = (age_predicate, professional_predicate, city_predicate, sex_predicate)
SESSION_PREDICATES = (keyword_predicate, category_predicate)


def conjunction(preds: list[Column | None]) -> Column:
    present = [c for c in preds if c is not None]
    return reduce(and_, present, F.lit(True))


def user_predicate(p: TaskParams) -> Column:
    return conjunction([f(p) for f in USER_PREDICATES])


def session_predicate(p: TaskParams) -> Column:
    """All parameter predicates, age through categories."""
    return conjunction([f(p) for f in USER_PREDICATES + SESSION_PREDICATES])


def keyword_match(p: TaskParams) -> Column | None:
    """Aggregate over a session's actions: does one search a wanted keyword?"""
    return None if p.keywords is None else \
        F.coalesce(F.bool_or(F.col("search_keyword").isin(list(p.keywords))), F.lit(False))


def category_match(p: TaskParams) -> Column | None:
    """Aggregate over a session's actions: does one click a wanted category?"""
    return None if p.category_ids is None else \
        F.coalesce(F.bool_or(F.col("click_category_id").isin(list(p.category_ids))), F.lit(False))


def filter_sessions(sessions: DataFrame, p: TaskParams) -> DataFrame:
    return sessions.where(session_predicate(p))
