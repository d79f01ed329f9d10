"""The elementary intervals of several tasks' date ranges.

Cutting the calendar at every start and behind every end leaves intervals that
a task covers wholly or not at all. There are fewer than two per task, and a
task covers a run of neighbouring ones, so what sessions did is added up once
per interval, however many tasks overlap there.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionscope.sources.tasks import TaskRow

_EPOCH = dt.date(1970, 1, 1).toordinal()


@dataclass(frozen=True)
class Intervals:
    """Covered intervals as (first, last) days since 1970, and each task's run [a, b] of them."""

    days: list[tuple[int, int]]
    runs: dict[int, tuple[int, int]]

    @property
    def dates(self) -> tuple[dt.date, dt.date] | None:
        """The first and the last covered date."""
        if not self.days:
            return None
        return dt.date.fromordinal(self.days[0][0] + _EPOCH), dt.date.fromordinal(self.days[-1][1] + _EPOCH)

    def place(self, date: Column) -> Column:
        """The interval of a date, NULL on a day of none."""
        day = [dt.date.fromordinal(d + _EPOCH) for lo, hi in self.days for d in (lo, hi)]
        return F.coalesce(*[F.when(date.between(F.lit(lo), F.lit(hi)), F.lit(i))
                            for i, (lo, hi) in enumerate(zip(day[::2], day[1::2]))])

    def calendar(self, spark: SparkSession) -> DataFrame:
        """(date, interval): a row per covered day."""
        rows = spark.createDataFrame([(i, lo, hi) for i, (lo, hi) in enumerate(self.days)],
                                     "interval int, lo int, hi int")
        days = F.transform(F.sequence("lo", "hi"), lambda day: F.date_from_unix_date(day))
        return rows.select(F.explode(days).alias("date"), "interval")

    def table(self, spark: SparkSession) -> DataFrame:
        """(task_id, a, b) of the tasks that cover a day."""
        return spark.createDataFrame([(t, a, b) for t, (a, b) in self.runs.items()], "task_id long, a int, b int")


def elementary_intervals(tasks: list[TaskRow]) -> Intervals:
    """The intervals of the tasks; one whose end lies before its start covers none."""
    spans = {t.task_id: (t.start_date.toordinal() - _EPOCH, t.end_date.toordinal() - _EPOCH + 1)
             for t in tasks if t.start_date <= t.end_date}
    cuts = sorted({d for span in spans.values() for d in span})
    opened = {d: 0 for d in cuts}
    for lo, hi in spans.values():
        opened[lo] += 1
        opened[hi] -= 1
    days, at, covering = [], {}, 0
    for lo, hi in zip(cuts, cuts[1:]):
        at[lo] = len(days)
        covering += opened[lo]
        if covering:
            days.append((lo, hi - 1))
    if cuts:
        at[cuts[-1]] = len(days)
    return Intervals(days, {t: (at[lo], at[hi] - 1) for t, (lo, hi) in spans.items()})
