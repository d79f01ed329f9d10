"""Repeatable stratified sample of sessions, and the actions of the sample.

Each start hour gets a quota proportional to its share of its day:
``max(1, per_day * sessions_in_hour div sessions_in_day)``; within the hour
sessions are ranked by ``md5(session_id || seed)`` (ties by session id) and
the first ``quota`` are taken. The same seed gives the same sample on any
cluster and partitioning.

Hashes are even, so the quota of an hour almost surely lies below a bound on
the hash that follows from quota and count. Only sessions under the bound are
ranked: rows in proportion to the sample, not to the hour. An hour that falls
short of its quota there is ranked in full, so the sample never depends on luck.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionscope.functions.timefmt import date_hour, format_date
from sessionscope.session import ensure_checkpoint_dir

NO_TIME = "none"  # the stratum of sessions without a start time
SPARE = 4.0       # standard deviations between the quota and the expected number under the bound
_HASHES = float(1 << 60)


def _bound(quota: Column, count: Column, spare: float) -> Column:
    """The share of the hash space that holds ``quota`` of ``count`` hashes almost surely."""
    return F.least(F.lit(1.0), (quota + F.lit(spare) * F.sqrt(quota) + F.lit(2 * spare)) / count)


def random_extract(sessions: DataFrame, per_day: int, seed: str | Column = "0", by: tuple[str, ...] = (),
                   spare: float = SPARE) -> DataFrame:
    """Sessions sampled per start hour, with ``date_hour``, ``rank`` and
    ``quota`` columns added (see the module notes for the rule).

    Sessions without a start time form one more stratum, ``date_hour``
    ``NO_TIME``, with the quota of a day of its own. With ``by`` (such as the
    task) every group of its columns is sampled by itself; ``seed`` may be a
    column.
    """
    if per_day < 0:
        raise ValueError("per_day must be non-negative")
    by, seed = list(by), F.lit(seed) if isinstance(seed, str) else seed
    ensure_checkpoint_dir(sessions.sparkSession)
    # a few columns of every session, written once: hours are counted and
    # sessions ranked from them; the rest of the sample is fetched by its ids
    digest = F.md5(F.concat(F.col("session_id"), seed.cast("string")))
    narrow = sessions.select(*by, "session_id", digest.alias("_md5"),
                             F.coalesce(date_hour(F.col("start_time")), F.lit(NO_TIME)).alias("date_hour"),
                             F.coalesce(format_date(F.col("start_time")), F.lit(NO_TIME)).alias("_day")) \
        .checkpoint(eager=True)
    hours = narrow.groupBy(*by, "date_hour", "_day").agg(F.count("session_id").alias("_hour_n"))
    quota = F.greatest(F.lit(1), F.call_function("div", F.lit(per_day) * F.col("_hour_n"), F.col("_day_n")))
    quotas = (hours.withColumn("_day_n", F.sum("_hour_n").over(Window.partitionBy(*by, "_day")))
              .withColumn("quota", quota)
              .select(*by, "date_hour", "quota", "_hour_n", _bound(F.col("quota"), F.col("_hour_n"), spare).alias("_bound"))
              .checkpoint(eager=True))
    under = F.conv(F.substring("_md5", 1, 15), 16, 10).cast("double") < F.col("_bound") * F.lit(_HASHES)
    rows = narrow.drop("_day").join(quotas, [*by, "date_hour"])
    order = Window.partitionBy(*by, "date_hour").orderBy("_md5", "session_id")
    cap = max(1, per_day)  # no quota is larger; a constant limit is taken before the shuffle too

    def first(candidates: DataFrame) -> DataFrame:
        ranked = candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= cap)
        return ranked.where(F.col("rank") <= F.col("quota")).select(*by, "session_id", "date_hour", "rank", "quota")

    sample = first(rows.where(under)).checkpoint(eager=True)
    short = (quotas.join(sample.groupBy(*by, "date_hour").agg(F.count("*").alias("_got")), [*by, "date_hour"], "left")
             .where(F.coalesce(F.col("_got"), F.lit(0)) < F.least("quota", "_hour_n")).select(*by, "date_hour"))
    if not short.isEmpty():
        again = first(rows.join(short, [*by, "date_hour"], "left_semi"))
        sample = sample.join(short, [*by, "date_hour"], "left_anti").unionByName(again)
    return sessions.join(sample, [*by, "session_id"])


def session_detail(actions: DataFrame, extracted: DataFrame) -> DataFrame:
    """All actions of the extracted sessions.

    The sample holds at most ``max(1, per_day)`` sessions per start hour, but
    the number of hours grows with the range, so no broadcast is forced: the
    sample is the output of a shuffle stage, adaptive execution measures it
    and broadcasts it only under ``spark.sql.adaptive.autoBroadcastJoinThreshold``;
    otherwise both sides are shuffled on ``session_id``.
    """
    return actions.join(extracted.select("session_id"), "session_id", "left_semi")
