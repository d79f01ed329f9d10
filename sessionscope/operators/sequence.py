"""Previous row within an ordered group, without one task per group.

A window ``partitionBy(key).orderBy(...)`` sends a whole group to one task; a
group holding a third of all rows would then be sorted by a single task. Here
groups of more than ``max_rows`` rows are cut into slices first:

1. one job counts the rows by key (partial counts per task) and takes, for
   every key above the limit, a sample of its order values, chosen by hash so
   that it is about ``SAMPLE`` values per slice;
2. every so-many-th sampled value becomes a bound. The bounds are *values*:
   which slice a row is in follows from the row alone, wherever and however
   often it is computed;
3. the previous row comes from a window over (key, slice); the first row of a
   slice takes the last row of the slice before it. There are at most
   ``rows / max_rows`` bounds and as many last rows, so both are broadcast.

Without a large group the plan is just the window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_ROWS = 1_000_000  # of one group in one task
SAMPLE = 32           # sampled order values per slice


def _bounds(df: DataFrame, key: str, order: list[str], max_rows: int) -> DataFrame | None:
    """(key, bounds): the order values at which a large group is cut; None without one."""
    large = [(r[0], r[1]) for r in df.where(F.col(key).isNotNull()).groupBy(key)
             .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_rows).collect()]
    if not large:
        return None
    spark = df.sparkSession
    value = F.struct(*[F.col(c) for c in order])
    rates = spark.createDataFrame([(k, max(1, max_rows // SAMPLE)) for k, _ in large],
                                  f"`{key}` {df.schema[key].dataType.simpleString()}, _rate long")
    sample = (df.join(F.broadcast(rates), key)
              .where(F.pmod(F.xxhash64(*order), F.col("_rate")) == 0)
              .select(key, value.alias("_at")).orderBy(key, "_at"))
    cuts: dict = {}
    for r in sample.collect():  # about SAMPLE * rows / max_rows values
        cuts.setdefault(r[0], []).append(r[1])
    rows = [(k, [tuple(v) for v in values[SAMPLE // 2::SAMPLE]]) for k, values in cuts.items()]
    kind = df.select(value.alias("_at")).schema["_at"].dataType.simpleString()
    return spark.createDataFrame(rows, f"`{key}` {df.schema[key].dataType.simpleString()}, _bounds array<{kind}>")


def with_previous(df: DataFrame, key: str, order: list[str], carry: list[str],
                  max_rows: int = MAX_ROWS, prefix: str = "prev_") -> DataFrame:
    """Add ``prefix + c`` for each ``c`` in ``carry``: its value on the
    previous row of the same ``key`` in ``order`` (NULL on a group's first
    row, and where the key is NULL). ``order`` must make rows unique within a
    key."""
    at = F.struct(*[F.col(c) for c in order])
    bounds = _bounds(df, key, order, max_rows)
    # rows without a key have no previous row; they are spread by hash
    unkeyed = F.pmod(F.xxhash64(*order), F.lit(4096)).cast("int")
    if bounds is None:
        w = Window.partitionBy(key, "_slice").orderBy(*order)
        sliced = df.withColumn("_slice", F.when(F.col(key).isNull(), unkeyed).otherwise(0))
        previous = {prefix + c: F.when(F.col(key).isNotNull(), F.lag(c).over(w)) for c in carry}
        return sliced.withColumns(previous).drop("_slice")
    # NULL order values come first, in Spark's ordering of structs as in the window
    passed = F.size(F.filter("_bounds", lambda b: b <= at))
    sliced = df.join(F.broadcast(bounds), key, "left").withColumn(
        "_slice", F.when(F.col(key).isNull(), unkeyed).when(F.col("_bounds").isNull(), 0).otherwise(passed))
    w = Window.partitionBy(key, "_slice").orderBy(*order)
    walked = sliced.withColumns({
        "_first": F.row_number().over(w) == 1,
        **{prefix + c: F.when(F.col(key).isNotNull(), F.lag(c).over(w)) for c in carry}})
    lasts = (sliced.where(F.col("_bounds").isNotNull()).groupBy(key, "_slice")
             .agg(F.max_by(F.struct(*[F.col(c) for c in carry]), at).alias("_last")))
    links = lasts.select(F.col(key).alias("_key"), F.col("_slice").alias("_at_slice"),
                         F.lag("_last").over(Window.partitionBy(key).orderBy("_slice")).alias("_pred"))
    joined = walked.join(F.broadcast(links), F.col("_first") & (F.col(key) == F.col("_key"))
                         & (F.col("_slice") == F.col("_at_slice")), "left")
    linked = {prefix + c: F.when(F.col("_pred").isNotNull(), F.col(f"_pred.{c}")).otherwise(F.col(prefix + c))
              for c in carry}
    return joined.withColumns(linked).select(*df.columns, *linked)
