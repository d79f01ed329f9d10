"""Writing results and reading/writing through JDBC.

Results are keyed by ``task_id``. The parquet sink overwrites only the
partitions of the tasks being written (dynamic partition overwrite), so a
re-run of a task replaces its rows instead of failing or duplicating them.
The JDBC helpers are Spark's own JDBC source and sink; connection settings
always come from the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionscope.functions.buckets import STEP_BUCKETS, VISIT_BUCKETS


def stat_columns_for_storage(stats: DataFrame) -> DataFrame:
    """Rename ``visit_length_1s_3s_ratio`` … to the stored names ``1s_3s`` …"""
    renames = {f"visit_length_{b.name}_ratio": b.name for b in VISIT_BUCKETS}
    renames.update({f"step_length_{b.name}_ratio": b.name for b in STEP_BUCKETS})
    return stats.withColumnsRenamed(renames)


def write_by_task(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Idempotent write: replace the ``task_id`` partitions present in ``df``."""
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy("task_id")
       .format(fmt)
       .save(path))


def write_session_aggr_stat(stats: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_by_task(stat_columns_for_storage(stats), path, fmt)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
               mode: str = "append", batch_size: int | None = None) -> None:
    """Append rows over JDBC; each partition writes in its own transaction,
    in batches of ``batch_size`` statements."""
    writer = df.write.mode(mode)
    if batch_size:
        writer = writer.option("batchsize", str(batch_size))
    writer.jdbc(url=url, table=table, mode=mode, properties=properties)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
              predicates: list[str] | None = None) -> DataFrame:
    """Read a table (or a ``(select …) alias`` subquery) over JDBC; with
    ``predicates`` each one becomes a partition read in parallel."""
    if predicates:
        return spark.read.jdbc(url=url, table=table, predicates=predicates, properties=properties)
    return spark.read.jdbc(url=url, table=table, properties=properties)


def read_tasks_jdbc(spark: SparkSession, url: str, properties: dict[str, str],
                    task_ids: list[int] | None = None) -> DataFrame:
    tasks = read_jdbc(spark, url, "task", properties)
    if task_ids:
        tasks = tasks.where(F.col("task_id").isin(task_ids))   # pushed to the database
    return tasks


_LARGEST = "sessionscope.largest_session"  # table property: rows of the largest session


def save_action_log(actions: DataFrame, table: str, buckets: int, mode: str = "overwrite",
                    path: str | None = None) -> None:
    """Store the action log as a catalog table laid out for the session job:
    partitioned by ``date`` (a date range prunes whole folders) and bucketed
    and sorted by ``session_id`` (the session rollup then reads each
    session's actions from one bucket and needs no shuffle at all).

    The price is that a session's actions all sit in one bucket, read by one
    task; the rows of the largest session are therefore kept with the table,
    and ``read_action_log`` decides by them."""
    spark = actions.sparkSession
    writer = actions.write.mode(mode) if path is None else actions.write.mode(mode).option("path", path)
    (writer.partitionBy("date")
     .bucketBy(buckets, "session_id")
     .sortBy("session_id", "action_time")
     .saveAsTable(table))
    sizes = spark.table(table).where(F.col("session_id").isNotNull()).groupBy("session_id").count()
    largest = sizes.agg(F.max("count")).first()[0] or 0
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_LARGEST}' = '{largest}')")


def read_action_log(spark: SparkSession, table: str, max_session_rows: int = 5_000_000) -> DataFrame:
    """A log stored by ``save_action_log``: bucketed while no session has more than ``max_session_rows`` actions.

    With a larger session the same files are read without their buckets: split
    like any others, so the rollup goes back to partial aggregation before a
    shuffle, which no hot session can unbalance. Dates are pruned either way."""
    stored = spark.table(table)
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if int(kept.get(_LARGEST, 0)) <= max_session_rows:
        return stored
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return spark.read.schema(stored.schema).parquet(about["Location"]).select(*stored.columns)
