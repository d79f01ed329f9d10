"""Results that appear together or not at all.

Outputs are written under the id of their run, which nobody reads yet; one
small commit file then names the run as the current one of its keys (task ids,
dates). Readers take each key's last committed run, so a run that dies between
two outputs leaves the former results whole. Superseded and abandoned runs are
removed by ``clean`` once readers can no longer be using them.

    root/commits/part-….json               one file per publication
    root/data/<output>/run=<id>/<key>=…    rows, partitioned by the key
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# One line per key of a publication, and one without a key that holds the outputs' schemas.
_COMMIT = "sequence long, run string, key string, note string, schemas map<string,string>"


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    files, at = _folder(spark, path)
    return files.exists(at)


def commits(spark: SparkSession, root: str) -> DataFrame:
    """Every commit so far: sequence, run, key, note, schemas."""
    if not _exists(spark, f"{root}/commits"):
        return spark.createDataFrame([], _COMMIT)
    return spark.read.schema(_COMMIT).json(f"{root}/commits")


def current(spark: SparkSession, root: str) -> DataFrame:
    """(key, run, note): the last committed run of every key."""
    return (commits(spark, root).where(F.col("key").isNotNull())
            .groupBy("key").agg(F.max(F.struct("sequence", "run", "note")).alias("last"))
            .select("key", "last.run", "last.note"))


def write_run(outputs: dict[str, DataFrame], root: str, key: str) -> str:
    """Write ``outputs`` under a new run, unseen until it is committed; returns the run's id."""
    run = uuid.uuid4().hex
    for name, df in outputs.items():
        # a file or a few for every key; adaptive execution splits a large key's rows
        df.hint("rebalance", key).write.partitionBy(key).parquet(f"{root}/data/{name}/run={run}")
    return run


def commit(spark: SparkSession, root: str, run: str, schemas: dict[str, str], keys: dict[str, str | None]) -> None:
    """Make ``run`` the current one of ``keys`` (each with a note or none): one file, there or not there."""
    last = commits(spark, root).agg(F.max("sequence")).first()[0] or 0
    rows = [(last + 1, run, k, note, None) for k, note in keys.items()] + [(last + 1, run, None, None, schemas)]
    spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("append").json(f"{root}/commits")


def publish(outputs: dict[str, DataFrame], root: str, key: str, keys: list | dict) -> str:
    """Write all outputs, then commit them together for ``keys``.

    ``key`` is a column of every output. Each of ``keys`` gets exactly its rows
    of this run, also when there are none; other keys keep their runs.
    """
    spark = next(iter(outputs.values())).sparkSession
    run = write_run(outputs, root, key)
    noted = keys if isinstance(keys, dict) else dict.fromkeys(keys)
    commit(spark, root, run, {name: df.schema.json() for name, df in outputs.items()},
           {str(k): note for k, note in noted.items()})
    return run


def read_published(spark: SparkSession, root: str, name: str, key: str, only: Column | None = None) -> DataFrame:
    """The rows of ``name`` of every key's last committed run.

    ``only`` (a condition on the column ``key``, which is text) leaves keys out
    before their runs are opened.
    """
    wanted = current(spark, root).select(F.col("key").alias("_key"), "run")
    if only is not None:
        wanted = wanted.withColumnRenamed("_key", "key").where(only).withColumnRenamed("key", "_key")
    pairs = [(r["_key"], r["run"]) for r in wanted.collect()]  # a row per key
    known = [(r.sequence, r.run, r.schemas) for r in
             commits(spark, root).where("schemas IS NOT NULL").select("sequence", "run", "schemas").collect()]
    having = {run for _, run, s in known if name in s}
    if not having:
        raise ValueError(f"nothing published as {name!r} under {root}")
    schema = StructType.fromJson(json.loads(max((q, s[name]) for q, _, s in known if name in s)[1]))
    runs = sorted({run for _, run in pairs} & having)
    if not runs:
        return spark.createDataFrame([], schema)
    rows = (spark.read.schema(StructType(schema.fields).add("run", "string"))
            .option("basePath", f"{root}/data/{name}").parquet(*[f"{root}/data/{name}/run={r}" for r in runs]))
    last = spark.createDataFrame([p for p in pairs if p[1] in having], "_key string, run string")
    return (rows.withColumn("_key", F.col(key).cast("string")).join(last, ["_key", "run"], "left_semi")
            .select(*schema.names))


def clean(spark: SparkSession, root: str, keep_hours: float = 24.0) -> list[str]:
    """Remove the runs that are no key's current one and older than ``keep_hours``; returns their ids.

    The grace period is for readers of a superseded run and for runs that are still being written.
    """
    if not _exists(spark, f"{root}/data"):
        return []
    live = {r.run for r in current(spark, root).select("run").distinct().collect()}
    before = (time.time() - keep_hours * 3600) * 1000
    files, at = _folder(spark, f"{root}/data")
    removed = set()
    for output in files.listStatus(at):
        for folder in files.listStatus(output.getPath()):
            run = folder.getPath().getName().removeprefix("run=")
            if run not in live and folder.getModificationTime() <= before:
                files.delete(folder.getPath(), True)
                removed.add(run)
    return sorted(removed)
