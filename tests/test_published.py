import os
import time

import pytest
from pyspark.sql import functions as F

from sessionscope.sources.published import clean, current, publish, read_published, write_run


def _rows(spark, rows):
    return spark.createDataFrame(rows, "task_id long, v string")


def _read(spark, root, name="a", **kw):
    return sorted(map(tuple, read_published(spark, root, name, "task_id", **kw).collect()))


def test_each_key_shows_its_last_run(spark, tmp_path):
    root = str(tmp_path)
    publish({"a": _rows(spark, [(1, "x"), (2, "y")]), "b": _rows(spark, [(1, "x")])}, root, "task_id", [1, 2])
    publish({"a": _rows(spark, [(2, "z"), (2, "zz")]), "b": _rows(spark, [])}, root, "task_id", [2])
    assert _read(spark, root) == [(1, "x"), (2, "z"), (2, "zz")] and _read(spark, root, "b") == [(1, "x")]
    publish({"a": _rows(spark, []), "b": _rows(spark, [])}, root, "task_id", [1])       # no rows are rows too
    assert _read(spark, root) == [(2, "z"), (2, "zz")] and _read(spark, root, "b") == []
    assert _read(spark, root, only=F.col("key") == "1") == []


def test_a_run_that_dies_between_two_outputs_is_not_seen(spark, tmp_path):
    root = str(tmp_path)
    publish({"a": _rows(spark, [(1, "old")]), "b": _rows(spark, [(1, "old")])}, root, "task_id", [1])
    dies = F.udf(lambda v: 1 / 0, "string")
    with pytest.raises(Exception, match="ZeroDivisionError"):
        publish({"a": _rows(spark, [(1, "new")]), "b": _rows(spark, [(1, "new")]).withColumn("v", dies("v"))},
                root, "task_id", [1])
    assert _read(spark, root) == [(1, "old")] == _read(spark, root, "b")
    publish({"a": _rows(spark, [(1, "new")]), "b": _rows(spark, [(1, "new")])}, root, "task_id", [1])
    assert _read(spark, root) == [(1, "new")] == _read(spark, root, "b")


def test_old_and_abandoned_runs_are_removed(spark, tmp_path):
    root = str(tmp_path)
    old = publish({"a": _rows(spark, [(1, "old")])}, root, "task_id", [1])
    kept = publish({"a": _rows(spark, [(2, "two")])}, root, "task_id", [2])
    new = publish({"a": _rows(spark, [(1, "new")])}, root, "task_id", [1])
    lost = write_run({"a": _rows(spark, [(1, "lost")])}, root, "task_id")
    assert clean(spark, root) == []                           # all too young
    time.sleep(0.01)
    assert clean(spark, root, keep_hours=0) == sorted([old, lost])
    assert {d.removeprefix("run=") for d in os.listdir(f"{root}/data/a")} == {kept, new}
    assert _read(spark, root) == [(1, "new"), (2, "two")]
    assert {r.key: r.run for r in current(spark, root).collect()} == {"1": new, "2": kept}


def test_unknown_outputs_and_empty_roots(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing published"):
        read_published(spark, str(tmp_path), "a", "task_id")
    assert clean(spark, str(tmp_path)) == []
    publish({"a": _rows(spark, [])}, str(tmp_path), "task_id", [])
    assert read_published(spark, str(tmp_path), "a", "task_id").dtypes == [("task_id", "bigint"), ("v", "string")]
    with pytest.raises(ValueError, match="'b'"):
        read_published(spark, str(tmp_path), "b", "task_id")
