"""Tables, the shared scratch folder and Arrow batch helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (any path Spark can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    A scratch folder is chosen only for a local session that names none (as in
    tests); on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage.

    The written files survive the loss of any executor, and later plans read
    them instead of computing ``df`` again.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)), F.lit(-1))


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow string column as UTF-8; null reads as empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def rows(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def column(name: str) -> Column:
    """The column of this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def carried(docs: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str], int]:
    """``columns`` of ``docs`` under plain names for an Arrow function, their fields, and where it finds the text.

    A text that is among them is not sent twice.
    """
    names = [f"kept {i}" for i in range(len(columns))]
    kept = docs.select(*(column(c).alias(n) for c, n in zip(columns, names)))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    place = columns.index("text") if "text" in columns else len(columns)
    if place < len(columns) and kept.schema[names[place]].dataType.simpleString() == "string":
        return kept, fields, place
    text = F.col("text").cast("string").alias("text read")
    return docs.select(*(column(c).alias(n) for c, n in zip(columns, names)), text), fields, len(columns)


def restored(found: DataFrame, columns: list[str], added: list[str]) -> DataFrame:
    """The result of an Arrow function over ``carried`` columns, under their own names."""
    return found.select(*(F.col(f"`kept {i}`").alias(c) for i, c in enumerate(columns)), *added)
