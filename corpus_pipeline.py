"""From raw documents to packed training sequences, in five stages.

1. language ID: documents that no language model explains go;
2. SimHash near-duplicates: one document of each group stays, the one with the
   smallest doc_id;
3. benchmark decontamination: documents that hold benchmark items go;
4. PII: spans are replaced by their kind;
5. packing: the documents' pieces are placed in sequences.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``, in their order and types, whatever other columns it has.
Null and empty texts have no language and go in the first stage. Documents
without a doc_id are told apart by their text and give way to any near copy
that has one. Of rows that repeat a doc_id one stays, the smallest by its
other columns. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sessionscope.llm import decontamination, langid, packing, pii, simhash
from sessionscope.llm.common import materialise, read_table
from sessionscope.llm.queries import vocabulary

_KEY = "key of the document"
_UNNAMED = 1 << 62  # ids from here on stand for documents without one


def _columns(docs: DataFrame) -> list:
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def _plain(docs: DataFrame) -> DataFrame:
    """``docs`` with every column but the text under a name that nothing else has."""
    return docs.select(*(c if name == "text" else c.alias(f"column {i}")
                         for i, (name, c) in enumerate(zip(docs.columns, _columns(docs)))))


def _restored(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*(F.col("text") if name == "text" else F.col(f"`column {i}`").alias(name)
                          for i, name in enumerate(docs.columns)))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models recognise; they learn from the labelled ones."""
    found = langid.identify(_plain(docs), langid.fit(docs))
    return _restored(found.where(~F.col("rejected")), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    unnamed = F.pmod(F.xxhash64("text"), F.lit(_UNNAMED)) + F.lit(_UNNAMED)
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), unnamed).alias(_KEY),
                        F.struct(*_columns(docs)).alias("document"))
    key = F.col(f"`{_KEY}`")
    found = simhash.near_duplicates(keyed.select(key.alias("doc_id"), F.col("document.text").alias("text")))
    first = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(_KEY)).distinct()
    kept = keyed.join(first, _KEY, "left_semi")
    # whole documents meet only where a key has several
    several = keyed.select(key).groupBy(key).count().where("count > 1").select(key)
    order = F.to_json("document") if "map<" in docs.schema.simpleString() else F.col("document")  # maps have no order
    chosen = kept.join(several, _KEY, "left_semi").groupBy(key).agg(F.min_by("document", order).alias("document"))
    return kept.join(several, _KEY, "left_anti").select("document.*").unionByName(chosen.select("document.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontamination.find(_plain(docs), read_table(spark, sf_dir, "benchmark"))
    return _restored(found.where(~F.col("contaminated")), docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; n_chars follows the text."""
    found = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return found
    kind = docs.schema["n_chars"].dataType
    length = F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
    return found.select(*(length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in found.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and where they lie: see ``packing.pack``."""
    return packing.pack(docs, vocabulary())


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontaminate),
          ("pii", redact), ("packing", pack)]

# Character models, fingerprints and the tokenizer have no SQL form; tests/llm
# holds the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
