"""Registered queries of the training-data operators, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (collocations, debruijn, decontamination, langid, merkle, ngram_lm, packing, pii, projection_search, quality,
               simhash, suffix_dedup, warc)
from .common import crc_remainder, read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training documents: crc32(doc_id) mod 7 is not 2 (a null id is only scored); those with 6 set the weights."""
    docs = read_table(spark, sf_dir, "documents")
    group = crc_remainder(docs["doc_id"], 7)
    part = F.when(group.isin(2, -1), ngram_lm.SCORE).when(group == 6, ngram_lm.HELD).otherwise(ngram_lm.LEARN)
    found = ngram_lm.score(docs, part)
    return found.select("doc_id", (crc_remainder(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known",
                        "train_tokens", "base_score", "score", "train_types")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                keep=["doc_id"])


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    return found.select("doc_id", *(pii.count(spans, k).alias(f"n_{k}") for k in pii.BASE),
                        F.sha2(pii.listed(spans, pii.BASE).cast("binary"), 256).alias("base_sha256"),
                        pii.listed(spans).alias("spans"), F.transform(spans, lambda s: s["score"]).alias("scores"))


def vocabulary() -> str:
    """The vocabulary file of the packed sequences, as installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), vocabulary())


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models learn from documents whose crc32(doc_id) mod 4 is not 2 (a null id is left out)."""
    docs = read_table(spark, sf_dir, "documents")
    part = crc_remainder(docs["doc_id"], 4)
    models = langid.fit(docs.where(~part.isin(2, -1)))
    found = langid.identify(docs.select("doc_id", "text", (part == 2).alias("held_out")), models,
                            keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), texts=False) \
        .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents"))


def op8_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.paths(read_table(spark, sf_dir, "documents"), texts=False) \
        .select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


def op11_projection_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_search.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering lower-cases A-Z where 3 divides crc32(doc_id) (a null id is left alone)."""
    docs = read_table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = merkle.manifest(docs, tampered=F.when(crc_remainder(F.col("doc_id"), 3) == 0, lowered))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_lm_score, op2_decontamination, op3_pii, op4_pattern_packing, op5_language_id, op6_suffix_dedup,
        op7_quality, op8_debruijn, op9_simhash, op10_warc, op11_projection_search, op12_merkle_manifest,
        op13_collocations)}


_REPEATS_SQL = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, s, md5(substr(h, 2 * s + 1, 400)) AS seq FROM (
    SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 199, 0))) AS s FROM texts)),
repeated AS (SELECT doc_id, s FROM (SELECT *, count(*) OVER (PARTITION BY seq) AS n FROM windows) WHERE n > 1),
runs AS (
  SELECT doc_id, s, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM (
    SELECT *, coalesce(s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) > 200, TRUE) AS new FROM repeated)),
spans AS (SELECT doc_id, run, min(s) AS lo, max(s) + 200 AS hi FROM runs GROUP BY doc_id, run),
pieces AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS upto FROM spans),
joined AS (
  SELECT doc_id, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(hi) AS upto,
         string_agg(substr(h, 2 * upto + 1, 2 * (lo - upto)), '' ORDER BY lo) AS head
  FROM pieces JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT t.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(upto, 0) + 1))) AS kept_sha256
FROM texts t LEFT JOIN joined USING (doc_id)
"""

_WORDS_SQL = r"""
WITH words AS (
  SELECT doc_id, w, pos FROM (
    SELECT doc_id, unnest(l) AS w, generate_subscripts(l, 1) AS pos FROM (
      SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l
      FROM documents))),
windows AS (
  SELECT doc_id, pos, w, CASE WHEN count(*) OVER f = 20 THEN string_agg(w, ' ') OVER f END AS seq FROM words
  WINDOW f AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
firsts AS (
  SELECT doc_id, pos, w, seq IS NOT NULL AND rank() OVER (PARTITION BY seq ORDER BY doc_id, pos) > 1 AS later
  FROM windows),
marked AS (
  SELECT doc_id, pos, w, bool_or(later) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
         AS gone FROM firsts),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(w, ' ' ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""

_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     r AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
                  min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM r
"""


def _merkle_sql(levels: int = 8) -> str:
    """Trees of up to 8 ** ``levels`` nodes."""
    def listed(c: str) -> str:
        return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"

    def tree(name: str, group: str) -> str:
        parts = []
        for k in range(levels):
            many = f"(SELECT {group}, max(pos) > 0 AS more FROM {name}{k} GROUP BY {group})"
            # a run's hash, and each node's siblings in its run
            parts.append(f"""{name}_at{k} AS (
  SELECT t.{group}, t.pos, m.more, t.pos // CASE WHEN m.more THEN 8 ELSE 1 END AS up, t.h,
         coalesce(string_agg(t.h, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(t.h, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k} t JOIN {many} m USING ({group})
  WINDOW r AS (PARTITION BY t.{group}, t.pos // CASE WHEN m.more THEN 8 ELSE 1 END ORDER BY t.pos))""")
            parts.append(f"""{name}{k + 1} AS (
  SELECT {group}, up AS pos, CASE WHEN bool_or(more) THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE min(h) END AS h
  FROM {name}_at{k} GROUP BY {group}, up)""")
        return ",\n".join(parts)

    crc = ("xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda s, e: CASE WHEN e >= 0 THEN xor(s, e) "
           "ELSE xor(s >> 1, (s & 1) * 3988292384) END), 4294967295)")
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    own = " || ".join(map(listed, merkle.FIELDS))
    other = " || ".join(listed(c) if c != "text" else listed(f"({lowered})") for c in merkle.FIELDS)
    folds, at = [], "f0"
    for name, group in (("n", "g"), ("r", "one")):
        for k in range(levels):
            up = f"{at}_{name}{k}"
            place = "pos" if (name, k) != ("r", 0) else "gpos"
            folds.append(f"""{up} AS (
  SELECT p.* EXCLUDE (pos, folded, proof), a.up AS pos, CASE WHEN a.more THEN sha256(a.l || p.folded || a.r) ELSE p.folded END
         AS folded, p.proof || a.l || a.r AS proof
  FROM {at} p JOIN {name}_at{k} a ON a.{group} = p.{group} AND a.pos = p.{place})""")
            at = up
    return f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce('v' || lang, 'n') AS g, sha256({own}) AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN sha256({other}) ELSE sha256({own}) END AS altered
  FROM documents),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
n0 AS (SELECT g, pos, leaf AS h FROM placed),
{tree("n", "g")},
r0 AS (SELECT 1 AS one, row_number() OVER (ORDER BY g) - 1 AS pos, h, g FROM n{levels}),
{tree("r", "one")},
f0 AS (
  SELECT p.doc_id, p.g, p.leaf, p.pos, 1 AS one, r0.pos AS gpos, r0.h AS subroot, p.altered AS folded, '' AS proof
  FROM placed p JOIN r0 ON r0.g = p.g),
{", ".join(folds)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
FROM {at} JOIN r{levels} ON TRUE
"""


_PHRASES_SQL = r"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents WHERE text IS NOT NULL),
pieces AS (
  SELECT row, lang, unnest(l) AS piece, generate_subscripts(l, 1) AS p FROM (
    SELECT row, lang, string_split_regex(text, '[.,;:!?
-]') AS l FROM texts)),
words AS (
  SELECT row, lang, p, unnest(l) AS w, generate_subscripts(l, 1) AS i FROM (
    SELECT row, lang, p, list_filter(string_split_regex(piece, '[ 	]+'), lambda x: x <> '') AS l FROM pieces)),
starts AS (
  SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4 FROM words
  WINDOW o AS (PARTITION BY row, p ORDER BY i)),
f AS MATERIALIZED (
  SELECT lang, w, count(*) AS a FROM (
    SELECT lang, [w1] AS w FROM starts
    UNION ALL SELECT lang, [w1, w2] FROM starts WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3] FROM starts WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3, w4] FROM starts WHERE w4 IS NOT NULL)
  GROUP BY lang, w HAVING count(*) >= 30),
n AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
phrases AS (SELECT * FROM f WHERE len(w) > 1),
cuts AS (SELECT lang, w, a, unnest(range(1, len(w))) AS k FROM phrases),
scores AS (
  SELECT c.lang, c.w, c.a, k, h.a AS l, t.a AS r,
         CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(h.a AS HUGEINT) + t.a) AS BIGINT) AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.w = c.w[1:k] JOIN f t ON t.lang = c.lang AND t.w = c.w[k + 1:]),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
inside AS (
  SELECT lang, w, max(a) AS longer FROM (
    SELECT lang, a, w[i:i + k - 1] AS w FROM (
      SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM (
        SELECT *, unnest(range(2, len(w))) AS k FROM phrases WHERE len(w) > 2))) GROUP BY lang, w),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.w = b.w
  WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank,
         array_to_string(w, ' ') AS phrase, a, l, r, score FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_suffix_dedup": _REPEATS_SQL, "op8_debruijn": _WORDS_SQL, "op10_warc": _WARC_SQL,
            "op12_merkle_manifest": _merkle_sql(), "op13_collocations": _PHRASES_SQL}
