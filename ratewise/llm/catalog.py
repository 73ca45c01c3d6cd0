"""Named queries of the training-data operators, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm import (bpe_codec, class_lm, decontaminate, hard_negatives, language_crf, line_dedup, merkle, ngram_join,
                          order_minhash, substring_dedup, token_counts, toxicity, url_rules)

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        LLM_QUERIES[name] = fn
        if sql is not None:
            LLM_ORACLE[name] = sql
        return fn
    return deco


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# -- 1: URL filters ------------------------------------------------------------

#: The rule set of the registered query.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

OP1_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(rule, rhost, rpath, v) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), numbered AS (SELECT row_number() OVER () AS rid, * FROM parts),
best AS (
  SELECT rid, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v
  FROM numbered JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY rid
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM numbered LEFT JOIN best USING (rid)
"""


@_query("op1_url_filters", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest matching (host, path) rule and verdict of every page url."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_rules.judge_urls(pages, url_rules.rule_table(spark, URL_RULES))


# -- 2: token counts -------------------------------------------------------------

@_query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every whole document text."""
    return token_counts.token_counts(_documents(spark, sf_dir))


# -- 3: n-gram Jaccard join --------------------------------------------------------

@_query("op3_ngram_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle set size and component of every whole document (5 words, 80 %)."""
    return ngram_join.jaccard_components(_documents(spark, sf_dir))


# -- 4: language ID ------------------------------------------------------------------

@_query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document text, learned from the documents that aren't held out."""
    docs = _documents(spark, sf_dir)
    out = language_crf.held_out(F.col("doc_id"))
    model = language_crf.fit(docs, where=~out)
    return (language_crf.identify(docs, model).withColumn("held_out", out)
            .select("doc_id", "held_out", "lang_pred", "score"))


# -- 5: benchmark decontamination ----------------------------------------------------

@_query("op5_benchmark_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it contains, with the best window."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(_documents(spark, sf_dir), items).drop("th")


# -- 6: substring dedup --------------------------------------------------------------

@_query("op6_substring_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document without the 20-word passages that occur earlier."""
    return (substring_dedup.dedup_substrings(_documents(spark, sf_dir))
            .select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")))


# -- 7: byte-level BPE -------------------------------------------------------------

@_query("op7_byte_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document text and the bytes they decode to, as digests."""
    return bpe_codec.round_trip(_documents(spark, sf_dir))


# -- 8: line dedup -----------------------------------------------------------------

@_query("op8_line_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document without the lines that are like an earlier line."""
    return line_dedup.clean_lines(_documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_removed")


# -- 9: LM scoring -----------------------------------------------------------------

@_query("op9_lm_scoring")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-based log10 probability of every whole document, learned from nine folds of ten."""
    return class_lm.score_documents(_documents(spark, sf_dir), class_lm.held_out(F.col("doc_id")))


# -- 10: document fingerprints --------------------------------------------------------

@_query("op10_document_fingerprints")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash of every whole document and of its edited text, and their likeness."""
    return order_minhash.document_fingerprints(_documents(spark, sf_dir))


# -- 11: Merkle dataset manifest ----------------------------------------------------

_FIELDS_SQL = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
_A_TO_Z = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# crc32 of the decimal id: eight bit steps for each byte (3988292384 is the polynomial, reversed)
OP11_SQL = f"""
WITH RECURSIVE crc(doc_id, rest, left_bits, c) AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, CASE WHEN left_bits = 0 THEN substr(rest, 2) ELSE rest END, CASE WHEN left_bits = 0 THEN 8 ELSE left_bits - 1 END,
         CASE WHEN left_bits = 0 THEN xor(c, CAST(ord(rest) AS BIGINT))
              WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS BIGINT)) ELSE c // 2 END
  FROM crc WHERE rest <> '' OR left_bits > 0
), changed AS (
  SELECT doc_id AS cid FROM crc WHERE rest = '' AND left_bits = 0 AND xor(c, CAST(4294967295 AS BIGINT)) % 5 = 0
), hashed AS (
  SELECT doc_id, source, sha256({_FIELDS_SQL.replace("{text}", "text")}) AS leaf,
         CASE WHEN doc_id IN (SELECT cid FROM changed) THEN sha256({_FIELDS_SQL.replace("{text}", _A_TO_Z)}) END AS bad
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n
  FROM hashed
), tree(source, level, idx, hash, n) AS (
  SELECT source, 0, pos, leaf, n FROM leaves
  UNION ALL
  SELECT source, level + 1, idx // 16, sha256(string_agg(hash, '' ORDER BY idx)), (n + 15) // 16
  FROM tree WHERE n > 1 GROUP BY source, level, idx // 16, n
), subroots AS (
  SELECT source, hash AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
), top(level, idx, hash, n) AS (
  SELECT 0, pos, subroot, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(hash, '' ORDER BY idx)), (n + 15) // 16 FROM top WHERE n > 1 GROUP BY level, idx // 16, n
), siblings AS (
  SELECT source, level, idx,
         coalesce(string_agg(hash, '') OVER (PARTITION BY source, level, idx // 16 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
         coalesce(string_agg(hash, '') OVER (PARTITION BY source, level, idx // 16 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM tree WHERE n > 1
), top_siblings AS (
  SELECT level, idx,
         coalesce(string_agg(hash, '') OVER (PARTITION BY level, idx // 16 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
         coalesce(string_agg(hash, '') OVER (PARTITION BY level, idx // 16 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM top WHERE n > 1
), up(rid, source, level, idx, x, proof) AS (
  SELECT rid, source, 0, pos, coalesce(bad, leaf), '' FROM leaves
  UNION ALL
  SELECT rid, u.source, u.level + 1, u.idx // 16, sha256(b || x || a), proof || b || a
  FROM up u JOIN siblings s ON u.source IS NOT DISTINCT FROM s.source AND u.level = s.level AND u.idx = s.idx
), at_subroot AS (SELECT rid, source, arg_max(x, level) AS x, arg_max(proof, level) AS proof FROM up GROUP BY rid, source),
over_top(rid, level, idx, x, proof) AS (
  SELECT rid, 0, s.pos, x, proof FROM at_subroot u JOIN subroots s ON u.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT rid, u.level + 1, u.idx // 16, sha256(b || x || a), proof || b || a
  FROM over_top u JOIN top_siblings s ON u.level = s.level AND u.idx = s.idx
), ended AS (SELECT rid, arg_max(x, level) AS folded_root, arg_max(proof, level) AS proof FROM over_top GROUP BY rid)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves l JOIN ended USING (rid) JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source, (SELECT hash AS root FROM top WHERE n = 1)
"""


@_query("op11_merkle_manifest", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof digest and the verdict of the tampering test for every document."""
    return merkle.manifest(_documents(spark, sf_dir), merkle.tampered(F.col("doc_id")), proofs=False)


# -- 12: toxicity --------------------------------------------------------------------

@_query("op12_toxicity")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole document after undoing disguises, learned from four folds of five."""
    docs, out = _documents(spark, sf_dir), toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~out)
    return toxicity.score_documents(docs, model).select("doc_id", out.alias("held_out"), "score", "predicted")


# -- 13: hard-negative mining ---------------------------------------------------------

OP13_SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v, row_number() OVER () AS rid
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.rid, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.v, b.v)]) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.rid <> b.rid WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT rid, anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.rid, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.rid = s.rid AND NOT same
WHERE 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.rid, positive_id ORDER BY score DESC, other_id) <= 5
"""


@_query("op13_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five negatives in the score window of each of an anchor's five positives."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors, F.col("id") % 100 == 0, label)
