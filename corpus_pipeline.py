"""A training-data pipeline over the documents table.

Language ID drops documents without a recognised language; line dedup takes
out lines that are like an earlier line (and documents of which nothing is
left); the n-gram Jaccard join keeps the document of smallest id of each group
of near copies; decontamination drops documents with a benchmark passage; byte-
level BPE encodes what remains.  Every stage is written as Parquet and read
again as the next one's input; all but the last return the columns of
``documents``.

Defined results: null and empty texts leave at the first stage; rows of equal
id are judged by their own text, and of equal rows one stays after the join; very long texts
are read whole by every stage; further columns, of any name, are kept up to the last stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewise.llm import bpe_codec, decontaminate, language_crf, line_dedup, ngram_join
from ratewise.llm.common import free_name, written

#: Least mean probability of a document's language.  Four languages share
#: a probability of 1, so this drops only text that is like none of them.
MIN_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language isn't recognised.

    The model learns from a bounded sample of the labelled documents."""
    model = language_crf.fit(docs)
    name = free_name(docs, "language")
    judged = language_crf.with_language(docs, model, name=name)
    found = (F.col(f"{name}.lang_pred") != language_crf.UNKNOWN) & (F.col(f"{name}.score") >= MIN_SCORE)
    return judged.where(found).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that are like an earlier line; documents left without a word go."""
    n_lines, n_removed = free_name(docs, "n_lines"), free_name(docs, "n_removed")
    clean = line_dedup.clean_lines(docs, names=(n_lines, n_removed))
    left = clean.where((F.col(n_removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near copies: the one of smallest id (a null id
    counts as the largest), and of equal ids that of the smallest text hash."""
    none, kept_id, th, row = (free_name(docs, c) for c in ("none", "kept_id", "th", "row"))
    # a document is an id with a text: a repeated id is judged by each of its texts
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("th")).alias("key")
    found = ngram_join.jaccard_components(docs.select(key, "text"), id_col="key")
    kept = found.where("component_id = doc_id").select(F.col("doc_id.none").alias(none), F.col("doc_id.doc_id").alias(kept_id),
                                                       F.col("doc_id.th").alias("kept_th")).distinct()
    rows = docs.withColumn(th, F.xxhash64("text"))
    same = rows["doc_id"].eqNullSafe(kept[kept_id]) & (rows[th] == kept["kept_th"])
    one = Window.partitionBy("doc_id", th).orderBy(*(F.col(c) for c in docs.columns if c != "text"))
    return rows.join(kept, same, "left_semi").withColumn(row, F.row_number().over(one)).where(F.col(row) == 1).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining texts, checked against the bytes they decode to."""
    both = bpe_codec.encode_and_decode(docs)
    return both.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup_stage), ("ngram_jaccard_join", ngram_jaccard),
          ("benchmark_decontamination", decontamination), ("byte_bpe", byte_bpe)]

#: No SQL twin: the first and the last stage run a trained model and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
