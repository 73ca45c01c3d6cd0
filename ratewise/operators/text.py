"""Text features: tokens, stop words, vocabulary filters, exact TF-IDF,
hashed TF-IDF (C7, C8, F1-F3).  Synonym expansion (D10, F9) is in
``ratewise.plans.content.expanded``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions.columns import category_spaces, whitespace_tokens


def category_tokens(items: DataFrame) -> DataFrame:
    """C3 + F1: categories -> space-separated text -> whitespace tokens,
    long form (mid, pos, token)."""
    toks = whitespace_tokens(category_spaces("genres"))
    return items.select("mid", F.posexplode(toks).alias("pos", "token")).where(F.col("token") != "")


def filter_terms(terms: DataFrame, stop_words: DataFrame | None = None,
                 vocabulary: DataFrame | None = None) -> DataFrame:
    """Drop stop words (anti join) and keep vocabulary words (semi
    join).  Both are joins, so neither list has to fit in driver memory;
    Catalyst broadcasts a side only when its measured size allows."""
    if stop_words is not None:
        terms = terms.join(stop_words.select(F.col("word").alias("term")), "term", "left_anti")
    if vocabulary is not None:
        terms = terms.join(vocabulary.select(F.col("word").alias("term")).distinct(), "term", "left_semi")
    return terms


def term_counts(terms: DataFrame, id_col: str) -> DataFrame:
    """F2 (exact vocabulary): term frequency per (id, term)."""
    return terms.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def idf_weights(tf: DataFrame, id_col: str, n_docs: Column | None = None) -> DataFrame:
    """idf = ln((m + 1) / (df + 1)), m documents, df documents with the
    term; ``n_docs`` defaults to the number of ids in ``tf``."""
    m = n_docs if n_docs is not None else tf.select(F.count_distinct(id_col)).scalar()
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.select("term", "df", F.ln((m + F.lit(1.0)) / (F.col("df") + F.lit(1.0))).alias("idf"))


def tfidf(tf: DataFrame, id_col: str, n_docs: Column | None = None) -> DataFrame:
    """F2 + F3: (id, term, tf, df, w = tf * idf)."""
    idf = idf_weights(tf, id_col, n_docs)
    return tf.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))


def hashed_tfidf(docs: DataFrame, id_col: str, tokens_col: str, num_features: int) -> DataFrame:
    """F2 + F3 parity mode: MLlib ``HashingTF(numFeatures)`` + ``IDF``.
    Collisions included, as in the reference; output (id, features)."""
    from pyspark.ml.feature import IDF, HashingTF
    tfv = HashingTF(inputCol=tokens_col, outputCol="_tf", numFeatures=num_features).transform(docs)
    model = IDF(inputCol="_tf", outputCol="features").fit(tfv)
    return model.transform(tfv).select(id_col, "features")
