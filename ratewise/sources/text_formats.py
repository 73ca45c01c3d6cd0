"""Delimited-text inputs.

Each parser takes a DataFrame of raw lines (column ``line``; this is what
``read_lines`` returns for text files, split across tasks by the file
source) and returns typed rows; files that are plainly delimited go through
``text_files.scan_delimited``.  Fields are cut with ``split`` / ``get`` /
``try_cast`` column expressions, so parsing stays in whole-stage codegen
and a malformed field becomes NULL instead of failing the task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.columns import unquote

# Field layouts of the reference's input files.
# comma outside double quotes (lookahead: an even number of quotes follows)
QUOTE_AWARE_COMMA = r',(?=([^"]*"[^"]*")*[^"]*$)'
V2_COMMENT_FIELDS = 14


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) -> one row per line, column ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def drop_header(lines: DataFrame, header: str | Column) -> DataFrame:
    """A4: remove every line equal to the header line."""
    h = F.lit(header) if isinstance(header, str) else header
    return lines.where(F.col("line") != h)


def file_header(spark: SparkSession, path: str) -> Column:
    """First line of a text file as a scalar subquery column."""
    return read_lines(spark, path).limit(1).select("line").scalar()


def java_split(line, sep_regex: str) -> Column:
    """``String.split(regex)`` semantics: trailing empty fields dropped."""
    c = F.col(line) if isinstance(line, str) else line
    parts = F.split(c, sep_regex, -1)
    # drop trailing empty strings: reverse, drop leading empties, reverse
    rev = F.reverse(parts)
    first_non_empty = F.array_position(F.transform(rev, lambda x: x != F.lit("")), F.lit(True))
    kept = F.when(first_non_empty == 0, F.array().cast("array<string>")) \
            .otherwise(F.slice(rev, F.greatest(first_non_empty, F.lit(1)).cast("int"), F.size(rev)))
    return F.reverse(kept)


def quoted_fields(line="line") -> Column:
    """A5 + A6: split on commas outside quotes (trailing empties kept),
    then unquote each field."""
    c = F.col(line) if isinstance(line, str) else line
    return F.transform(F.split(c, QUOTE_AWARE_COMMA, -1), unquote)


def parse_quoted_items(lines: DataFrame, header: str = "") -> DataFrame:
    """A4-A6 + A10 over quoted item lines ``"mid","name","minutes","tag"``."""
    f = quoted_fields()
    return (drop_header(lines, header)
            .select(F.get(f, 0).try_cast("int").alias("mid"),
                    F.get(f, 1).alias("name"),
                    F.get(f, 2).alias("timelong"),
                    F.get(f, 3).alias("tag")))


def valid_items(items: DataFrame, minutes: str = "timelong", year: str = "year") -> DataFrame:
    """Duration string not ``0.0`` and integer year <= 2021."""
    return items.where((F.col(minutes) != "0.0") & (F.col(year).try_cast("int") <= 2021))


def naive_field_count(line="line") -> Column:
    """Number of fields of a plain comma split, trailing empties dropped."""
    c = F.col(line) if isinstance(line, str) else line
    return F.size(java_split(c, ","))


def parse_v2_ratings(lines: DataFrame, header: str = "") -> DataFrame:
    """A8 + A10: comment lines with exactly 14 naive fields and a score;
    fields 8 uid, 4 mid, 9 score, 0 time (quote-aware, unquoted)."""
    f = quoted_fields()
    return (drop_header(lines, header)
            .where(naive_field_count() == V2_COMMENT_FIELDS)
            .select(F.get(f, 8).try_cast("int").alias("uid"),
                    F.get(f, 4).try_cast("int").alias("mid"),
                    F.get(f, 9).alias("score_s"),
                    F.get(f, 0).alias("timestamp"))
            .where(F.col("score_s") != "")
            .select("uid", "mid", F.col("score_s").try_cast("double").alias("score"), "timestamp"))


def parse_v2_comments(lines: DataFrame, header: str = "") -> DataFrame:
    """A9 + A10: comment lines with exactly 14 naive fields."""
    f = quoted_fields()
    return (drop_header(lines, header)
            .where(naive_field_count() == V2_COMMENT_FIELDS)
            .select(F.get(f, 8).try_cast("int").alias("uid"),
                    F.get(f, 4).try_cast("int").alias("mid"),
                    F.get(f, 1).alias("content"),
                    F.get(f, 0).alias("timestamp")))


def parse_word_vectors(lines: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``word f1 f2 ... fn`` -> (word, array<float>), with the columns to keep."""
    p = F.split(F.trim(F.col("line")), " ")
    return lines.select(*(keep or []), F.get(p, 0).alias("word"),
                        F.transform(F.slice(p, 2, F.size(p) - 1), lambda x: x.try_cast("float")).alias("vec"))


def checked_word_vectors(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of word-vector lines: a line with a component that is no number is a reject."""
    p = F.split(F.trim(F.col("line")), " ")
    parsed = parse_word_vectors(lines.withColumn("_n", F.size(p) - 1), keep=["line", "_n"])
    whole = (F.col("_n") > 0) & ~F.exists("vec", lambda x: x.isNull())
    return parsed.where(whole).select("word", "vec"), parsed.where(~whole).select("line")
