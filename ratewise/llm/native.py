"""Column expressions for the operators that use DataFrame and SQL functions only.

Filters and frequency sketches are arrays of a fixed size, made by aggregations:
one row, whatever the size of the input.  They are read through a scalar
subquery or, within a higher-order function (where Spark allows no subquery),
as a literal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import BLANKS, WORD_SPLIT


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once.  A plain column would be copied by
    the optimizer into each place that reads it (a filter, each turn of a
    lambda); it doesn't look into a generator."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def split_words(text: Column) -> Column:
    """Words of a text that isn't null; a blank text gives one empty word."""
    return F.split(F.btrim(text, F.lit(BLANKS)), WORD_SPLIT)


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(hashes: str, n: int, k: int = 5) -> Column:
    """Hash of each run of ``k`` word hashes in column ``hashes`` with ``n``
    words (one hash of all of them when there are fewer)."""
    last = F.greatest(F.col(n) - k, F.lit(0)) if isinstance(n, str) else F.greatest(F.size(hashes) - k, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(k))))


def dense(counts: DataFrame, size: int) -> DataFrame:
    """One row with an array of ``size`` longs from (k, v) rows, 0 where a k is missing.

    ``size`` is a fixed number, so is the work of the one task that ends it."""
    spark = counts.sparkSession
    parts = 64
    rows = (spark.range(0, size, 1, 8).select(F.col("id").alias("k"))
                 .join(counts.select(F.col("k").cast("long").alias("k"), F.col("v").cast("long").alias("v")), "k", "left")
                 .select("k", F.coalesce("v", F.lit(0).cast("long")).alias("v")))
    cut = rows.groupBy(F.floor(F.col("k") / (size // parts)).alias("p")).agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("a"))
    cut = cut.select("p", F.transform("a", lambda x: x["v"]).alias("a"))
    return cut.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("p", "a"))), lambda x: x["a"])).alias("a"))


def bit_filter(hashes: DataFrame, column: str, bits: int) -> DataFrame:
    """One row with 2 ** ``bits`` bits (as longs): one set for the leading bits of each hash."""
    h = F.shiftrightunsigned(F.col(column), 64 - bits)
    words = hashes.select(F.shiftright(h, 6).alias("k"), F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int")).alias("b"))
    return dense(words.groupBy("k").agg(F.bit_or("b").alias("v")), 1 << (bits - 6))


def as_literal(one: DataFrame) -> Column:
    """The array of a ``dense`` row as a literal; for arrays of a few thousand numbers."""
    return F.split(F.lit(",".join(map(str, one.first()["a"]))), ",").cast("array<bigint>")


def in_filter(array: Column, h: Column, bits: int) -> Column:
    """True if the filter lets the hash through (always for a hash that went in)."""
    at = F.shiftrightunsigned(h, 64 - bits)
    return F.getbit(F.get(array, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1
