"""Ranking operators: grouped top-k, global sequence numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.session import materialize

_LOW_BITS = (1 << 33) - 1


#: Rows of one task where whole texts are taken apart.
TEXTS_A_TASK = 2048


def spread(df: DataFrame, key: str, rows: int = TEXTS_A_TASK) -> DataFrame:
    """``df`` exchanged by ``key`` into as many partitions as its number of rows asks for (at least the
    session's), so that what one task holds doesn't grow with the input."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-df.count() // rows)), key)


def global_row_number(df: DataFrame, order: list[Column], name: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """Row number over a *total* order without a single-partition window.

    ``row_number() OVER (ORDER BY ...)`` moves every row into one task.
    Instead: range-partition on the order (an explicit partition count, so
    AQE keeps the partition layout stable), sort inside partitions, and tag
    each row with ``monotonically_increasing_id`` = (partition << 33) +
    position.  Per-partition sizes form a table with one row per partition
    (a proven size bound), whose running sum gives each partition's offset.
    ``order`` must break all ties, otherwise numbering is arbitrary.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *order)
                .sortWithinPartitions(*order)
                .withColumn("_mid", F.monotonically_increasing_id())
                .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
                .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))))
    sizes = tagged.groupBy("_pid").agg((F.max("_pos") + 1).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, F.col("_off") + F.col("_pos") + 1)
                  .drop("_mid", "_pid", "_pos", "_off"))


def place_in_group(df: DataFrame, key: str, order: list, name: str = "place") -> DataFrame:
    """The place of each row within its key from 0, without a window over the key: a
    distributed row number less the key's first one.  ``order`` must break all ties but
    those of equal rows."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    numbered = materialize(global_row_number(df, [F.col(key).asc(), *order], "_n"))
    first = numbered.groupBy(key).agg(F.min("_n").alias("_first"))
    return numbered.join(first, key).withColumn(name, F.col("_n") - F.col("_first")).drop("_n", "_first")


def ordered_chunks(df: DataFrame, key: str, order: list, value: Column, chunk: int = 4096) -> DataFrame:
    """(key, chunk, values): each key's values in order, in arrays of at most ``chunk``, so no task
    gathers the rows of one key."""
    placed = place_in_group(df, key, order)
    pair = F.struct("place", value.alias("value"))
    return (placed.groupBy(key, F.floor(F.col("place") / chunk).alias("chunk"))
                  .agg(F.transform(F.array_sort(F.collect_list(pair)), lambda x: x["value"]).alias("values")))


def ordered_join(df: DataFrame, key: str, order: list, column: str, sep: str, chunk: int = 4096) -> DataFrame:
    """(key, joined): each key's values as one string, joined chunk by chunk."""
    parts = ordered_chunks(df, key, order, F.col(column), chunk).select(key, "chunk", F.array_join("values", sep).alias("text"))
    whole = F.transform(F.array_sort(F.collect_list(F.struct("chunk", "text"))), lambda x: x["text"])
    return parts.groupBy(key).agg(F.array_join(whole, sep).alias("joined"))


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """Grouped top-k: ``row_number() <= k``.  Catalyst plans this with
    ``WindowGroupLimit`` before the shuffle, so each map task ships at most
    k rows per key and a hot key never lands whole in one task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def global_top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Global top-k: ``orderBy().limit()`` -> ``TakeOrderedAndProject``
    (each task keeps k rows; the driver merges only k per task)."""
    return df.orderBy(*order).limit(k)
