"""Item statistics: popularity, monthly popularity, averages, per-category
top-k, per-user score histograms, top-n reports (E1-E4, E7, E13-E16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.functions.columns import contains_ci, half_star_bucket, year_month
from ratewise.operators.ranking import global_top_k, top_k_per_group

SCORE_DIGITS = 6


def rate_more(ratings: DataFrame) -> DataFrame:
    """Rating count per item.  Partial (map-side) count, so a hot item
    costs one row per map task in the shuffle."""
    return ratings.groupBy("mid").agg(F.count(F.lit(1)).alias("count"))


def rate_more_recently(ratings: DataFrame) -> DataFrame:
    """C1 + E2: count per (yyyyMM, item)."""
    return (ratings.select("mid", year_month("ts").alias("yearmonth"))
            .groupBy("yearmonth", "mid").agg(F.count(F.lit(1)).alias("count")))


def average_score(ratings: DataFrame) -> DataFrame:
    """Average score per item."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def item_stats(ratings: DataFrame) -> DataFrame:
    """E1 + E3 from one aggregation (one shuffle instead of two)."""
    return ratings.groupBy("mid").agg(F.count(F.lit(1)).alias("count"), F.avg("score").alias("avg"))


def category_top_k(items: DataFrame, averages: DataFrame, categories: DataFrame, k: int = 10) -> DataFrame:
    """D2 + D3 + E4: top-k items per category by average score.

    The category list is a fixed, small parameter table (its size is the
    number of category names, not data), so it is broadcast and the theta
    join ``contains(lower(genres), lower(category))`` runs as a broadcast
    nested-loop join next to the item scan.  Ties: rounded avg desc, mid.
    ``row_number <= k`` plans as WindowGroupLimit, so each task ships at
    most k rows per category before the shuffle."""
    scored = items.select("mid", "genres").join(averages.select("mid", "avg"), "mid")
    hits = scored.join(F.broadcast(categories), contains_ci("genres", "category"))
    hits = hits.withColumn("avg", F.round("avg", SCORE_DIGITS))
    top = top_k_per_group(hits, ["category"], [F.col("avg").desc(), F.col("mid").asc()], k)
    return top.select("category", "mid", "avg", F.col("rank").cast("long").alias("rank"))


def rating_histogram(ratings: DataFrame) -> DataFrame:
    """C19 + E13: per-user histogram over 11 half-star buckets (Q4)."""
    return (ratings.select("uid", half_star_bucket("score").alias("bucket"))
            .groupBy("uid", "bucket").agg(F.count(F.lit(1)).alias("count")))


def distinct_ids(ratings: DataFrame) -> DataFrame:
    """Distinct users and distinct items, as (kind, id)."""
    users = ratings.select(F.lit("uid").alias("kind"), F.col("uid").alias("id")).distinct()
    items = ratings.select(F.lit("mid").alias("kind"), F.col("mid").alias("id")).distinct()
    return users.unionByName(items)


def top_rate_more(counts: DataFrame, n: int) -> DataFrame:
    """Global top-n items by count (a top-n report)."""
    top = global_top_k(counts, [F.col("count").desc(), F.col("mid").asc()], n)
    return top.select("mid", "count", F.lit(0.0).alias("score"))


def top_hot(monthly: DataFrame, n: int) -> DataFrame:
    """Latest month first, then count desc (Q3: sorted on yearmonth)."""
    top = global_top_k(monthly, [F.col("yearmonth").desc(), F.col("count").desc(), F.col("mid").asc()], n)
    return top.select("yearmonth", "mid", "count", F.lit(0.0).alias("score"))


def top_new(items: DataFrame, n: int) -> DataFrame:
    """Newest n items by issue date."""
    top = global_top_k(items, [F.col("issue").desc_nulls_last(), F.col("mid").asc()], n)
    return top.select("mid", "name", F.unix_timestamp("issue").alias("issue_ts"))
