"""Statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratewise.operators import stats
from ratewise.plans.registry import query
from ratewise.sources.fixtures import Fixtures

TOP_N = 10
CATEGORY_K = 10


@query("category_top10", sql="""
SELECT category, mid, avg, rank FROM (
  SELECT c.category, i.mid, round(a.avg, 6) AS avg,
         row_number() OVER (PARTITION BY c.category ORDER BY round(a.avg, 6) DESC, i.mid) AS rank
  FROM items i JOIN (SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid) a ON a.mid = i.mid
  JOIN categories c ON contains(lower(i.genres), lower(c.category))) t
WHERE rank <= 10""")
def category_top10(fx: Fixtures):
    """Flagship: per-category top 10 items by average score."""
    return stats.category_top_k(fx.items(), stats.average_score(fx.item_ratings()), fx.categories(), CATEGORY_K)


@query("rate_more", sql="SELECT mid, count(*) AS count FROM ratings GROUP BY mid")
def rate_more(fx: Fixtures):
    """Rating count per item."""
    return stats.rate_more(fx.item_ratings())


@query("hot_by_month", sql="""
SELECT CAST(strftime(make_timestamp(ts * 1000000), '%Y%m') AS INT) AS yearmonth, mid, count(*) AS count
FROM ratings GROUP BY 1, 2""")
def hot_by_month(fx: Fixtures):
    """C1 + C2 + E2: rating count per (yyyyMM, item)."""
    return stats.rate_more_recently(fx.item_ratings())


@query("average_score", sql="SELECT mid, round(avg(score), 6) AS avg FROM ratings GROUP BY mid")
def average_score(fx: Fixtures):
    """Average score per item."""
    return stats.average_score(fx.item_ratings()).select("mid", F.round("avg", 6).alias("avg"))


@query("rating_histogram", sql="""
SELECT uid, CAST(floor(score / 0.5 + 0.5) AS INT) AS bucket, count(*) AS count FROM ratings GROUP BY 1, 2""")
def rating_histogram(fx: Fixtures):
    """C19 + E13: per-user histogram over 11 half-star buckets."""
    return stats.rating_histogram(fx.ratings())


@query("distinct_users_items", sql="""
SELECT DISTINCT 'uid' AS kind, uid AS id FROM ratings
UNION ALL SELECT DISTINCT 'mid' AS kind, mid AS id FROM ratings""")
def distinct_users_items(fx: Fixtures):
    """Distinct users and distinct items."""
    return stats.distinct_ids(fx.ratings())


@query("top_rate_more", sql=f"""
SELECT mid, count(*) AS count, CAST(0.0 AS DOUBLE) AS score FROM ratings GROUP BY mid
ORDER BY count DESC, mid LIMIT {TOP_N}""")
def top_rate_more(fx: Fixtures):
    """Top 10 items by rating count (report)."""
    return stats.top_rate_more(stats.rate_more(fx.item_ratings()), TOP_N)


@query("top_hot", sql=f"""
SELECT yearmonth, mid, count, CAST(0.0 AS DOUBLE) AS score FROM (
  SELECT CAST(strftime(make_timestamp(ts * 1000000), '%Y%m') AS INT) AS yearmonth, mid, count(*) AS count
  FROM ratings GROUP BY 1, 2) t
ORDER BY yearmonth DESC, count DESC, mid LIMIT {TOP_N}""")
def top_hot(fx: Fixtures):
    """Latest month first, top 10 by count (report)."""
    return stats.top_hot(stats.rate_more_recently(fx.item_ratings()), TOP_N)


@query("top_new", sql=f"""
SELECT mid, name, CAST(floor(epoch(issue)) AS BIGINT) AS issue_ts FROM items
ORDER BY issue DESC NULLS LAST, mid LIMIT {TOP_N}""")
def top_new(fx: Fixtures):
    """10 newest items by first shipment (report)."""
    return stats.top_new(fx.items(), TOP_N)


# The same statistics as SQL text over temp views (the Spark SQL path);
# The reference's date UDF is the built-in date_format, so the whole
# query stays in Catalyst and codegen.  View names are prefixed so they never
# shadow a caller's own views.
HOT_BY_MONTH_SQL = """
SELECT CAST(date_format(timestamp_seconds(ts), 'yyyyMM') AS INT) AS yearmonth, mid, count(*) AS count
FROM rw_ratings GROUP BY 1, 2"""


@query("hot_by_month_sql", sql="""
SELECT CAST(strftime(make_timestamp(ts * 1000000), '%Y%m') AS INT) AS yearmonth, mid, count(*) AS count
FROM ratings GROUP BY 1, 2""")
def hot_by_month_sql(fx: Fixtures):
    """I1 + I2 + E2: monthly popularity as a SQL string over a temp view."""
    fx.item_ratings().createOrReplaceTempView("rw_ratings")
    return fx.spark.sql(HOT_BY_MONTH_SQL)
