"""Serving queries: stored lists, hydration, cold start (C17, C18, D11,
D12, G1, G2, G7, G8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratewise.operators import serving
from ratewise.operators.realtime import latest_recommendations
from ratewise.operators.stats import average_score, category_top_k
from ratewise.plans.content import ITEM_TFIDF_VIEWS
from ratewise.plans.realtime import CAND_SQL, RECENT_SQL, SCORED_SQL, SIM_VIEWS, shared_sim
from ratewise.plans.registry import query
from ratewise.sources.fixtures import Fixtures

LIST_N = 10
CATEGORY_K = 10

TOPN_SQL = f"""
SELECT k.mid, s.other, s.cos AS score,
       row_number() OVER (PARTITION BY k.mid ORDER BY s.cos DESC, s.other) AS rank
FROM (SELECT DISTINCT mid FROM rating_events) k JOIN sim s ON s.mid = k.mid
QUALIFY rank <= {LIST_N}"""


# the averages that stand in for a missing score are those of the newest 30 days of ratings, so items without one occur
RECENT_DAYS = 30
RECENT_AVG_SQL = f"""
SELECT mid, round(avg(score), 6) AS avg FROM ratings WHERE ts > (SELECT max(ts) FROM ratings) - {RECENT_DAYS * 86400} GROUP BY mid"""


def recent_averages(fx: Fixtures):
    r = fx.item_ratings()
    newest = r.select(F.max("ts")).scalar()
    return average_score(r.where(F.col("ts") > newest - F.lit(RECENT_DAYS * 86400))).select("mid", F.round("avg", 6).alias("avg"))


def item_lists(fx: Fixtures):
    """The stored similar-item list of every item some user rated,
    read from the per-vector ranked lists (first n entries per key)."""
    from ratewise.operators.realtime import top_lists
    top = top_lists(shared_sim(fx), fx.rating_events().select("mid"), LIST_N)
    return top.select(F.col("key").alias("mid"), F.col("mid").alias("other"), "score", "rank")


@query("topn_from_lists", sql=TOPN_SQL, extra_views=SIM_VIEWS)
def topn_from_lists(fx: Fixtures):
    """G1 + G2: top-10 of each requested item's stored similarity list."""
    return item_lists(fx)


@query("hydrate_recs", sql=f"""
SELECT t.mid AS key, t.rank, t.other AS mid, i.name, coalesce(a.avg, 0.0) AS avg
FROM ({TOPN_SQL}) t JOIN items i ON i.mid = t.other
LEFT JOIN (SELECT mid, round(avg(score), 6) AS avg FROM ratings GROUP BY mid) a ON a.mid = t.other""",
       extra_views=SIM_VIEWS)
def hydrate_recs(fx: Fixtures):
    """D11 + C17 + C18: list entries -> item rows with average score
    (0.0 without ratings); rank kept."""
    lists = item_lists(fx).select(F.col("mid").alias("key"), "rank", F.col("other").alias("mid"))
    avgs = average_score(fx.item_ratings()).select("mid", F.round("avg", 6).alias("avg"))
    out = serving.hydrate(lists, fx.items().select("mid", "name"), avgs)
    return out.select("key", "rank", "mid", "name", "avg")


@query("user_rated_items", sql=f"""
SELECT r.uid, r.mid, i.name, coalesce(r.score, a.avg, 0.0) AS score FROM (
  SELECT uid, mid, score FROM (
    SELECT e.uid, e.mid, CASE WHEN v.event_type = 'error' THEN NULL ELSE e.score END AS score,
           row_number() OVER (PARTITION BY e.uid, e.mid ORDER BY e.ts DESC, e.event_id DESC) AS rn
    FROM rating_events e JOIN events v USING (event_id)) t WHERE rn = 1) r
JOIN items i ON i.mid = r.mid
LEFT JOIN ({RECENT_AVG_SQL}) a ON a.mid = r.mid""")
def user_rated_items(fx: Fixtures):
    """D12 + C18: items each user rated, with that user's latest score; without one (the event is
    an error) the item's recent average, else 0.0."""
    score = F.when(F.col("event_type") != "error", F.col("score"))
    ev = fx.rating_events_with("event_type").select("uid", "mid", "ts", "event_id", score.alias("score"))
    mine = ev.groupBy("uid", "mid").agg(F.max_by("score", F.struct("ts", "event_id")).alias("score"))
    out = serving.user_rated_items(mine, fx.items().select("mid", "name"), recent_averages(fx))
    return out.select("uid", "mid", "name", "score")


@query("coldstart_fallback", sql=f"""
SELECT u.uid, l.mid, l.score, l.rank, 'list' AS source
FROM users u JOIN (
  SELECT e.uid, sc.mid, sc.score,
         row_number() OVER (PARTITION BY e.uid ORDER BY sc.score_micro DESC, sc.mid) AS rank
  FROM scored sc JOIN ev e ON e.event_id = sc.event_id
  WHERE e.event_id IN (SELECT event_id FROM (
      SELECT event_id, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS rn FROM ev) t
    WHERE rn = 1)) l ON l.uid = u.uid
WHERE l.rank <= {LIST_N}
UNION ALL
SELECT u.uid, c.mid, c.avg AS score, c.rank, 'category' AS source
FROM users u JOIN cat_top c ON upper(c.category) = upper(split_part(u.pref_genre, ' ', 1))
WHERE c.rank <= {LIST_N} AND u.uid NOT IN (
  SELECT e.uid FROM scored sc JOIN ev e ON e.event_id = sc.event_id
  WHERE e.event_id IN (SELECT event_id FROM (
      SELECT event_id, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS rn FROM ev) t
    WHERE rn = 1))""", extra_views={**SIM_VIEWS, "rec": RECENT_SQL, "cand": CAND_SQL, "scored": SCORED_SQL,
                                      "cat_top": f"""
SELECT category, mid, avg, rank FROM (
  SELECT c.category, i.mid, round(a.avg, 6) AS avg,
         row_number() OVER (PARTITION BY c.category ORDER BY round(a.avg, 6) DESC, i.mid) AS rank
  FROM items i JOIN (SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid) a ON a.mid = i.mid
  JOIN categories c ON contains(lower(i.genres), lower(c.category))) t
WHERE rank <= {CATEGORY_K}"""})
def coldstart_fallback(fx: Fixtures):
    """G7 + G8: users keep their real-time list (latest event); users
    without one get the top list of their preferred category."""
    ev = fx.shared("events", fx.rating_events)
    latest = latest_recommendations(ev, shared_sim(fx), fx.ratings()).select("uid", "mid", "score")
    users = fx.users().select("uid", F.array("pref_genre").alias("prefs"))
    users = users.select("uid", serving.preferred_category(F.col("prefs"), F.col("uid")).alias("pref"))
    top = category_top_k(fx.items(), average_score(fx.item_ratings()), fx.categories(), CATEGORY_K)
    return serving.cold_start(users, latest, top, LIST_N)
