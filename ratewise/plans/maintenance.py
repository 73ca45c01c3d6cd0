"""Table-maintenance and lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratewise.operators import maintain
from ratewise.operators.serving import item_tag_index
from ratewise.plans.registry import query
from ratewise.sources.fixtures import Fixtures

LATEST_EVENT_SQL = """
SELECT uid, mid, score AS new_score, first_ts FROM (
  SELECT uid, mid, score, min(ts) OVER (PARTITION BY uid, mid) AS first_ts,
         row_number() OVER (PARTITION BY uid, mid ORDER BY ts DESC, event_id DESC) AS rn
  FROM rating_events) t WHERE rn = 1"""


@query("ratings_upsert", sql="""
SELECT r.uid, r.mid, coalesce(l.new_score, r.score) AS score, coalesce(r.ts, l.first_ts) AS ts
FROM ratings r LEFT JOIN latest l ON r.uid = l.uid AND r.mid = l.mid
UNION ALL
SELECT l.uid, l.mid, l.new_score AS score, l.first_ts AS ts FROM latest l
WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.uid = l.uid AND r.mid = l.mid)""",
       extra_views={"latest": LATEST_EVENT_SQL})
def ratings_upsert(fx: Fixtures):
    """Apply the rating events as writes to the rating table."""
    return maintain.upsert_scores(fx.ratings().select("uid", "mid", "score", "ts"), fx.rating_events())


@query("ratings_delete", sql="""
SELECT r.uid, r.mid, r.score, r.ts, r.l_orderkey, r.l_linenumber FROM ratings r
WHERE NOT EXISTS (SELECT 1 FROM rating_events e WHERE e.score <= 1.0 AND e.uid = r.uid AND e.mid = r.mid)""")
def ratings_delete(fx: Fixtures):
    """Delete every rating whose (uid, mid) was withdrawn (score <= 1)."""
    dels = fx.rating_events().where(F.col("score") <= 1.0)
    return maintain.delete_keys(fx.ratings(), dels, ["uid", "mid"])


@query("items_with_tags", sql="""
SELECT i.mid, i.name, t.tags FROM items i LEFT JOIN (
  SELECT mid, array_to_string(list_sort(list_distinct(list(tag))), '|') AS tags FROM item_tags GROUP BY mid) t
ON t.mid = i.mid""")
def items_with_tags(fx: Fixtures):
    """D1 + E5: items left-joined with their distinct tag set."""
    return item_tag_index(fx.items().select("mid", "name"), fx.item_tags())


@query("tags_append", sql="""
SELECT i.mid, CASE WHEN n.new IS NULL THEN t.tags WHEN t.tags IS NULL THEN n.new
                   ELSE concat(t.tags, '|', n.new) END AS tags
FROM items i
LEFT JOIN (SELECT mid, array_to_string(list_sort(list_distinct(list(tag))), '|') AS tags
           FROM item_tags WHERE tag <> 'purchase' GROUP BY mid) t ON t.mid = i.mid
LEFT JOIN (SELECT mid, string_agg(tag, '|' ORDER BY ts, tag) AS new
           FROM item_tags WHERE tag = 'purchase' GROUP BY mid) n ON n.mid = i.mid""")
def tags_append(fx: Fixtures):
    """Purchase tags appended to an index built from the other tags."""
    tags = fx.item_tags()
    index = item_tag_index(fx.items().select("mid"), tags.where(F.col("tag") != "purchase"))
    return maintain.append_tags(index, tags.where(F.col("tag") == "purchase"))


@query("user_prefs_update", sql="""
SELECT u.uid, CASE WHEN p.new_prefs IS NULL THEN u.pref_genre
                   ELSE concat(u.pref_genre, '|', replace(p.new_prefs, ',', '|')) END AS prefs,
       p.new_prefs IS NULL AS first
FROM users u LEFT JOIN (
  SELECT e.uid, replace(i.genres, '|', ',') AS new_prefs FROM (
    SELECT uid, mid, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS rn
    FROM rating_events) e JOIN items i ON i.mid = e.mid WHERE e.rn = 1) p ON p.uid = u.uid""")
def user_prefs_update(fx: Fixtures):
    """Each active user adds the categories of the item rated last."""
    users = fx.users().select("uid", F.array("pref_genre").alias("prefs"), F.lit(True).alias("first"))
    last = (fx.rating_events().groupBy("uid")
            .agg(F.max_by("mid", F.struct("ts", "event_id")).alias("mid")))
    upd = last.join(fx.items().select("mid", "genres"), "mid").select(
        "uid", F.translate("genres", "|", ",").alias("new_prefs"))
    out = maintain.update_preferences(users, upd)
    return out.select("uid", F.array_join("prefs", "|").alias("prefs"), "first")


@query("lookup_item_tags", sql="""
SELECT e.event_id, t.uid, t.mid, t.tag, t.ts FROM rating_events e
JOIN item_tags t ON t.uid = e.uid AND t.mid = e.mid""")
def lookup_item_tags(fx: Fixtures):
    """G9 + C16: a user's tags of an item, for the (user, item) key of every
    rating event at once (a key-table join, not point reads)."""
    keys = fx.rating_events().select("event_id", "uid", "mid")
    return keys.join(fx.item_tags(), ["uid", "mid"]).select("event_id", "uid", "mid", "tag", "ts")


@query("lookup_tags_by_item", sql="""
SELECT t.mid, t.uid, t.tag, t.ts FROM item_tags t
WHERE t.mid IN (SELECT mid FROM items WHERE contains(lower(genres), 'promo'))""")
def lookup_tags_by_item(fx: Fixtures):
    """All tags of each requested item (the promo items), whoever set them."""
    keys = fx.items().where(F.contains(F.lower("genres"), F.lit("promo"))).select("mid")
    return maintain.lookup(fx.item_tags(), keys, ["mid"]).select("mid", "uid", "tag", "ts")


@query("items_delete", sql="""
SELECT i.mid, i.name FROM items i WHERE i.mid NOT IN (SELECT mid FROM rating_events WHERE score <= 0.5)""")
def items_delete(fx: Fixtures):
    """The item table without the withdrawn items (rated half a star by anyone)."""
    gone = fx.rating_events().where(F.col("score") <= 0.5).select("mid")
    return maintain.delete_keys(fx.items().select("mid", "name"), gone, ["mid"])


@query("tags_delete", sql="""
SELECT t.uid, t.mid, t.tag, t.ts FROM item_tags t WHERE NOT EXISTS (
  SELECT 1 FROM item_tags d WHERE d.tag = 'error' AND d.uid = t.uid AND d.mid = t.mid AND d.tag = t.tag)""")
def tags_delete(fx: Fixtures):
    """Tags withdrawn by (user, item, tag); all matches go (Q22)."""
    tags = fx.item_tags()
    return maintain.delete_keys(tags, tags.where(F.col("tag") == "error"), ["uid", "mid", "tag"])
