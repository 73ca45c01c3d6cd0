"""DuckDB text of the fixture views, for the oracle SQL.

``with_views(sql)`` prefixes a query with the CTEs it references (and
their dependencies), so every oracle string runs on the bare driver tables.
"""

from __future__ import annotations

import re

EPOCH = "CAST(floor(epoch({x})) AS BIGINT)"
TOKENS = r"list_filter(regexp_extract_all(lower(trim({x})), '[\p{{L}}\p{{N}}]+'), lambda t: length(t) > 1)"


def epoch(x: str) -> str:
    return EPOCH.format(x=x)


def toks(x: str) -> str:
    return TOKENS.format(x=x)


VIEWS: dict[str, str] = {
    "items": """
SELECT CAST(p_partkey AS INT) AS mid, p_name AS name, concat_ws(' ', p_name, p_brand, p_type) AS descri,
       s.issue, CAST(p_size AS INT) AS timelong,
       concat_ws('|', p_type, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)) AS genres
FROM part LEFT JOIN (SELECT l_partkey, min(l_shipdate) AS issue FROM lineitem GROUP BY l_partkey) s
  ON s.l_partkey = p_partkey""",
    "ratings": f"""
SELECT CAST(o_custkey AS INT) AS uid, CAST(l_partkey AS INT) AS mid, l_quantity / CAST(10.0 AS DOUBLE) AS score,
       {epoch('l_shipdate')} AS ts, l_orderkey, l_linenumber
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "rating_events": f"""
SELECT event_id, CAST(user_id AS INT) AS uid, CAST(event_id % (SELECT count(*) FROM part) AS INT) AS mid,
       (CAST(floor(value) AS BIGINT) % 10 + 1) / CAST(2.0 AS DOUBLE) AS score, {epoch('ts')} AS ts
FROM events""",
    "rating_log": """
SELECT event_id, CASE WHEN event_type = 'error' THEN concat('INFO page hit ', CAST(event_id AS VARCHAR))
       ELSE concat('INFO ', 'MOVIE_RATING_PREFIX:', CAST(uid AS VARCHAR), '|', CAST(mid AS VARCHAR), '|',
                   CAST(CAST(score AS DECIMAL(3,1)) AS VARCHAR), '|', CAST(r.ts AS VARCHAR), ' ') END AS line
FROM rating_events r JOIN events USING (event_id)""",
    "item_tags": f"""
SELECT CAST(user_id AS INT) AS uid, CAST(event_id % (SELECT count(*) FROM part) AS INT) AS mid,
       event_type AS tag, {epoch('ts')} AS ts
FROM events""",
    "comments": """
SELECT CAST(conv_id AS INT) AS uid, CAST((conv_id * 7 + turn) % (SELECT count(*) FROM part) AS INT) AS mid,
       text AS content
FROM conversations""",
    "docs": "SELECT CAST(doc_id AS INT) AS mid, source AS name, text AS descri FROM documents",
    "users": """
SELECT CAST(c_custkey AS INT) AS uid, c_name AS username,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'STANDARD' WHEN 'FURNITURE' THEN 'LARGE' WHEN 'HOUSEHOLD' THEN 'SMALL'
                         WHEN 'MACHINERY' THEN 'ECONOMY' ELSE 'PROMO' END AS pref_genre
FROM customer""",
    "categories": """
SELECT * FROM (VALUES ('Economy'),('Promo'),('Large'),('Medium'),('Standard'),('Small'),('Ring'),('Rod'),
               ('Bolt'),('Blue')) AS t(category)""",
    "word_freq": f"""
SELECT w AS word, row_number() OVER (ORDER BY df DESC, w) - 1 AS rk
FROM (SELECT w, count(DISTINCT k) AS df
      FROM (SELECT concat('c', CAST(uid AS VARCHAR), '-', CAST(mid AS VARCHAR)) AS k, unnest({toks('content')}) AS w
            FROM comments
            UNION ALL
            SELECT concat('d', CAST(mid AS VARCHAR)) AS k, unnest({toks('descri')}) AS w FROM docs) x
      GROUP BY w) y""",
    "stop_words": "SELECT word FROM word_freq WHERE rk < 20",
    "word_vectors": "SELECT word, embedding AS vec FROM word_freq JOIN embeddings ON vec_id = rk",
    # what the text files hold (our own derivations, same rule in Spark)
    "broken_log": r"""
SELECT event_id, CASE WHEN event_id % 9 = 0 THEN regexp_replace(line, '\|[^|]*\|[^|]*$', '')
                      WHEN event_id % 13 = 0 THEN replace(line, '|', '|x') ELSE line END AS line
FROM rating_log""",
    "comment_lines": r"""
SELECT concat_ws(',', concat('"', CAST(uid AS VARCHAR), '-', CAST(mid AS VARCHAR), '"'),
                 concat('"', regexp_replace(content, '[\r\n]+', ' ', 'g'), '"'),
                 '""', '""', concat('"', CAST(mid AS VARCHAR), '"'), '""', '""', '""',
                 concat('"', CAST(uid AS VARCHAR), '"'),
                 concat('"', CASE WHEN (uid + mid) % 6 = 0 THEN '' ELSE CAST((uid + mid) % 5 + 1 AS VARCHAR) END, '"'),
                 '""', '""', '""', CASE WHEN uid % 5 = 0 THEN '"",""' ELSE '""' END) AS line
FROM comments""",
}

# dependency order (a view only references views listed before it)
ORDER = ["items", "ratings", "rating_events", "rating_log", "broken_log", "item_tags", "comments", "comment_lines", "docs", "users",
         "categories", "word_freq", "stop_words", "word_vectors"]


def _refs(sql: str) -> set[str]:
    return {v for v in VIEWS if re.search(rf"\b{v}\b", sql)}


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the fixture CTEs (plus ``extra`` CTEs, given in
    order) that it uses, directly or through other views."""
    extra = extra or {}
    needed: set[str] = set()
    todo = _refs(sql) | set().union(*[_refs(v) for v in extra.values()]) if extra else _refs(sql)
    while todo:
        v = todo.pop()
        if v not in needed:
            needed.add(v)
            todo |= _refs(VIEWS[v]) - needed
    ctes = [f"{v} AS ({VIEWS[v].strip()})" for v in ORDER if v in needed]
    ctes += [f"{k} AS ({s.strip()})" for k, s in extra.items()]
    if not ctes:
        return sql.strip()
    return "WITH " + ",\n".join(ctes) + "\n" + sql.strip()
