"""Streaming queries.

Each query lets the events arrive in four steps, in order of event id, and
starts its job again on the same folder after each (``availableNow``): state,
history and lists cross micro-batches and restarts.  The sink table equals the
batch twin, which is why the batch twin's SQL is the oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ratewise.operators.serving import lists_for_keys
from ratewise.plans.realtime import CAND_SQL, RECENT_SQL, SCORED_SQL, SIM_VIEWS, shared_sim
from ratewise.plans.registry import ORACLE, query
from ratewise.session import new_subdir
from ratewise.sources.fixtures import Fixtures, with_broken_messages
from ratewise.streaming import jobs


STEPS = 4
LIST_N = 10


def _arriving(fx: Fixtures, name: str):
    """(job folder, events stream) after each step of the arrival."""
    base = new_subdir(fx.spark, name)
    ev = fx.spark.read.schema(jobs.EVENTS_SCHEMA).parquet(f"{fx.sf_dir.rstrip('/')}/events.parquet")
    cuts = [int(c) for c in ev.approxQuantile("event_id", [i / STEPS for i in range(1, STEPS)], 0.001)]
    bounds = [None, *cuts, None]
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = ev.where(F.lit(low is None) | (F.col("event_id") > F.lit(low))).where(F.lit(high is None) | (F.col("event_id") <= F.lit(high)))
        part.write.parquet(f"{base}/arrived/step{i}")
        yield base, jobs.read_event_stream(fx.spark, f"{base}/arrived/step*")


def _n_items(fx: Fixtures) -> int:
    # one number from the part table (the modulus of the item rule)
    return fx.table("part").count()


@query("stream_log_filter")
def stream_log_filter(fx: Fixtures):
    """A14 + H1 + C15: log-line stream -> rating messages (file sink)."""
    for base, ev in _arriving(fx, "log-filter"):
        out = jobs.run_to_table(jobs.log_filter(jobs.log_lines_of(ev, _n_items(fx))), fx.spark, "log-filter", base)
    return fx.spark.read.parquet(out).select("event_id", "msg")


@query("stream_recent_k")
def stream_recent_k(fx: Fixtures):
    """H3 as keyed state (transformWithState), a bounded list per user."""
    for base, ev in _arriving(fx, "recent-k"):
        out = jobs.recent_k_job(jobs.rating_events_of(ev, _n_items(fx)), fx.spark, base)
    return fx.spark.read.parquet(out).select("event_id", "pos", "rmid", "rscore")


@query("stream_recs_upsert", sql="""
SELECT e.uid, sc.mid, sc.score,
       row_number() OVER (PARTITION BY e.event_id ORDER BY sc.score_micro DESC, sc.mid) AS rank
FROM scored sc JOIN ev e ON e.event_id = sc.event_id
WHERE e.event_id IN (SELECT event_id FROM (
  SELECT event_id, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS rn FROM ev) t WHERE rn = 1)""",
       extra_views={**SIM_VIEWS, "rec": RECENT_SQL, "cand": CAND_SQL, "scored": SCORED_SQL})
def stream_recs_upsert(fx: Fixtures):
    """H6 + B5 + H2: rating stream -> per-batch scoring -> per-user list upsert."""
    sim, stored = shared_sim(fx), fx.shared("stored", lambda: fx.ratings().select("uid", "mid").distinct())
    for base, ev in _arriving(fx, "stream-recs"):
        lists = jobs.stream_recs(jobs.rating_events_of(ev, _n_items(fx)), fx.spark, sim, base, stored)
    return lists


MESSAGE_VIEWS = {"messages": r"""
SELECT event_id, m AS msg, TRY_CAST(split_part(m, '|', 1) AS INT) AS uid, TRY_CAST(split_part(m, '|', 2) AS INT) AS mid,
       TRY_CAST(split_part(m, '|', 3) AS DOUBLE) AS score, TRY_CAST(trim(split_part(m, '|', 4)) AS BIGINT) AS ts
FROM (SELECT event_id, trim(split_part(line, 'MOVIE_RATING_PREFIX:', 2)) AS m FROM broken_log
      WHERE contains(line, 'MOVIE_RATING_PREFIX:')) t WHERE m <> ''"""}
_WHOLE = "uid IS NOT NULL AND mid IS NOT NULL AND score IS NOT NULL AND ts IS NOT NULL"


def _split(fx: Fixtures) -> jobs.MessageSplitter:
    for base, ev in _arriving(fx, "messages"):
        sink = jobs.split_messages(with_broken_messages(jobs.log_lines_of(ev, _n_items(fx))), fx.spark, base)
    return sink


@query("stream_messages", sql=f"SELECT event_id, uid, mid, score, ts FROM messages WHERE {_WHOLE}", extra_views=MESSAGE_VIEWS)
def stream_messages(fx: Fixtures):
    """H1 + C13: log-line stream -> typed rating messages, the first output of its sink."""
    return fx.spark.read.parquet(_split(fx).rows).drop("batch")


@query("stream_message_rejects", sql=f"SELECT event_id, msg FROM messages WHERE NOT ({_WHOLE})", extra_views=MESSAGE_VIEWS)
def stream_message_rejects(fx: Fixtures):
    """The malformed messages of the same stream, the second output of its sink."""
    return fx.spark.read.parquet(_split(fx).rejects).drop("batch")


@query("stream_list_by_user", sql=f"""
SELECT e.uid, sc.mid, sc.score, row_number() OVER (PARTITION BY e.uid ORDER BY sc.score DESC, sc.mid) AS rank
FROM scored sc JOIN ev e ON e.event_id = sc.event_id JOIN users u ON u.uid = e.uid AND u.pref_genre = 'LARGE'
WHERE e.event_id IN (SELECT event_id FROM (
  SELECT event_id, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS rn FROM ev) t WHERE rn = 1)
QUALIFY rank <= {LIST_N}""", extra_views={**SIM_VIEWS, "rec": RECENT_SQL, "cand": CAND_SQL, "scored": SCORED_SQL})
def stream_list_by_user(fx: Fixtures):
    """The first ten of the stored real-time list of each requested user (those who prefer large items)."""
    keys = fx.users().where(F.col("pref_genre") == "LARGE").select("uid")
    return lists_for_keys(keys, stream_recs_upsert(fx).drop("rank"), "uid", LIST_N).select("uid", "mid", "score", "rank")


# the stream twins of batch queries share their oracle
ORACLE["stream_log_filter"] = ORACLE["log_filter_batch"]
ORACLE["stream_recent_k"] = ORACLE["recent_k_ratings"]
