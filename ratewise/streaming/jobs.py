"""Structured Streaming jobs.

What a user's earlier ratings leave behind lies in Spark's state store, keyed by
user (``transformWithState``): a list of the newest ratings and a list of the rated
items.  A micro-batch reads and writes the state of its own users only; scoring is the
same set-based job as in batch, over the batch's events and what the state gives out.

Sources are file streams (the same DataFrame API as a message-queue source,
whose connector jar is not installed here).  A job lives in a folder that the
caller names: its ``checkpoint`` and its tables.  Starting a job again on the
same folder resumes after the last committed batch; sinks are idempotent per
batch id.  Every ``start_*`` hands the running ``StreamingQuery`` back.
``trigger(processingTime='2 seconds')`` is the batch interval of a service;
tests and the registered queries use ``availableNow``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ratewise.functions.columns import epoch_seconds, extract_after_prefix, parse_rating_message
from ratewise.operators import realtime as rt
from ratewise.session import list_subdirs, materialize, new_subdir, remove_folder
from ratewise.sources.fixtures import log_lines

BATCH_INTERVAL = "2 seconds"   # fixed value: the reference's batch interval

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_event_stream(spark: SparkSession, path_glob: str, max_files: int | None = None) -> DataFrame:
    """Raw events as a stream (schema pinned: streams never infer)."""
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path_glob)


def rating_events_of(events: DataFrame, n_items: int) -> DataFrame:
    """Row-wise derivation of rating events (same rule as the batch view)."""
    return events.select(
        "event_id", F.col("user_id").cast("int").alias("uid"),
        (F.col("event_id") % F.lit(n_items)).cast("int").alias("mid"),
        ((F.floor("value").cast("long") % 10 + 1) / F.lit(2.0)).alias("score"),
        epoch_seconds("ts").alias("ts"))


def log_lines_of(events: DataFrame, n_items: int) -> DataFrame:
    """Log lines as the web tier writes them (the batch view's rule), on a stream."""
    return log_lines(events, n_items)


def log_filter(lines: DataFrame) -> DataFrame:
    """H1 + C15: keep rating lines, forward the message text."""
    return lines.select("event_id", extract_after_prefix("line").alias("msg")).where(F.col("msg").isNotNull())


def _triggered(writer, now: bool):
    return writer.trigger(availableNow=True) if now else writer.trigger(processingTime=BATCH_INTERVAL)


def start_table(stream: DataFrame, base: str, trigger_now: bool = True) -> StreamingQuery:
    """Start a stateless/append stream into the parquet table ``base``/out
    (exactly-once file sink), resuming from ``base``/checkpoint."""
    w = (stream.writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/checkpoint").outputMode("append"))
    return _triggered(w, trigger_now).start()


def run_to_table(stream: DataFrame, spark: SparkSession, name: str, base: str | None = None) -> str:
    """Run a stream over what there is now; returns the table path."""
    base = base or new_subdir(spark, name)
    start_table(stream, base).awaitTermination()
    return f"{base}/out"


# ------------------------------------------------- C13: messages and rejects
def typed_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of rating messages: a message of which a field is missing or of
    another type is a reject, as it stands."""
    parsed = messages.select("event_id", "msg", parse_rating_message("msg").alias("r")).select("event_id", "msg", "r.*")
    whole = F.col("uid").isNotNull() & F.col("mid").isNotNull() & F.col("score").isNotNull() & F.col("ts").isNotNull()
    return parsed.where(whole).drop("msg"), parsed.where(~whole).select("event_id", "msg")


class MessageSplitter:
    """foreachBatch sink with two outputs: ``rows/batch=<id>`` and ``rejects/batch=<id>``."""

    def __init__(self, base: str):
        self.rows, self.rejects = f"{base}/rows", f"{base}/rejects"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows, rejects = typed_messages(materialize(batch))
        rows.write.mode("overwrite").parquet(f"{self.rows}/batch={batch_id}")
        rejects.write.mode("overwrite").parquet(f"{self.rejects}/batch={batch_id}")


def split_messages(lines: DataFrame, spark: SparkSession, base: str | None = None) -> MessageSplitter:
    """H1 + C13 over what there is now: rating lines to typed rows and rejects."""
    sink = MessageSplitter(base or new_subdir(spark, "messages"))
    start_batches(log_filter(lines), sink.rows.rsplit("/", 1)[0], sink).awaitTermination()
    return sink


# ---------------------------------------------------------------- H3 state
CONTEXT_SCHEMA = "kind string, event_id long, uid int, mid int, score double, ts long"
EVENT, TAIL, RATED = "event", "tail", "rated"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def user_ratings(cap: int, with_rated: bool) -> StatefulProcessor:
    """State of one user: the newest ``cap`` ratings (repeats kept) and, if
    ``with_rated``, the distinct rated items.

    For each micro-batch it gives out the batch's ratings (``event``), the newest ratings
    before it (``tail``) and the items rated before it (``rated``, other columns null).
    With many users the calls made for each are the time of a batch, not its rows: a step reads and
    writes each list once and gives out one frame.  A class of this function's own, it is sent to the
    processes that run it by value: Spark's driver-side worker doesn't see files added to the session."""
    kinds = {"tail": TAIL, "rated": RATED, "event": EVENT}
    names = ["event_id", "mid", "score", "ts"]

    def out(uid: int, tail: list[tuple], old: list[int], fresh: list[tuple]) -> pd.DataFrame:
        """All that a user's step gives out, as one frame: each frame is a batch of its own on the way back."""
        rows = tail + [(0, mid, None, 0) for mid in old] + fresh
        no_time = np.zeros(len(rows), bool)
        no_time[len(tail):len(tail) + len(old)] = True
        event_id, mid, score, ts = zip(*rows)

        def whole(values, kind: str, null) -> pd.arrays.IntegerArray:
            return pd.arrays.IntegerArray(np.array(values, kind), null)
        kind = [kinds["tail"]] * len(tail) + [kinds["rated"]] * len(old) + [kinds["event"]] * len(fresh)
        user = whole(np.full(len(rows), 0 if uid is None else uid), "int32", np.full(len(rows), uid is None))
        return pd.DataFrame({"kind": np.array(kind, object), "event_id": whole(event_id, "int64", no_time), "uid": user,
                             "mid": np.array(mid, "int32"), "score": np.array(score, "float64"), "ts": whole(ts, "int64", no_time)}, copy=False)

    class UserRatings(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.newest = handle.getListState("newest", "event_id long, mid int, score double, ts long")
            self.rated = handle.getListState("rated", "mid int")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            uid = key[0]
            before = newest = [tuple(r) for r in self.newest.get()]
            old = [r[0] for r in self.rated.get()] if with_rated else []
            known, added = set(old), set()
            for i, pdf in enumerate(rows):
                fresh = list(zip(*(pdf[c].tolist() for c in names)))
                yield out(uid, *((before, old) if i == 0 else ([], [])), fresh)
                newest = sorted(newest + fresh, key=lambda r: (r[3], r[0]), reverse=True)[:cap]
                added.update(r[1] for r in fresh)
            self.newest.put(newest)
            if with_rated and (added := added - known):
                self.rated.appendList([(m,) for m in sorted(added)])

        def close(self) -> None:
            pass

    return UserRatings()


def with_user_state(ratings: DataFrame, cap: int = rt.QUEUE_CAP, with_rated: bool = True) -> DataFrame:
    """The rating stream with, per micro-batch, what the state knows of the batch's users."""
    return ratings.groupBy("uid").transformWithStateInPandas(user_ratings(cap, with_rated), CONTEXT_SCHEMA, "append", "none")


@contextmanager
def _state_store(spark: SparkSession):
    """The state store that ``transformWithState`` needs, while a query starts (it keeps its settings)."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def start_batches(stream: DataFrame, base: str, sink: Callable[[DataFrame, int], None], trigger_now: bool = True) -> StreamingQuery:
    """Start ``sink`` on each micro-batch, resuming from ``base``/checkpoint."""
    with _state_store(stream.sparkSession):
        return _triggered(stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/checkpoint"), trigger_now).start()


def _parts(context: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(events, tail, rated) of a micro-batch, which is run once: its state isn't read again."""
    rows = materialize(context)
    cols = ["event_id", "uid", "mid", "score", "ts"]
    return (rows.where(F.col("kind") == EVENT).select(*cols), rows.where(F.col("kind") == TAIL).select(*cols),
            rows.where(F.col("kind") == RATED).select("uid", "mid"))


class RecentLists:
    """foreachBatch sink of H3: the newest k ratings at each event, as ``out/batch=<id>``.

    A repeated batch writes its own folder again."""

    def __init__(self, base: str, k: int = rt.RECENT_K):
        self.out, self.k = f"{base}/out", k

    def __call__(self, context: DataFrame, batch_id: int) -> None:
        events, tail, _ = _parts(context)
        lists = rt.recent_k(tail.unionByName(events), self.k).join(events.select("event_id"), "event_id", "left_semi")
        lists.write.mode("overwrite").parquet(f"{self.out}/batch={batch_id}")


def recent_k_job(ratings: DataFrame, spark: SparkSession, base: str | None = None, k: int = rt.RECENT_K, cap: int = rt.QUEUE_CAP) -> str:
    """H3 over what there is now: one bounded list per user in the state; within a
    micro-batch a user's events count in (ts, event_id) order.  Returns the table's path."""
    base = base or new_subdir(spark, "recent-k")
    start_batches(with_user_state(ratings, cap, with_rated=False), base, RecentLists(base, k)).awaitTermination()
    return f"{base}/out"


# ---------------------------------------------------------------- H6 / B5
class RecsUpserter:
    """foreachBatch sink of H6: scores the batch's events (H3-H5) and writes the lists of
    the batch's users (B5) to ``recs/batch=<id>``; a user whose latest event scores nothing
    gets a row without an item.

    A user's list is that of the highest batch that has the user, so a batch writes as many
    rows as it has users, and a repeated batch writes its own folder again.  Every ``merge_every``
    batches the folders are merged into the newest one."""

    def __init__(self, spark: SparkSession, sim: DataFrame, base: str, stored: DataFrame | None = None, merge_every: int = 64):
        self.spark, self.sim, self.stored, self.merge_every = spark, sim, stored, merge_every
        self.recs = f"{base.rstrip('/')}/recs"

    def __call__(self, context: DataFrame, batch_id: int) -> None:
        events, tail, rated = _parts(context)
        known = rated if self.stored is None else rated.unionByName(self.stored.select("uid", "mid"))
        lists = rt.latest_recommendations(events, self.sim, known, tail)
        fresh = events.select("uid").distinct().join(lists.select("uid", "mid", "score", "rank"), "uid", "left")
        fresh.write.mode("overwrite").parquet(f"{self.recs}/batch={batch_id}")
        if (batch_id + 1) % self.merge_every == 0:
            self.merge(batch_id)

    def merge(self, batch_id: int) -> None:
        """The lists of all batches in the folder of ``batch_id``; older folders go afterwards
        (until then their rows are only lower versions)."""
        now = materialize(newest_lists(self.spark, self.recs, with_empty=True))
        now.write.mode("overwrite").parquet(f"{self.recs}/batch={batch_id}")
        for name in list_subdirs(self.spark, self.recs):
            if name.startswith("batch=") and int(name.split("=")[1]) < batch_id:
                remove_folder(self.spark, f"{self.recs}/{name}")


def newest_lists(spark: SparkSession, recs: str, with_empty: bool = False) -> DataFrame:
    """(uid, mid, score, rank): the current list of each user."""
    rows = spark.read.parquet(recs)
    newest = rows.groupBy("uid").agg(F.max("batch").alias("batch"))
    rows = rows.join(newest, ["uid", "batch"], "left_semi").select("uid", "mid", "score", "rank")
    return rows if with_empty else rows.where(F.col("mid").isNotNull())


def start_recs(ratings: DataFrame, spark: SparkSession, sim: DataFrame, base: str, stored: DataFrame | None = None,
               trigger_now: bool = True) -> tuple[StreamingQuery, RecsUpserter]:
    """Start H6 over a rating stream in the folder ``base`` (resuming what is there)."""
    sink = RecsUpserter(spark, sim, base, stored)
    return start_batches(with_user_state(ratings), base, sink, trigger_now), sink


def stream_recs(ratings: DataFrame, spark: SparkSession, sim: DataFrame, base: str | None = None,
                stored: DataFrame | None = None) -> DataFrame:
    """Run H6 over what there is now; returns the current lists."""
    query, sink = start_recs(ratings, spark, sim, base or new_subdir(spark, "stream-recs"), stored)
    query.awaitTermination()
    return newest_lists(spark, sink.recs)
