"""Stream-equals-batch: the events are split into several files and read
one file per micro-batch, so state and history cross batch boundaries."""

import tempfile
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratewise.operators import realtime as rt
from ratewise.plans.realtime import shared_sim
from ratewise.sources.fixtures import Fixtures
from ratewise.session import has_file, list_subdirs, new_subdir
from ratewise.streaming import jobs

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def split_events(spark):
    # four files in time order, written one after another: the file source
    # takes them oldest first, one per micro-batch
    d = tempfile.mkdtemp(prefix="ratewise-ev-")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    cuts = ev.approxQuantile("event_id", [0.25, 0.5, 0.75], 0.0)
    bounds = [-1] + [int(c) for c in cuts] + [1 << 62]
    for i in range(4):
        part = ev.where((F.col("event_id") > bounds[i]) & (F.col("event_id") <= bounds[i + 1]))
        part.coalesce(1).write.mode("append").parquet(d)
        time.sleep(1.1)
    return d


def test_log_filter_stream_equals_batch(spark, split_events):
    n = spark.read.parquet(f"{SF_SMALL}/part.parquet").count()
    stream = jobs.read_event_stream(spark, split_events, max_files=1)
    out = jobs.run_to_table(jobs.log_filter(jobs.log_lines_of(stream, n)), spark, "t-log")
    got = {tuple(r) for r in spark.read.parquet(out).select("event_id", "msg").collect()}
    batch = jobs.log_filter(jobs.log_lines_of(spark.read.parquet(split_events), n))
    assert got == {tuple(r) for r in batch.collect()}


def _rows(df, *cols):
    return {tuple(r) for r in (df.select(*cols) if cols else df).collect()}


def test_recent_state_equals_batch_window(spark, split_events):
    fx = Fixtures(spark, SF_SMALL)
    n = fx.table("part").count()
    stream = jobs.rating_events_of(jobs.read_event_stream(spark, split_events, max_files=1), n)
    out = jobs.recent_k_job(stream, spark)
    cols = ["event_id", "pos", "rmid", "rscore"]
    assert _rows(spark.read.parquet(out), *cols) == _rows(rt.recent_k(fx.rating_events()), *cols)


def _events_of(spark, rows):
    return spark.createDataFrame(rows, "event_id long, uid int, mid int, score double, ts long")


class _Arrivals:
    """A rating stream whose files the test writes one by one."""

    def __init__(self, spark, name):
        self.spark, self.base = spark, new_subdir(spark, name)

    def add(self, rows):
        _events_of(self.spark, rows).coalesce(1).write.mode("append").parquet(f"{self.base}/in")

    def stream(self):
        schema = "event_id long, uid int, mid int, score double, ts long"
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{self.base}/in")


def _state(spark, base, name):
    rows = spark.read.format("statestore").option("path", f"{base}/checkpoint").option("stateVarName", name).load()
    return rows.select("key.uid", "list_element.*")


def test_state_keeps_the_newest_and_touches_only_the_batchs_users(spark):
    arrivals = _Arrivals(spark, "t-state")
    seen = []

    def sink(context, batch_id):
        seen.append(sorted((r.kind, r.uid, r.mid) for r in context.collect()))
    first = [(i, 5, 7 if i % 2 else 8, 4.0, 100 + i) for i in range(41)] + [(100, 6, 1, 3.0, 100)]
    for rows in (first, [(200, 5, 9, 2.0, 300)], [(201, 5, 9, 2.0, 301)]):
        arrivals.add(rows)
        jobs.start_batches(jobs.with_user_state(arrivals.stream(), cap=40), arrivals.base, sink).awaitTermination()
        if len(seen) == 1:
            quiet = _rows(_state(spark, arrivals.base, "newest").where("uid = 6"))
    newest = _state(spark, arrivals.base, "newest")
    assert newest.where("uid = 5").count() == 40                                   # capped, repeats kept
    assert _rows(newest.where("uid = 6")) == quiet                                 # as the first batch left it
    assert {u for _, u, _ in seen[1]} == {u for _, u, _ in seen[2]} == {5}         # nothing of user 6 is read
    assert [x for x in seen[1] if x[0] == "rated"] == [("rated", 5, 7), ("rated", 5, 8)]
    assert [x for x in seen[2] if x[0] == "rated"] == [("rated", 5, 7), ("rated", 5, 8), ("rated", 5, 9)]
    assert sum(k == "tail" for k, _, _ in seen[1]) == 40 and sum(k == "event" for k, _, _ in seen[1]) == 1
    assert _rows(_state(spark, arrivals.base, "rated")) == {(5, 7), (5, 8), (5, 9), (6, 1)}


class _List:
    def __init__(self, rows):
        self.rows, self.calls = rows, 0

    def get(self):
        self.calls += 1
        return iter(self.rows)

    def put(self, rows):
        self.calls, self.rows = self.calls + 1, rows

    def appendList(self, rows):
        self.calls, self.rows = self.calls + 1, self.rows + rows


def test_a_users_step_is_one_frame_and_four_state_calls():
    processor = jobs.user_ratings(3, True)
    processor.newest, processor.rated = _List([(1, 7, 2.0, 10), (2, 8, float("nan"), 11)]), _List([(7,), (8,)])
    rows = pd.DataFrame({"event_id": [4, 3], "uid": [5, 5], "mid": [9, 7], "score": [1.0, 4.5], "ts": [12, 12]})
    frames = list(processor.handleInputRows((5,), iter([rows]), None))
    assert len(frames) == 1 and processor.newest.calls == processor.rated.calls == 2
    got = [tuple(None if pd.isna(x) else x for x in r) for r in frames[0].itertuples(index=False)]
    assert got == [("tail", 1, 5, 7, 2.0, 10), ("tail", 2, 5, 8, None, 11), ("rated", None, 5, 7, None, None), ("rated", None, 5, 8, None, None),
                   ("event", 4, 5, 9, 1.0, 12), ("event", 3, 5, 7, 4.5, 12)]
    assert [r[0] for r in processor.newest.rows] == [4, 3, 2] and processor.rated.rows == [(7,), (8,), (9,)]


def test_recs_upsert_stream_equals_batch(spark, split_events):
    fx = Fixtures(spark, SF_SMALL)
    n = fx.table("part").count()
    sim, stored = shared_sim(fx), fx.ratings().select("uid", "mid").distinct()
    stream = jobs.rating_events_of(jobs.read_event_stream(spark, split_events, max_files=1), n)
    base = new_subdir(spark, "t-recs")
    got = _rows(jobs.stream_recs(stream, spark, sim, base, stored), "uid", "mid", "score", "rank")
    ev = fx.rating_events()
    want = rt.latest_per_user(rt.realtime_recommendations(ev, sim, stored=stored), ev)
    assert got == _rows(want, "uid", "mid", "score", "rank") and got
    assert _rows(rt.latest_recommendations(ev, sim, stored), "uid", "mid", "score", "rank") == got
    # no folder of earlier ratings is kept, each batch holds its own users' lists
    assert set(list_subdirs(spark, base)) == {"checkpoint", "recs"}
    assert set(list_subdirs(spark, f"{base}/recs")) == {f"batch={i}" for i in range(4)}


def test_stop_and_restart_on_the_same_folder(spark, split_events):
    """A second start reads only what is new."""
    n = Fixtures(spark, SF_SMALL).table("part").count()
    base = new_subdir(spark, "t-resume")
    for _ in range(2):
        query = jobs.start_table(jobs.log_filter(jobs.log_lines_of(jobs.read_event_stream(spark, split_events, 1), n)), base)
        query.awaitTermination()
    got = spark.read.parquet(f"{base}/out")
    assert got.count() == got.distinct().count() == jobs.log_filter(jobs.log_lines_of(spark.read.parquet(split_events), n)).count()


def test_lists_over_restarts_replays_and_merging(spark):
    """A restart after each arrival, a repeated batch and merged folders give the batch result; a user
    whose latest event scores nothing loses the list."""
    fx = Fixtures(spark, SF_SMALL)
    sim = shared_sim(fx)
    mid = fx.rating_events().first().mid
    arrivals = _Arrivals(spark, "t-upsert")
    steps = [[(1, 7, mid, 5.0, 100), (2, 8, mid, 5.0, 100)], [(3, 7, 10_000_000, 5.0, 200)], [(4, 9, mid, 4.0, 300), (5, 9, mid, 1.0, 301)]]
    users = []
    for rows in steps:
        arrivals.add(rows)
        lists = jobs.stream_recs(arrivals.stream(), spark, sim, arrivals.base)
        users.append({r.uid for r in lists.collect()})
    assert users == [{7, 8}, {8}, {8, 9}]
    ev = _events_of(spark, [r for rows in steps for r in rows])
    cols = ["uid", "mid", "score", "rank"]
    want = _rows(rt.latest_per_user(rt.realtime_recommendations(ev, sim), ev), *cols)
    assert _rows(lists, *cols) == want
    sink = jobs.RecsUpserter(spark, sim, arrivals.base)
    context = _events_of(spark, steps[2]).withColumn("kind", F.lit("event"))
    sink(context, 2)                                                               # the last batch again
    assert _rows(jobs.newest_lists(spark, sink.recs), *cols) == want
    sink.merge(2)
    assert list_subdirs(spark, sink.recs) == ["batch=2"]
    assert _rows(jobs.newest_lists(spark, sink.recs), *cols) == want
    arrivals.add([(6, 8, 10_000_000, 5.0, 400)])
    assert {r.uid for r in jobs.stream_recs(arrivals.stream(), spark, sim, arrivals.base).collect()} == {9}


def test_service_trigger(spark):
    """The batch interval of a service: files that arrive while the query runs are taken up."""
    arrivals = _Arrivals(spark, "t-interval")
    arrivals.add([(1, 7, 1, 5.0, 100)])
    query = jobs.start_table(arrivals.stream(), arrivals.base, trigger_now=False)
    try:
        for want, more in ((1, [(2, 7, 2, 5.0, 101)]), (2, None)):
            end = time.time() + 60
            while time.time() < end and len(_taken(spark, arrivals.base)) < want:
                time.sleep(0.3)
            assert len(_taken(spark, arrivals.base)) == want
            if more:
                arrivals.add(more)
        assert query.isActive and "2 seconds" in jobs.BATCH_INTERVAL
    finally:
        query.stop()


def _taken(spark, base):
    schema = "event_id long, uid int, mid int, score double, ts long"
    return spark.read.schema(schema).parquet(f"{base}/out").collect() if has_file(spark, f"{base}/out/_spark_metadata/0") else []
