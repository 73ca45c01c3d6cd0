from pyspark.sql import functions as F

from ratewise.operators import maintain, serving
from ratewise.plans.serving import hydrate_recs
from ratewise.sources.fixtures import Fixtures

from conftest import SF_SMALL


def test_hybrid_keeps_duplicates_or_sums(spark):
    sch = "uid int, mid int, score double"
    cf = spark.createDataFrame([(1, 10, 1.0), (1, 11, 0.5)], sch)
    content = spark.createDataFrame([(1, 10, 1.0)], sch)
    stream = spark.createDataFrame([(1, 12, 2.0), (1, 10, 0.1)], sch)
    dup = serving.hybrid_blend(cf, content, stream, "uid", 10).collect()
    assert sorted(r.mid for r in dup) == [10, 10, 10, 11, 12]
    summed = {r.mid: r.score for r in serving.hybrid_blend(cf, content, stream, "uid", 10, dedupe="sum").collect()}
    assert abs(summed[10] - (0.3 + 0.3 + 0.04)) < 1e-9 and abs(summed[12] - 0.8) < 1e-9


def test_pack_lists_sorted_desc(spark):
    long = spark.createDataFrame([(1, 5, 0.2), (1, 6, 0.9), (1, 4, 0.9)], "key int, mid int, score double")
    recs = serving.pack_lists(long, "key").head().recs
    assert [(r.mid, r.score) for r in recs] == [(4, 0.9), (6, 0.9), (5, 0.2)]


def test_missing_key_gives_empty_list(spark):
    lists = spark.createDataFrame([(1, 5, 0.2)], "key int, mid int, score double")
    keys = spark.createDataFrame([(2,)], "key int")
    assert serving.lists_for_keys(keys, lists, "key", 10).count() == 0


def test_upsert_keeps_first_timestamp(spark):
    old = spark.createDataFrame([(1, 1, 2.0, 100)], "uid int, mid int, score double, ts long")
    upd = spark.createDataFrame([(1, 1, 4.0, 200, 1), (2, 2, 3.0, 300, 2), (2, 2, 5.0, 400, 3)],
                                "uid int, mid int, score double, ts long, event_id long")
    got = {(r.uid, r.mid): (r.score, r.ts) for r in maintain.upsert_scores(old, upd).collect()}
    assert got == {(1, 1): (4.0, 100), (2, 2): (5.0, 300)}


def test_delete_removes_all_matches(spark):
    t = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "uid int, mid int")
    d = spark.createDataFrame([(1, 1)], "uid int, mid int")
    assert [tuple(r) for r in maintain.delete_keys(t, d, ["uid", "mid"]).collect()] == [(1, 2)]


def test_append_tags_keeps_duplicates_in_order(spark):
    idx = spark.createDataFrame([(1, "a|b"), (2, None)], "mid int, tags string")
    new = spark.createDataFrame([(1, "z", 5), (1, "z", 6), (2, "q", 1)], "mid int, tag string, ts long")
    got = {r.mid: r.tags for r in maintain.append_tags(idx, new).collect()}
    assert got == {1: "a|b|z|z", 2: "q"}


def test_cold_start_uses_category_list(spark):
    users = spark.createDataFrame([(1, "LARGE"), (2, "SMALL")], "uid int, pref string")
    lists = spark.createDataFrame([(1, 7, 0.5)], "uid int, mid int, score double")
    top = spark.createDataFrame([("Small", 9, 4.0, 1)], "category string, mid int, avg double, rank long")
    got = {(r.uid, r.mid, r.source) for r in serving.cold_start(users, lists, top, 10).collect()}
    assert got == {(1, 7, "list"), (2, 9, "category")}


def test_hydrated_averages_are_of_all_ratings(spark):
    """Old ratings count as much as those of the last days."""
    fx = Fixtures(spark, SF_SMALL)
    every = {r.mid: r.avg for r in fx.item_ratings().groupBy("mid").agg(F.avg("score").alias("avg")).collect()}
    rows = hydrate_recs(fx).select("mid", "avg").distinct().collect()
    assert rows and all(abs(r.avg - every.get(r.mid, 0.0)) < 1e-6 for r in rows)
