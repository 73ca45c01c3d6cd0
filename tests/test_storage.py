"""Text scans with rejects, keyed tables, ordered lists put together in chunks."""

import random

import pytest
from pyspark.sql import functions as F

from ratewise.operators import maintain, ranking, serving
from ratewise.session import new_subdir
from ratewise.sources import text_files as tx
from ratewise.sources import text_formats as tf


def _files(path, **texts):
    import os
    os.makedirs(path)
    for name, text in texts.items():
        with open(f"{path}/{name}.csv", "w") as f:
            f.write(text)
    return path


def test_scan_splits_rows_and_rejects(spark):
    path = _files(new_subdir(spark, "t-scan"), a="uid,mid,tag\n1,2, x \n3,z,y\n4,5\n", b="uid,mid,tag\n6,7,w\n8,9,v,more\n,1,n\n", empty="")
    rows, bad = tx.scan_delimited(spark, path, "uid int, mid int, tag string")
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, 2, "x"), (6, 7, "w"), (None, 1, "n")]
    assert sorted(r.line for r in bad.collect()) == ["3,z,y", "4,5", "8,9,v,more"]
    # the same lines are rejected whichever columns are read
    assert bad.select("line", "uid").count() == 3 and rows.select("tag").count() == 3 and bad.count() == 3


def test_written_files_have_their_header_and_come_back(spark):
    df = spark.range(50).select(F.col("id").cast("int").alias("a"), F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("t"), "id")).alias("b")).repartition(4)
    path = tx.text_folder(spark, "t-written", (df, True))
    assert spark.read.text(path).where("value = 'a,b'").count() == 4
    rows, bad = tx.scan_delimited(spark, path, "a int, b string")
    assert {tuple(r) for r in rows.collect()} == {tuple(r) for r in df.collect()} and bad.count() == 0
    assert tf.drop_header(tf.read_lines(spark, path), "a,b").count() == 50


def test_word_vector_rejects(spark):
    lines = spark.createDataFrame([("w 1 2.5",), ("v 1 x",), ("only",), (" u -3 4 ",)], "line string")
    rows, bad = tf.checked_word_vectors(lines)
    assert {(r.word, tuple(r.vec)) for r in rows.collect()} == {("w", (1.0, 2.5)), ("u", (-3.0, 4.0))}
    assert {r.line for r in bad.collect()} == {"v 1 x", "only"}


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyed_table_prunes_and_needs_no_exchange(spark):
    rows = spark.range(4000).select((F.col("id") % 500).cast("int").alias("uid"), F.col("id").alias("mid"))
    table = maintain.publish_keyed(rows, "t_keyed", "uid", buckets=8)
    one = table.where(F.col("uid") == 17)
    assert {r.mid for r in one.collect()} == set(range(17, 4000, 500))
    assert "EqualTo(uid,17)" in _plan(one)
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # the plan then names the buckets
    try:
        assert "SelectedBucketsCount: 1 out of 8" in _plan(table.where(F.col("uid") == 17))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    keys = spark.range(40).select((F.col("id") * 3).cast("int").alias("uid"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = maintain.lookup(table, keys, ["uid"])
        assert found.count() == 40 * 8
        plan = _plan(found)
        side = plan[plan.index("SortMergeJoin"):]
        assert "Bucketed: true" in plan and side.index("FileScan") < side.index("Exchange") or "Exchange" not in side.split("FileScan")[0]
        counts = table.groupBy("uid").count()
        assert {r["count"] for r in counts.collect()} == {8} and "Exchange" not in _plan(counts)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("chunk", [1, 7, 4096])
def test_a_key_with_most_rows_is_joined_in_chunks(spark, chunk):
    rnd = random.Random(2)
    rows = [(1 if i % 4 else 2 + i % 3, rnd.randrange(50), rnd.choice("abcde")) for i in range(300)]
    df = spark.createDataFrame(rows, "mid int, ts long, tag string").repartition(5)
    want = {}
    for mid, ts, tag in sorted(rows):
        want.setdefault(mid, []).append(tag)
    got = {r.mid: r.joined for r in ranking.ordered_join(df, "mid", ["ts", "tag"], "tag", "|", chunk).collect()}
    assert got == {k: "|".join(v) for k, v in want.items()}
    parts = ranking.ordered_chunks(df, "mid", ["ts", "tag"], F.col("tag"), chunk)
    assert parts.agg(F.max(F.size("values"))).first()[0] <= chunk
    lists = spark.createDataFrame([(k, m, s / 8) for m, (k, s, _) in enumerate(rows)], "key int, mid int, score double")
    packed = {r.key: [(x.mid, x.score) for x in r.recs] for r in serving.pack_lists(lists, "key", chunk=chunk).collect()}
    for k in {r[0] for r in rows}:
        assert packed[k] == sorted(((m, s / 8) for m, (q, s, _) in enumerate(rows) if q == k), key=lambda x: (-x[1], x[0]))


def test_no_rows_to_join(spark):
    assert ranking.ordered_join(spark.createDataFrame([], "mid int, ts long, tag string"), "mid", ["ts"], "tag", "|").count() == 0
