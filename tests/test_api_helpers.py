"""Operator-API helpers not used by a registered query."""

import tempfile

from pyspark.sql import functions as F

from ratewise.functions.columns import to_timestamp_any
from ratewise.operators import maintain, serving, text
from ratewise.sources import text_formats as tf


def test_publish_all_and_read_back(spark):
    base = tempfile.mkdtemp(prefix="ratewise-pub-")
    a = spark.createDataFrame([(2, "x"), (1, "y")], "mid int, v string")
    b = spark.createDataFrame([(5,)], "uid int")
    maintain.publish_all({"items": a, "users": b}, base, keys={"items": "mid"})
    assert sorted(tuple(r) for r in spark.read.parquet(f"{base}/items").collect()) == [(1, "y"), (2, "x")]
    assert spark.read.parquet(f"{base}/users").count() == 1


def test_explode_and_pack_round_trip(spark):
    long = spark.createDataFrame([(1, 5, 0.2), (1, 6, 0.9)], "key int, mid int, score double")
    out = serving.explode_lists(serving.pack_lists(long, "key"), "key").collect()
    assert [(r.pos, r.mid) for r in out] == [(0, 6), (1, 5)]


def test_category_lists_exact_name(spark):
    top = spark.createDataFrame([("Small", 9, 4.0, 1), ("Small", 8, 3.0, 2), ("Large", 7, 5.0, 1)],
                                "category string, mid int, avg double, rank long")
    names = spark.createDataFrame([("Small",)], "category string")
    assert [r.mid for r in serving.category_lists(top, names, 1).collect()] == [9]


def test_term_counts(spark):
    terms = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "id int, term string")
    got = {(r.term, r.tf) for r in text.term_counts(terms, "id").collect()}
    assert got == {("a", 2), ("b", 1)}


def test_file_header_drops_every_copy(spark):
    d = tempfile.mkdtemp(prefix="ratewise-txt-")
    with open(f"{d}/x.csv", "w") as fh:
        fh.write("h1,h2\n1,2\nh1,h2\n3,4\n")
    lines = tf.read_lines(spark, f"{d}/x.csv")
    kept = tf.drop_header(lines, tf.file_header(spark, f"{d}/x.csv"))
    assert [r.line for r in kept.collect()] == ["1,2", "3,4"]


def test_timestamps_seconds_or_millis(spark):
    df = spark.createDataFrame([(1700000000,), (1700000000123,)], "x long")
    got = [r[0] for r in df.select(F.unix_timestamp(to_timestamp_any("x"))).collect()]
    assert got == [1700000000, 1700000000]
