from pyspark.sql import Window
from pyspark.sql import functions as F

from ratewise.operators import search
from ratewise.operators.ranking import TEXTS_A_TASK, global_row_number, spread, top_k_per_group


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1000).alias("a"), F.col("id").alias("b")).repartition(7)
    order = [F.col("a").desc(), F.col("b").asc()]
    got = {(r.a, r.b): r.rn for r in global_row_number(df, order, num_partitions=5).collect()}
    want = {(r.a, r.b): r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == want


def test_top_k_per_group_ties_broken(spark):
    df = spark.createDataFrame([("x", 1, 5.0), ("x", 2, 5.0), ("x", 3, 4.0), ("y", 4, 1.0)], "k string, id int, v double")
    out = top_k_per_group(df, ["k"], [F.col("v").desc(), F.col("id").asc()], 2).collect()
    assert sorted((r.k, r.id, r.rank) for r in out) == [("x", 1, 1), ("x", 2, 2), ("y", 4, 1)]


def test_tasks_of_texts_grow_in_number_not_in_size(spark):
    """Five times the rows are five times the partitions, those of one key in one."""
    for n in (10_000, 50_000):
        rows = spread(spark.range(n).select((F.col("id") % (n // 2)).alias("mid")), "mid", 500)
        sizes = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count("mid").alias("n"), F.count_distinct("mid").alias("k"))
        got = sizes.agg(F.count("p").alias("parts"), F.max("n").alias("most"), F.sum("k").alias("keys")).first()
        assert got["parts"] > 0.8 * n / 500 and got["most"] < 2 * 500 and got["keys"] == n // 2


def test_postings_are_made_in_tasks_of_bounded_size(spark):
    docs = spark.range(40_000).select("id", F.lit("a b a").alias("t"))
    post = search.build_postings(docs, "id", ["t"])
    assert post.rdd.getNumPartitions() >= 40_000 // TEXTS_A_TASK
    assert post.where("term = 'a' and tf = 2 and dl = 3").count() == 40_000
