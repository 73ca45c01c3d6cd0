"""Sinks and table maintenance (B1-B9) as set-based DataFrame jobs.

Point writes of the serving layer become whole-batch operations: a batch
of updates is joined with the stored table once, instead of one lookup and
one write per row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.operators.ranking import ordered_join
from ratewise.session import new_subdir


def publish(df: DataFrame, path: str, key: str | None = None, mode: str = "overwrite") -> None:
    """B1/B2 (+B3 layout): full overwrite of a derived table.

    With ``key`` the rows are range-partitioned and sorted on it, so the
    parquet row groups carry tight min/max statistics and a point lookup
    on ``key`` skips all other row groups (the stand-in for an index)."""
    if key is not None:
        df = df.repartitionByRange(key).sortWithinPartitions(key)
    df.write.mode(mode).parquet(path)


def publish_all(tables: dict[str, DataFrame], base: str, keys: dict[str, str] | None = None) -> None:
    """B2: rebuild a set of base tables under one folder."""
    keys = keys or {}
    for name, df in tables.items():
        publish(df, f"{base.rstrip('/')}/{name}", keys.get(name))


def publish_keyed(df: DataFrame, name: str, key: str, buckets: int = 32) -> DataFrame:
    """A table in ``buckets`` files by a hash of ``key``, each sorted on it, in the shared folder.

    A join or aggregation on the key reads it where it lies, without an exchange; a lookup of one key
    reads one bucket, and of that the row groups whose range holds the key.  The table's
    catalog entry carries the layout; it is gone once the plan is made, the files stay."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, key).sortWithinPartitions(key).write.bucketBy(buckets, key).sortBy(key)
       .option("path", new_subdir(spark, f"keyed-{name}")).saveAsTable(table))
    out = spark.table(table)
    out.schema
    spark.sql(f"DROP TABLE {table}")
    return out


def lookup(table: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``table`` whose key is in ``keys`` (a semi join; a
    single literal key is the special case ``where(key == lit)``)."""
    return table.join(keys.select(*on).distinct(), on, "left_semi")


def upsert_scores(old: DataFrame, updates: DataFrame, keys=("uid", "mid"),
                  order=("ts", "event_id")) -> DataFrame:
    """Apply a batch of (uid, mid, score, ts) writes to a rating table.

    Sequential semantics of insert-or-update: a new key is inserted with the
    first write's timestamp; every later write only replaces the score
    (Q20: the timestamp is kept).  Batch form: per key, last score and first
    timestamp of the updates; then old LEFT JOIN updates (old rows may be
    skewed on a key - a left outer join's streamed side can be split by AQE)
    plus updates whose key is absent (anti join against distinct old keys,
    de-duplicated map-side before the shuffle)."""
    k = list(keys)
    o = F.struct(*[F.col(c) for c in order])
    latest = updates.groupBy(*k).agg(F.max_by("score", o).alias("_new_score"), F.min("ts").alias("_new_ts"))
    kept = (old.join(latest, k, "left")
            .select(*k, F.coalesce("_new_score", "score").alias("score"), F.coalesce("ts", "_new_ts").alias("ts")))
    inserted = (latest.join(old.select(*k).distinct(), k, "left_anti")
                .select(*k, F.col("_new_score").alias("score"), F.col("_new_ts").alias("ts")))
    return kept.unionByName(inserted)


def delete_keys(table: DataFrame, deletes: DataFrame, on: list[str]) -> DataFrame:
    """Remove every row whose key is in ``deletes`` (Q11: all matches)."""
    return table.join(deletes.select(*on).distinct(), on, "left_anti")


def append_tags(index: DataFrame, new_tags: DataFrame) -> DataFrame:
    """Append new tags to the index field ``tags`` of each item.

    ``tags = tags IS NULL ? new : tags || '|' || new``, duplicates kept,
    new tags in write order (ts, tag).  A much tagged item's new tags are joined
    in chunks first (``ranking.ordered_join``)."""
    appended = ordered_join(new_tags, "mid", ["ts", "tag"], "tag", "|").withColumnRenamed("joined", "_new")
    return (index.join(appended, "mid", "left")
            .select("mid", F.when(F.col("_new").isNull(), F.col("tags"))
                    .when(F.col("tags").isNull(), F.col("_new"))
                    .otherwise(F.concat_ws("|", "tags", "_new")).alias("tags")))


def update_preferences(users: DataFrame, updates: DataFrame) -> DataFrame:
    """Append comma-split categories to a user's preference list and
    clear the ``first`` flag of updated users."""
    return (users.join(updates.select("uid", "new_prefs"), "uid", "left")
            .select("uid",
                    F.when(F.col("new_prefs").isNull(), F.col("prefs"))
                     .otherwise(F.concat("prefs", F.split("new_prefs", ","))).alias("prefs"),
                    (F.col("first") & F.col("new_prefs").isNull()).alias("first")))


def replace_lists(current: DataFrame, fresh: DataFrame, key: str = "uid", touched: DataFrame | None = None) -> DataFrame:
    """Per-key upsert of a whole list: the lists of ``touched`` keys are
    replaced by their rows in ``fresh`` - by nothing, where there is none -
    and other rows stay (delete-then-insert, set-based).  Without
    ``touched`` the keys of ``fresh`` are replaced."""
    keys = (fresh if touched is None else touched).select(key).distinct()
    return current.join(keys, key, "left_anti").unionByName(fresh)
