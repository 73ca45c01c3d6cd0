"""URL rules by a sort-merge range join on reversed-host keys.

A host is keyed by its labels in reverse, each followed by a dot
(``www.example.net`` -> ``net.example.www.``), so "this host and all its
subdomains" is one interval of keys: those that start with the rule's key.
Rules and urls are dealt into key ranges, sorted, and one sweep per range keeps
a stack of the rule hosts whose interval is open - they are nested, so leaving
one is a pop.  Each stack entry holds the path prefixes of its host; the
longest rule (host and path together) that fits decides.

Ranges.  Boundaries are quantiles of a bounded sample of (host key, path, row
hash); they set only the balance of the tasks, never a result.  The row hash
lets a host or even a single url that holds a third of all rows span many
ranges.  A rule is copied into the ranges its interval touches: those inside
it, which is what a sweep starting there needs; no rule table is broadcast.

Defined results: a null url, or one without ``://``, has an empty host and
path and fits only rules with an empty host; urls are taken as they are (a
port or user name stays part of the host); rules of equal length that both fit
are ranked by the text of the rule; a rule listed twice (also in other case)
counts once, with its smallest text and verdict; a null rule or verdict is ignored; equal urls and page ids are judged
row by row; an empty rule table gives every url the default, an empty page table no row; a
url of any length is judged whole; further columns of either table may have any name."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm.common import ascii_lower, kernel

SAMPLE_PER_RANGE = 32
MOST_PATHS = 100_000
_END = "\U0010ffff"


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """A rule table from (rule, verdict) pairs; a rule is ``host/path``."""
    return spark.createDataFrame(rules, "rule string, verdict string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(url.isNull() | (at == 0), F.lit("")).otherwise(F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def reversed_key(host: Column) -> Column:
    """Labels in reverse, each with a dot behind; the empty host has the empty key."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _bounds(keys: DataFrame, ranges: int) -> list[tuple[str, str, int]]:
    """At most ``ranges - 1`` boundaries, from at most SAMPLE_PER_RANGE * ranges rows
    taken in the order of their hash (the same rows however often it runs)."""
    sample = keys.orderBy("salt", "key", "path").limit(SAMPLE_PER_RANGE * ranges).collect()
    sample = sorted((r["key"], r["path"], r["salt"]) for r in sample)
    step = max(1, len(sample) // ranges)
    return sorted(set(sample[step::step][:ranges - 1]))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (range, key, rules first); yields the judged urls."""
    stack: list[tuple[str, dict[str, tuple[str, str]]]] = []
    seen: dict[str, tuple[str | None, str | None]] = {}
    at = None
    for b in batches:
        rows = zip(*(b.column(c).to_pylist() for c in ("range", "key", "path", "rule", "verdict")))
        found: list[tuple[str | None, str | None]] = []
        for rng, key, path, rule, verdict in rows:
            if (rng, key) != at:
                if at is None or rng != at[0]:
                    stack.clear()
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                at = (rng, key)
                seen.clear()
            if rule is not None:
                if not stack or stack[-1][0] != key:
                    stack.append((key, {}))
                stack[-1][1][path] = (rule, verdict)
                continue
            best = seen.get(path)
            if best is None:
                if len(seen) >= MOST_PATHS:  # remembered to save work only
                    seen.clear()
                fits = [r for _, paths in stack for n in {len(p) for p in paths} if n <= len(path) and (r := paths.get(path[:n]))]
                best = seen[path] = max(fits, key=lambda r: (len(r[0]), r[0]), default=(None, None))
            found.append(best)
        urls = b.filter(b.column("is_url"))
        yield pa.RecordBatch.from_arrays(
            [urls.column("page_id"), urls.column("host"), urls.column("path"),
             pa.array([r for r, _ in found], pa.string()), pa.array([v for _, v in found], pa.string())],
            ["page_id", "host", "path", "rule", "verdict"])


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
               url_col: str = "url", ranges: int | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``.

    ``rules`` has columns rule (``host/path``) and verdict.  A rule fits its
    host and all subdomains when the url's path starts with the rule's path."""
    spark = kernel(pages)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = host_and_path(F.col("url"))
    urls = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
                 .select("page_id", host.alias("host"), path.alias("path"),
                         F.xxhash64("page_id", "url").alias("salt"))
                 .withColumn("key", reversed_key(F.col("host"))))
    bounds = _bounds(urls.select("key", "path", "salt"), ranges)

    @F.pandas_udf("int")
    def url_range(key: pd.Series, path: pd.Series, salt: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, k) for k in zip(key, path, salt)], dtype="int32")

    @F.pandas_udf("array<int>")
    def rule_ranges(key: pd.Series) -> pd.Series:
        lowest = -(1 << 63)
        return pd.Series([list(range(bisect_right(bounds, (k, "", lowest)), bisect_right(bounds, (k + _END, "", lowest)) + 1))
                          for k in key], dtype=object)

    rule_host = ascii_lower(F.regexp_extract("rule", r"^([^/]*)", 1))
    rule_rows = (rules.where(F.col("rule").isNotNull() & F.col("verdict").isNotNull())
                      .groupBy(reversed_key(rule_host).alias("key"), F.regexp_extract("rule", r"^[^/]*([\s\S]*)$", 1).alias("path"))
                      .agg(F.min(F.struct("rule", "verdict")).alias("r")).select("key", "path", "r.*")
                      .withColumn("range", F.explode(rule_ranges("key")))
                      .select("range", "key", "path", "rule", "verdict", F.lit(False).alias("is_url"),
                              F.lit(None).cast(urls.schema["page_id"].dataType).alias("page_id"), F.lit("").alias("host")))
    url_rows = urls.select(url_range("key", "path", "salt").alias("range"), "key", "path",
                           F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"),
                           F.lit(True).alias("is_url"), "page_id", "host")
    events = (url_rows.unionByName(rule_rows).repartition(ranges, "range")
                      .sortWithinPartitions("range", "key", "is_url"))
    kind = urls.schema["page_id"].dataType.simpleString()
    judged = events.mapInArrow(_sweep, f"page_id {kind}, host string, path string, rule string, verdict string")
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
