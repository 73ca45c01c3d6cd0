"""Loading and text-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.functions.columns import FULL_WIDTH as FULL
from ratewise.functions.columns import HALF_WIDTH as HALF
from ratewise.functions.columns import md5_numeric_key, to_full_width, to_half_width
from ratewise.operators import maintain
from ratewise.operators.stats import item_stats
from ratewise.plans.registry import query
from ratewise.session import new_subdir
from ratewise.sources import text_formats as tf
from ratewise.sources.fixtures import COMMENT_HEADER, QUOTED_HEADER, Fixtures
from ratewise.sources.tables import read_typed, table_path
from ratewise.sources.text_files import scan_delimited

# DuckDB twins of the quote-aware split + unquote and of the naive count
DUCK_QUOTED = ("list_transform(regexp_extract_all(line, '(^|,)(\"[^\"]*\"|[^,\"]*)', 2), "
               "lambda x: CASE WHEN length(x) > 2 THEN x[2:length(x)-1] ELSE '' END)")
DUCK_NAIVE_COUNT = "len(string_split(regexp_replace(line, ',+$', ''), ','))"


def _sql_lit(s: str) -> str:
    return s.replace("'", "''")


ITEM_SCHEMA = "mid int, name string, descri string, timelong string, issue string, shoot string, language string, genres string, actors string, directors string"
CARET_ITEMS_SQL = """
SELECT mid, name, descri, CAST(timelong % 10 AS VARCHAR) AS timelong, CAST(issue AS VARCHAR) AS issue, 'x' AS shoot,
       'en' AS language, genres, 'a' AS actors, 'd' AS directors
FROM items WHERE mid % 10 <> 7"""


def _items_scan(fx: Fixtures):
    return scan_delimited(fx.spark, fx.item_files(), ITEM_SCHEMA, sep="^", header=False, quote="")


def _ratings_scan(fx: Fixtures):
    return scan_delimited(fx.spark, fx.rating_files(), "uid int, mid int, score double, ts long")


def _tags_scan(fx: Fixtures):
    return scan_delimited(fx.spark, fx.tag_files(), "uid int, mid int, tag string, ts long")


def _vectors_scan(fx: Fixtures):
    return tf.checked_word_vectors(tf.read_lines(fx.spark, fx.word_vector_files()))


@query("load_caret_items", sql=CARET_ITEMS_SQL)
def load_caret_items(fx: Fixtures):
    """A1: scan of ``^``-separated item files -> typed, trimmed rows."""
    return _items_scan(fx)[0]


@query("load_csv_ratings", sql="SELECT uid, mid, score, ts FROM ratings")
def load_csv_ratings(fx: Fixtures):
    """A2 + A4: scan of comma rating files, a header line in each -> (uid, mid, score, ts)."""
    return _ratings_scan(fx)[0]


TAG_LINES_SQL = """
SELECT event_id, CAST(user_id AS INT) AS uid, CAST(event_id % (SELECT count(*) FROM part) AS INT) AS mid, event_type AS tag,
       CAST(floor(epoch(ts)) AS BIGINT) AS ts
FROM events"""


@query("load_csv_tags", sql=f"SELECT uid, mid, tag, ts FROM ({TAG_LINES_SQL}) t WHERE event_id % 11 <> 0")
def load_csv_tags(fx: Fixtures):
    """A3 + A4: scan of comma tag files -> (uid, mid, tag trimmed, ts)."""
    return _tags_scan(fx)[0]


@query("load_rejects", sql=f"""
SELECT 'ratings' AS source, concat_ws(',', concat('u', CAST(r.uid AS VARCHAR)), CAST(r.mid AS VARCHAR), CAST(r.score AS VARCHAR), CAST(r.ts AS VARCHAR)) AS line, r.mid
FROM rating_events r JOIN events e USING (event_id) WHERE e.event_type = 'error'
UNION ALL
SELECT 'tags', concat_ws(',', CAST(uid AS VARCHAR), CAST(mid AS VARCHAR), concat(' ', tag, ' ')), mid FROM ({TAG_LINES_SQL}) t WHERE event_id % 11 = 0
UNION ALL
SELECT 'items', concat_ws('^', CAST(mid AS VARCHAR), concat(' ', name, ' '), descri, CAST(timelong % 10 AS VARCHAR)), mid FROM items WHERE mid % 10 = 7
UNION ALL
SELECT 'vectors', word, CAST(NULL AS INT) FROM word_vectors JOIN word_freq USING (word) WHERE rk % 10 = 0""")
def load_rejects(fx: Fixtures):
    """The lines that don't fit their file's layout, as they stand (of a vector line its word)."""
    parts = [bad.select(F.lit(name).alias("source"), "line", "mid")
             for name, (_, bad) in (("ratings", _ratings_scan(fx)), ("tags", _tags_scan(fx)), ("items", _items_scan(fx)))]
    vectors = _vectors_scan(fx)[1].select(F.lit("vectors").alias("source"), F.split_part("line", F.lit(" "), F.lit(1)).alias("line"),
                                          F.lit(None).cast("int").alias("mid"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(vectors)


@query("load_quoted_items", sql="""
SELECT mid, concat(name, ', ', descri) AS name, concat(CAST(timelong % 10 AS VARCHAR), '.0') AS timelong, '' AS tag FROM items""")
def load_quoted_items(fx: Fixtures):
    """A4-A6 + A10: scan of quoted item files, headers dropped, quote-aware split, unquoted."""
    return tf.parse_quoted_items(tf.read_lines(fx.spark, fx.quoted_item_files()), QUOTED_HEADER)


@query("load_v2_tags", sql="SELECT mid, '' AS tag FROM items")
def load_v2_tags(fx: Fixtures):
    """A10/Q16: (mid, tag) view of the item files, split quote-aware."""
    return load_quoted_items(fx).select("mid", "tag")


@query("filter_valid_items", sql=f"""
SELECT mid, name, concat(timelong, '.0') AS timelong, CAST(CAST(substr(issue, 1, 4) AS INT) + mid % 40 AS VARCHAR) AS year
FROM ({CARET_ITEMS_SQL}) t
WHERE timelong <> '0' AND CAST(substr(issue, 1, 4) AS INT) + mid % 40 <= 2021""")
def filter_valid_items(fx: Fixtures):
    """Items with a non-zero duration and a year up to 2021 (both conditions drop rows)."""
    year = F.substring("issue", 1, 4).cast("int") + F.col("mid") % 40
    it = _items_scan(fx)[0].select("mid", "name", F.concat("timelong", F.lit(".0")).alias("timelong"), year.cast("string").alias("year"))
    return tf.valid_items(it)


@query("load_v2_ratings", sql=f"""
SELECT TRY_CAST(f[9] AS INT) AS uid, TRY_CAST(f[5] AS INT) AS mid, TRY_CAST(f[10] AS DOUBLE) AS score,
       f[1] AS timestamp
FROM (SELECT {DUCK_QUOTED} AS f FROM comment_lines WHERE {DUCK_NAIVE_COUNT} = 14) t
WHERE f[10] <> ''""")
def load_v2_ratings(fx: Fixtures):
    """A8 + A10: scan of comment files; lines of 14 fields with a score -> ratings."""
    return tf.parse_v2_ratings(tf.read_lines(fx.spark, fx.comment_files()), COMMENT_HEADER)


@query("load_v2_comments", sql=f"""
SELECT TRY_CAST(f[9] AS INT) AS uid, TRY_CAST(f[5] AS INT) AS mid, f[2] AS content, f[1] AS timestamp
FROM (SELECT {DUCK_QUOTED} AS f FROM comment_lines WHERE {DUCK_NAIVE_COUNT} = 14) t""")
def load_v2_comments(fx: Fixtures):
    """A9 + A10: scan of comment files; lines of 14 fields -> comments."""
    return tf.parse_v2_comments(tf.read_lines(fx.spark, fx.comment_files()), COMMENT_HEADER)


@query("load_word_vectors", sql="""
SELECT word, len(vec) AS dims, round(sqrt(list_sum(list_transform(vec, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 4) AS norm
FROM word_vectors JOIN word_freq USING (word) WHERE rk % 10 <> 0""")
def load_word_vectors(fx: Fixtures):
    """Scan of ``word f1 .. fn`` files -> (word, vector); reported as dims and norm."""
    wv = _vectors_scan(fx)[0]
    sq = F.aggregate(F.transform("vec", lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, b: a + b)
    return wv.select("word", F.size("vec").cast("long").alias("dims"), F.round(F.sqrt(sq), 4).alias("norm"))


RATING_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()), T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])


@query("scan_typed_ratings", sql="""
SELECT l_orderkey, CAST(l_partkey AS INT) AS mid, l_linenumber, l_quantity / CAST(10.0 AS DOUBLE) AS score,
       CAST(floor(epoch(l_shipdate)) AS BIGINT) AS ts
FROM lineitem""")
def scan_typed_ratings(fx: Fixtures):
    """Scan with a pinned schema (no inference; pruned ReadSchema)."""
    li = read_typed(fx.spark, table_path(fx.sf_dir, "lineitem"), RATING_SCHEMA)
    return li.select("l_orderkey", F.col("l_partkey").cast("int").alias("mid"), "l_linenumber",
                     (F.col("l_quantity") / F.lit(10.0)).alias("score"),
                     F.unix_timestamp("l_shipdate").alias("ts"))


@query("text_width_widen", sql=f"""
SELECT CAST(doc_id AS INT) AS mid, md5(translate(text, '{_sql_lit(HALF)}', '{_sql_lit(FULL)}')) AS digest,
       length(text) AS n_chars
FROM documents""")
def text_width_widen(fx: Fixtures):
    """C6 over whole documents; digest of the widened text."""
    d = fx.docs()
    return d.select("mid", F.md5(to_full_width("descri")).alias("digest"), F.length("descri").cast("long").alias("n_chars"))


# Letters of every second document that arrive in full width.
WIDE_FROM, WIDE_TO = "aeinost 0123456789", "ａｅｉｎｏｓｔ　０１２３４５６７８９"


@query("text_width_normalise", sql=f"""
SELECT CAST(doc_id AS INT) AS mid,
       md5(translate(CASE WHEN doc_id % 2 = 0 THEN translate(text, '{WIDE_FROM}', '{WIDE_TO}') ELSE text END,
                     '{_sql_lit(FULL)}', '{_sql_lit(HALF)}')) AS digest,
       len(regexp_extract_all(CASE WHEN doc_id % 2 = 0 THEN translate(text, '{WIDE_FROM}', '{WIDE_TO}') ELSE text END,
                              '[\u3000\uFF01-\uFF5E]')) AS n_wide
FROM documents""".replace("\\u3000", "　").replace("\\uFF01", "！").replace("\\uFF5E", "～"))
def text_width_normalise(fx: Fixtures):
    """C5 over whole documents, of which every second one holds full-width letters, digits and blanks."""
    d = fx.docs()
    mixed = F.when(F.col("mid") % 2 == 0, F.translate("descri", WIDE_FROM, WIDE_TO)).otherwise(F.col("descri"))
    wide = F.size(F.regexp_extract_all(mixed, F.lit("([　！-～])"), 1)).cast("long")
    return d.select("mid", F.md5(to_half_width(mixed)).alias("digest"), wide.alias("n_wide"))


@query("md5_numeric_key", sql="""
SELECT uid, username, translate(regexp_replace(md5(username), '(.).', '\\1', 'g'), 'abcdef', '012345') AS num_key
FROM users""")
def md5_numeric_key_q(fx: Fixtures):
    """16-digit numeric key of each user name."""
    return fx.users().select("uid", "username", md5_numeric_key("username").alias("num_key"))


@query("publish_table_roundtrip", sql="""
SELECT mid, count(*) AS count, round(avg(score), 6) AS avg FROM ratings GROUP BY mid""")
def publish_table_roundtrip(fx: Fixtures):
    """B1 + B2: overwrite a derived table in the shared folder, read it back."""
    path = new_subdir(fx.spark, "published")
    stats = item_stats(fx.item_ratings()).withColumn("avg", F.round("avg", 6))
    maintain.publish(stats, path, key="mid")
    return fx.spark.read.parquet(path)


@query("lookup_user_ratings", sql="""
SELECT r.uid, r.mid, r.score, r.ts FROM ratings r
WHERE r.uid IN (SELECT uid FROM users WHERE pref_genre = 'LARGE')""")
def lookup_user_ratings(fx: Fixtures):
    """B3 + C16: key-set lookup in a rating table that is stored in buckets by user."""
    keys = fx.users().where(F.col("pref_genre") == "LARGE").select("uid")
    return maintain.lookup(keyed_ratings(fx), keys, ["uid"]).select("uid", "mid", "score", "ts")


def keyed_ratings(fx: Fixtures):
    """The rating table in buckets by user, written once per run."""
    if "keyed_ratings" not in fx._memo:
        fx._memo["keyed_ratings"] = maintain.publish_keyed(fx.ratings().select("uid", "mid", "score", "ts"), "ratings", "uid")
    return fx._memo["keyed_ratings"]
