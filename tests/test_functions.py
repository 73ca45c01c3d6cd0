import hashlib

from pyspark.sql import functions as F

from ratewise.functions import columns as C
from ratewise.sources import text_formats as tf


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).head()["r"]


def test_width_conversions(spark):
    full = "ＡＢＣ　１２３！"
    assert one(spark, C.to_half_width("x"), full) == "ABC 123!"
    assert one(spark, C.to_full_width("x"), "ABC 123!") == full
    # characters outside the two ranges are untouched
    assert one(spark, C.to_half_width("x"), "é中") == "é中"


def _reference_digits(text: str) -> str:
    # high nibble of each digest byte, mod 10
    return "".join(str((b >> 4) % 10) for b in hashlib.md5(text.encode()).digest())


def test_md5_numeric_key_matches_byte_arithmetic(spark):
    for text in ["alice", "Bob", "", "用户"]:
        assert one(spark, C.md5_numeric_key("x"), text) == _reference_digits(text)


def test_half_star_bucket_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.2,), (0.25,), (2.5,), (2.74,), (3.0,), (5.0,)], "x double")
    got = [r[0] for r in df.select(C.half_star_bucket("x")).collect()]
    assert got == [0, 0, 1, 5, 5, 6, 10]


def test_log_prefix_extraction(spark):
    rows = [("INFO MOVIE_RATING_PREFIX:1|2|3.5|100 ",), ("INFO page hit 4",), ("x MOVIE_RATING_PREFIX:",),
            ("a MOVIE_RATING_PREFIX:1|2|3|4 MOVIE_RATING_PREFIX:9|9|9|9",)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(C.extract_after_prefix("x")).collect()]
    assert got == ["1|2|3.5|100", None, None, "1|2|3|4"]


def test_parse_rating_message_bad_fields_are_null(spark):
    r = one(spark, C.parse_rating_message("x"), "7|x|4.5| 1700000000 ")
    assert (r.uid, r.mid, r.score, r.ts) == (7, None, 4.5, 1700000000)


def test_java_split_drops_trailing_empties(spark):
    got = one(spark, tf.java_split(F.col("x"), ","), "a,,b,,")
    assert got == ["a", "", "b"]
    assert one(spark, F.size(tf.java_split(F.col("x"), ",")), ",,,") == 0


def test_quoted_fields(spark):
    got = one(spark, tf.quoted_fields("x"), '"1","a, b","","x"')
    assert got == ["1", "a, b", "", "x"]


def test_header_repeated_mid_file_is_dropped(spark):
    lines = spark.createDataFrame([("h",), ('"1","n","3.0",""',), ("h",), ('"2","m","0.0",""',)], "line string")
    out = tf.parse_quoted_items(lines, header="h").collect()
    assert [r.mid for r in out] == [1, 2]


def test_year_month_utc(spark):
    assert one(spark, C.year_month("x"), 1700000000, "x long") == 202311
