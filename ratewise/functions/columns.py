"""Scalar column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Full-width / half-width character ranges used by the width
# conversions.  U+3000 (ideographic space) <-> U+0020, and the full-width
# block U+FF01..U+FF5E <-> ASCII 33..126 (offset 0xFEE0).
HALF_WIDTH = " " + "".join(chr(c) for c in range(33, 127))
FULL_WIDTH = "\u3000" + "".join(chr(c + 0xFEE0) for c in range(33, 127))

# Fixed value: the marker that starts a rating entry in a log line.
RATING_PREFIX = "MOVIE_RATING_PREFIX:"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Timestamp -> whole epoch seconds (BIGINT), session time zone UTC."""
    return F.unix_timestamp(col(ts))


def year_month(epoch_s) -> Column:
    """Epoch seconds -> integer ``yyyyMM``."""
    return F.date_format(F.timestamp_seconds(col(epoch_s)), "yyyyMM").cast("int")


def to_timestamp_any(x) -> Column:
    """Q8: one canonical timestamp from seconds or milliseconds (values
    above 1e11 are taken as milliseconds)."""
    v = col(x).cast("double")
    return F.when(v > 1e11, F.timestamp_millis(v.cast("long"))).otherwise(
        F.timestamp_seconds(v.cast("long")))


def category_spaces(genres) -> Column:
    """Category delimiters ``|`` and ``/`` become spaces."""
    return F.translate(col(genres), "|/", "  ")


def contains_ci(text, needle) -> Column:
    """C4: case-insensitive substring test."""
    return F.contains(F.lower(col(text)), F.lower(col(needle)))


def to_half_width(text) -> Column:
    """Full-width characters -> half-width."""
    return F.translate(col(text), FULL_WIDTH, HALF_WIDTH)


def to_full_width(text) -> Column:
    """Half-width characters -> full-width."""
    return F.translate(col(text), HALF_WIDTH, FULL_WIDTH)


def tokens(text) -> Column:
    """Lower-cased letter/digit runs of length > 1 (whole text)."""
    runs = F.regexp_extract_all(F.lower(F.trim(col(text))), F.lit(r"([\p{L}\p{N}]+)"), 1)
    return F.filter(runs, lambda t: F.length(t) > 1)


def whitespace_tokens(text) -> Column:
    """``Tokenizer`` semantics - lower-case, split on single spaces."""
    return F.split(F.lower(col(text)), r"\s")


def md5_numeric_key(text) -> Column:
    """16-digit numeric surrogate key from MD5.

    For each of the 16 digest bytes the high nibble is taken mod 10.  The
    high nibble is the first hex digit of each byte pair, and a hex digit
    d in 0..15 mod 10 maps a..f onto 0..5."""
    firsts = F.regexp_replace(F.md5(col(text)), "(.).", "$1")
    return F.translate(firsts, "abcdef", "012345")


def log10_floor1(n) -> Column:
    """Log base 10 where counts 0 and 1 both give 0."""
    return F.log10(F.greatest(col(n), F.lit(1)).cast("double"))


def parse_rating_message(msg) -> Column:
    """``uid|mid|score|epoch`` -> struct; malformed fields are NULL."""
    parts = F.split(F.trim(col(msg)), r"\|")
    return F.struct(
        F.get(parts, 0).try_cast("int").alias("uid"),
        F.get(parts, 1).try_cast("int").alias("mid"),
        F.get(parts, 2).try_cast("double").alias("score"),
        F.trim(F.get(parts, 3)).try_cast("long").alias("ts"),
    )


def extract_after_prefix(line, prefix: str = RATING_PREFIX) -> Column:
    """Text after the prefix, up to the next prefix, trimmed; NULL when
    the prefix is absent or nothing follows it (Q23)."""
    parts = F.split(col(line), F.lit(_regex_quote(prefix)))
    body = F.trim(F.get(parts, 1))
    return F.when(F.contains(col(line), F.lit(prefix)) & (F.length(body) > 0), body)


def parse_recent_list(entries) -> Column:
    """C14: array of ``mid:score`` strings -> array<struct<mid,score>>."""
    def one(e):
        p = F.split(e, ":")
        return F.struct(F.trim(F.get(p, 0)).try_cast("int").alias("mid"),
                        F.trim(F.get(p, 1)).try_cast("double").alias("score"))
    return F.transform(col(entries), one)


def half_star_bucket(score) -> Column:
    """``Math.round(score / 0.5)`` (half-up) -> bucket 0..10."""
    return F.floor(col(score) / 0.5 + 0.5).cast("int")


def unquote(field) -> Column:
    """Drop first and last character when longer than 2, else ''."""
    f = col(field)
    return F.when(F.length(f) > 2, F.substring(f, F.lit(2), F.length(f) - 2)).otherwise(F.lit(""))


def _regex_quote(s: str) -> str:
    import re
    return re.escape(s)
