"""Line dedup by an exact set-similarity join, in DataFrame operations only.

A line (text between line feeds) is the set of its distinct word 5-shingles,
lower-cased (a line of fewer words is one shingle).  A line is removed when an
earlier line - smaller document id, or the same document, further up - has a
Jaccard similarity of 0.8 or more with it; whether that earlier line stays
itself makes no difference.

1.  Rarity.  One aggregation counts the shingles in ``SKETCH`` counters; a
    shingle's sort key is its counter's magnitude, then its hash.
2.  Equal lines.  Lines of equal (lower-cased, trimmed) text become one class
    with its first place, in an aggregation with map-side combine, so a line
    that a third of all documents share is one row a task.
3.  Prefix filter.  Classes are dealt out by the rarest
    ``n - ceil(0.8 n) + 1`` shingles; what no other class shares is dropped.
4.  Pairs, under length, position and parity filters (128 bits a class bound the
    difference of two sets from below): first each class with the
    earliest of its group and with the most frequent one, then what is still
    unmatched with all earlier members.  In a family of thousands of near
    copies nearly all match in the first step, so pairs don't grow with the
    square of the family.
5.  Verification of exact shingle sets, rebuilt from the lines that are in any
    pair (a filter of 1 to 16 MB picks them in the scan).

Defined results: a null text stays null; blank lines always stay; a text
without line feeds is one line; rows of equal id and equal text are one
document (both keep the same lines), rows of equal id and different texts are
ordered by text hash; a null id sorts first; other columns are kept as they
are by ``clean_lines``, its two new columns are named by the caller; a very long line is
one line, read whole; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import Scratch, free_name, written
from ratewise.llm.native import as_literal, bit_filter, dense, held, in_filter, shingles, split_words, word_hashes

PERCENT = 80
SHINGLE = 5
SKETCH_BITS = 14
FILTER_BITS = 23
_NULL_ID = -(1 << 63)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, th, line_no, line, h) of every line that isn't blank."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc"), F.xxhash64(F.col(text_col)).alias("th"),
                       F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "raw"))
    line = F.btrim(F.lower("raw"), F.lit(" \t\n\x0b\x0c\r"))
    return rows.select("doc", "th", "line_no", line.alias("line")).where("line <> ''").withColumn("h", F.xxhash64("line"))


def _with_shingles(lines: DataFrame) -> DataFrame:
    """Adds s: the distinct shingle hashes of a line."""
    line = F.col("line")
    # most lines have no blank but spaces: split without a pattern
    words = F.when(line.rlike(r"[\x09-\x0D]"), split_words(line)).otherwise(F.filter(F.split(line, " "), lambda w: w != ""))
    rows = held(lines, "w", word_hashes(words))
    return held(rows.drop("line"), "s", F.array_distinct(shingles("w", None, SHINGLE))).drop("w")


def _needed(a: Column, b: Column) -> Column:
    """Smallest overlap at which sets of sizes a and b are similar."""
    return F.ceil(PERCENT * (a + b) / F.lit(100 + PERCENT))


def _parities(s: Column) -> list[Column]:
    """even, odd: 128 bits, each telling whether an odd number of the shingles has it.  Two lines'
    bits differ in no more places than their sets do."""
    def bits(half: int) -> Column:
        return F.aggregate(s, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(F.when(
            x.bitwiseAND(F.lit(64)) == half, F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))).otherwise(F.lit(0).cast("long"))))
    return [bits(0).alias("even"), bits(64).alias("odd")]


def _may_match(a: Column, b: Column) -> Column:
    """Length filter, position filter for a shared shingle, and parity filter (``_parities``) of two
    lines (n, pos, even, odd)."""
    n1, n2 = a["n"], b["n"]
    length = (100 * F.least(n1, n2) >= PERCENT * F.greatest(n1, n2))
    place = 1 + F.least(n1 - a["pos"], n2 - b["pos"]) >= _needed(n1, n2)
    differ = sum(F.bit_count(a[c].bitwiseXOR(b[c])) for c in ("even", "odd"))
    return length & place & (differ <= n1 + n2 - 2 * _needed(n1, n2))


def _filter_bits(n: int) -> int:
    """Size of a filter for ``n`` hashes: 16 bits for each, within 1 and 16 MB."""
    return min(max(FILTER_BITS, (16 * n).bit_length()), FILTER_BITS + 4)


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, th, gone): the line numbers to remove from each text (by id and text hash)."""
    with Scratch(docs.sparkSession, "line-dedup") as tmp:
        lines = _lines(docs.where(F.col(text_col).isNotNull()), id_col, text_col)
        return written(_removed(lines, tmp), "removed-lines")


def _removed(lines: DataFrame, tmp: Scratch) -> DataFrame:
    shift = 64 - SKETCH_BITS
    counts = (_with_shingles(lines).select(F.explode_outer("s").alias("x"))
              .groupBy(F.shiftrightunsigned("x", shift).alias("k")).agg(F.count("*").alias("c"))
              .select("k", F.floor(4 * F.log2(F.col("c") + 1.0)).alias("v")))
    sketch = as_literal(dense(counts, 1 << SKETCH_BITS))

    def key(x: Column) -> Column:
        """Rarity above the leading bits of the hash, in one long."""
        rank = F.get(sketch, F.shiftrightunsigned(x, shift).cast("int"))
        return F.shiftleft(rank, 55).bitwiseOR(F.shiftrightunsigned(x, 9))

    n = F.size("s")
    first = F.struct("doc", "th", "line_no")
    prefix = F.slice(F.sort_array(F.transform("s", key)), F.lit(1), n - F.ceil(n * PERCENT / F.lit(100)).cast("int") + 1)
    classes = tmp.keep(_with_shingles(lines).select("h", first.alias("at"), n.alias("n"), prefix.alias("prefix"), *_parities(F.col("s")))
                       .groupBy("h").agg(F.min(F.struct("at", "n", "prefix", "even", "odd")).alias("c"), F.count("*").alias("copies"))
                       .select("h", "c.*", "copies"), "classes")

    # narrow rows find the shingles that classes share; places are joined to what is left
    token = Window.partitionBy("t")
    tokens = classes.select("h", "n", F.posexplode_outer("prefix").alias("pos", "t")).select("t", "h", "n", (F.col("pos") + 1).alias("pos"))
    shared = tmp.keep(tokens.withColumn("members", F.count("*").over(token)).where("members > 1").drop("members"), "shared")
    member = F.struct("at", "h", "n", "pos", "even", "odd")
    groups = (shared.join(classes.select("h", "at", "copies", "even", "odd"), "h")
                    .withColumn("hub", F.min(member).over(token))
                    .withColumn("top", F.max(F.struct("copies", F.col("h").alias("by"), member.alias("m"))).over(token)["m"]))
    groups = tmp.keep(groups, "groups")
    tmp.drop(shared)

    def hub_pairs(hub: str) -> DataFrame:
        a = F.col(hub)
        row = F.struct(*(F.col(c) for c in ("n", "pos", "even", "odd")))
        return groups.where((a["at"] < F.col("at")) & _may_match(a, row)).select(a["h"].alias("a"), F.col("h").alias("b"))

    def with_earlier(late: DataFrame) -> DataFrame:
        """Pairs of the rows of ``late`` with all earlier members of their groups but the hub."""
        x = late.select("t", F.col("h").alias("b"), F.col("at").alias("at_b"), F.struct("n", "pos", "even", "odd").alias("y"), F.col("hub.h").alias("hub_h"))
        met = x.join(groups.select("t", F.col("h").alias("a"), "at", F.struct("n", "pos", "even", "odd").alias("x")), "t")
        return met.where((F.col("at") < F.col("at_b")) & (F.col("a") != F.col("hub_h")) & _may_match(F.col("x"), F.col("y"))).select("a", "b").distinct()

    def similar(pairs: DataFrame) -> DataFrame:
        """The later lines of the pairs that are similar, by exact shingle sets of the lines in them."""
        names = tmp.keep(pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct().join(classes.select("h", F.col("at").alias("own")), "h"), "names")
        bits = _filter_bits(names.count())
        picked = tmp.keep(bit_filter(names, "h", bits), "picked")
        found = (lines.where(in_filter(picked.scalar(), F.col("h"), bits)).withColumn("at", first)
                      .join(names, "h").where("at = own").dropDuplicates(["h"]).select("h", "line"))
        sets = tmp.keep(_with_shingles(found), "sets")
        tmp.drop(picked)
        both = (pairs.join(sets.select(F.col("h").alias("a"), F.col("s").alias("sa")), "a")
                     .join(sets.select(F.col("h").alias("b"), F.col("s").alias("sb")), "b"))
        common = F.size(F.array_intersect("sa", "sb"))
        near = both.where(common * (100 + PERCENT) >= PERCENT * (F.size("sa") + F.size("sb"))).select(F.col("b").alias("h")).distinct()
        near = tmp.keep(near, "near")
        tmp.drop(sets)
        return near

    members = groups.where(F.col("hub.h") != F.col("h"))
    hubs = tmp.keep(hub_pairs("hub").unionByName(hub_pairs("top")).distinct(), "hubs")
    without = members.join(hubs.select(F.col("b").alias("h")), "h", "left_anti")
    pairs = tmp.keep(hubs.unionByName(with_earlier(without)), "pairs")
    near = similar(pairs)
    # lines whose pairs with the hub weren't similar after all
    failed = hubs.select(F.col("b").alias("h")).distinct().join(near, "h", "left_anti")
    rest = tmp.keep(with_earlier(members.join(failed, "h", "left_semi")).join(pairs, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        near = near.unionByName(similar(rest)).distinct()
    near = near.withColumn("near", F.lit(True))

    decided = (classes.select("h", F.col("at").alias("own"), "copies").join(near, "h", "left")
                      .where(F.col("near") | (F.col("copies") > 1)))
    gone = (lines.select("h", first.alias("at")).join(decided, "h").where(F.col("near") | (F.col("at") != F.col("own")))
                 .select("at.*"))
    return gone.groupBy("doc", "th").agg(F.collect_set("line_no").alias("gone"))


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``docs`` with the remaining lines as text, and two new columns, by default n_lines and
    n_removed (0 for a null text), which replace columns of these names."""
    doc, th, gone = (free_name(docs, c) for c in ("doc", "th", "gone"))
    found = removed_lines(docs, id_col, text_col).select(F.col("doc").alias(doc), F.col("th").alias(th), F.col("gone").alias(gone))
    keyed = docs.withColumn(doc, F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID))).withColumn(th, F.xxhash64(F.col(text_col)))
    both = keyed.join(found, [doc, th], "left")
    all_ = F.split(F.col(text_col), "\n")
    keep = F.array_except(F.sequence(F.lit(0), F.size(all_) - 1), F.col(gone))
    left = F.array_join(F.transform(keep, lambda i: F.get(all_, i)), "\n")
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(left)
    rest = [text.alias(c) if c == text_col else F.col(c) for c in docs.columns if c not in names]
    return both.select(*rest, F.when(F.col(text_col).isNull(), 0).otherwise(F.size(all_)).cast("long").alias(names[0]),
                       F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias(names[1]))
