"""Document fingerprints with Order MinHash, in DataFrame operations only.

The k-mers of a text are its runs of ``K`` words (one run of all words if there
are fewer).  Each k-mer is numbered by its occurrences, so the second "of the"
of a text is another item than the first.  One hash puts every item into one
of ``TUPLES`` parts and, there, into one of two strata; the smallest item of
each stratum is selected, the two keep their order in the text, and the hash of
the ordered pair is the part's value.  Two texts agree in a part only if they
select the same items in the same order, so moving text changes the
fingerprint as well as replacing it.  Likeness is the share of equal values
among the parts that are filled in either text.

All items of a text stay in one partition from the first exchange on: texts are
dealt out by ranges of descending document id (quantiles of the ids), which
also makes a document's neighbour the next row of a sorted range; a range's
last neighbour is a copy of the next range's first row.  Ranges are streamed
in order, never held.

Defined results: a null text counts as empty; a text without words has the
fingerprint of empty parts only, which is like another such text (1.0) and
unlike any other (0.0); a single document is its own neighbour; rows of equal
id are ordered by text hash, rows without an id come last; a very long text is read whole, its places
count modulo 2^24 words (a longer text's order is seen within such stretches); of a text of fewer
than some hundred words, parts with one stratum filled hold no order; an empty table gives an empty result;
further columns may have any name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.native import held, split_words

K = 2
TUPLES = 32
RANGE_BYTES = 8 << 20
MOST_RANGES = 4096
_EMPTY = "........"
_LAST = (1 << 63) - 1


def _kmers(words: str, n: str) -> Column:
    places = F.sequence(F.lit(0), F.greatest(F.col(n) - K, F.lit(0)))
    # hash in the upper 40 bits, place (modulo 2 ** 24) below: sorted, equal k-mers are neighbours in text order
    longs = F.transform(places, lambda i: F.shiftleft(F.shiftrightunsigned(F.xxhash64(*(F.get(words, i + j) for j in range(K))), 24), 24)
                        .bitwiseOR(i.cast("long").bitwiseAND(F.lit((1 << 24) - 1).cast("long"))))
    return F.sort_array(longs)


def _half(text: Column, after: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by the first ones of the next text."""
    n = F.length(text)
    cut = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(after, F.lit(1), cut))


def fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, parts): the array of part values (null for an empty part) of each row's text.

    ``keys`` must name one row each and begin with the column by which the
    rows are already partitioned, if they are: then nothing is shuffled."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    rows = held(texts.select(*keys, t.alias("t")), "w", split_words(F.col("t")))
    rows = rows.select(*keys, "w", F.when(F.size("w") > 1, F.size("w")).when(F.get("w", F.lit(0)) == "", 0).otherwise(1).alias("n"))
    items = (rows.select(*keys, F.explode_outer(F.when(F.col("n") > 0, _kmers("w", "n"))).alias("x")))
    kmer = F.shiftright("x", 24)
    run = Window.partitionBy(*keys, "kmer").orderBy("x")
    hashed = (items.select(*keys, "x", kmer.alias("kmer")).withColumn("occurrence", F.row_number().over(run))
                   .select(*keys, "x", F.xxhash64("kmer", "occurrence").alias("h")))
    part = F.when(F.col("x").isNotNull(), F.pmod("h", F.lit(TUPLES)).cast("int"))
    # hash above the place: the smallest of a stratum comes with its place
    value = (F.shiftleft(F.shiftrightunsigned("h", 24), 24)
             .bitwiseOR(F.col("x").bitwiseAND(F.lit((1 << 24) - 1).cast("long"))))
    stratum = F.pmod(F.shiftright("h", 8), F.lit(2))
    best = (hashed.select(*keys, part.alias("part"), stratum.alias("stratum"), value.alias("v"))
                  .groupBy(*keys, "part").agg(F.min(F.when(F.col("stratum") == 0, F.col("v"))).alias("a"),
                                              F.min(F.when(F.col("stratum") == 1, F.col("v"))).alias("b")))
    place = lambda c: F.col(c).bitwiseAND(F.lit((1 << 24) - 1).cast("long"))
    item = lambda c: F.shiftright(c, 24)
    ordered = F.when(place("a") <= place("b"), F.xxhash64(item("a"), item("b"))).otherwise(F.xxhash64(item("b"), item("a")))
    pair = F.lower(F.lpad(F.hex(F.shiftrightunsigned(ordered, 32)), 8, "0"))
    found = best.select(*keys, "part", F.when(F.col("part").isNotNull(), pair).alias("value"))
    lists = found.groupBy(*keys).agg(F.collect_list(F.when(F.col("part").isNotNull(), F.struct("part", "value"))).alias("got"))
    lists = lists.withColumn("m", F.map_from_entries("got"))
    return lists.select(*keys, F.transform(F.sequence(F.lit(0), F.lit(TUPLES - 1)), lambda j: F.element_at(F.col("m"), j)).alias("parts"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal values among the parts filled in a or b; 1 if there is none."""
    both = F.zip_with(a, b, lambda x, y: F.struct((x.isNotNull() | y.isNotNull()).alias("filled"), F.coalesce(x == y, F.lit(False)).alias("same")))
    filled = F.size(F.filter(both, lambda z: z["filled"]))
    same = F.size(F.filter(both, lambda z: z["same"]))
    return F.when(filled == 0, 1.0).otherwise(same / filled)


def as_text(parts: Column) -> Column:
    return F.array_join(parts, "", _EMPTY)


def _ranges(rows: DataFrame, spark) -> tuple[list[int], int]:
    """Quantiles of the order column: one range for RANGE_BYTES of text, MOST_RANGES at most."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, min(MOST_RANGES, size // RANGE_BYTES + 1))
    if n == 1:
        return [], 1
    cuts = rows.agg(F.percentile_approx("ord", [i / n for i in range(1, n)], 20 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    return cuts, len(cuts) + 1


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) of every row of ``docs``; the next document is the one with the
    next smaller id (after the last: the first)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    order = F.coalesce(F.lit(0).cast("long") - F.col(id_col).cast("long"), F.lit(_LAST).cast("long"))
    rows = docs.select(F.col(id_col).alias("doc_id"), order.alias("ord"), F.xxhash64(text).alias("th"), text.alias("text"))
    cuts, ranges = _ranges(rows, spark)
    parts = max(ranges, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if cuts:
        limits = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
        at = F.size(F.filter(limits, lambda c: c < F.col("ord")))
    else:
        at = F.lit(0)
    rows = rows.withColumn("range", at)

    # each range gets a copy of the next range's first row, the last one that of the first
    firsts = rows.groupBy("range").agg(F.min(F.struct("ord", "th")).alias("f"))
    by = Window.orderBy("range")  # one row a range, MOST_RANGES at most
    before = firsts.select("f.*", F.coalesce(F.lag("range").over(by), F.max("range").over(Window.partitionBy())).alias("to"))
    ghosts = (rows.drop("range").join(F.broadcast(before), ["ord", "th"]).dropDuplicates(["to"])
                  .select("doc_id", "ord", "th", "text", F.col("to").alias("range"), F.lit(1).alias("ghost")))
    dealt = (rows.select("doc_id", "ord", "th", "text", "range", F.lit(0).alias("ghost")).unionByName(ghosts)
                 .repartition(parts, "range"))
    line = Window.partitionBy("range").orderBy("ghost", "ord", "th")
    near = dealt.select("*", F.row_number().over(line).alias("row"), F.lead("text").over(line).alias("after"))
    near = held(near, "edited", F.when(F.col("ghost") == 0, _half(F.col("text"), F.col("after"))))

    # three rows a document: its text, its edited text, and what else is to be told of it
    string, long = F.lit(None).cast("string"), F.lit(None).cast("long")
    def entry(which: int, text: Column, n_chars: Column = long, sha: Column = string) -> Column:
        return F.struct(F.lit(which).alias("which"), text.alias("text"), n_chars.alias("n_chars"), sha.alias("edited_sha256"))

    entries = F.array(entry(0, F.col("text")), entry(1, F.col("edited")),
                      entry(2, string, F.length("text").cast("long"), F.sha2(F.col("edited").cast("binary"), 256)))
    own = near.select("range", "row", "doc_id", "ghost", F.explode(entries).alias("e")).where("ghost = 0 or e.which = 0")
    prints = fingerprints(own.select("range", "row", "doc_id", "e.*"), ["range", "row", "doc_id", "which", "n_chars", "edited_sha256"])
    both = prints.groupBy("range", "row", "doc_id").agg(
        F.max(F.when(F.col("which") == 0, F.col("parts"))).alias("parts"), F.max(F.when(F.col("which") == 1, F.col("parts"))).alias("edited_parts"),
        F.max("n_chars").alias("n_chars"), F.max("edited_sha256").alias("edited_sha256"))
    both = both.withColumn("next_parts", F.lead("parts").over(Window.partitionBy("range").orderBy("row")))
    return (both.where(F.col("edited_sha256").isNotNull())
                 .select("doc_id", "n_chars", "edited_sha256", as_text(F.col("parts")).alias("fingerprint"),
                         as_text(F.col("edited_parts")).alias("edited_fingerprint"),
                         likeness(F.col("parts"), F.col("edited_parts")).alias("near_edited"),
                         likeness(F.col("parts"), F.col("next_parts")).alias("near_next")))
