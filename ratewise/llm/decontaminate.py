"""Benchmark decontamination by exact window counts, in DataFrame operations only.

A document is contaminated by a benchmark item when one of its windows of the
item's number of words (the whole text, if that is shorter) has a weighted
shingle similarity of 0.8 or more with the item: sum of the smaller weights
over sum of the larger ones, where the shingles are five lower-cased words (all
words of a shorter window) and a shingle's weight is the number of times it
occurs.  An item of fewer than five words is too short to be looked for inside
longer texts; it matches a text of just these words.

1.  Hits.  Each document's shingles pass filters of fixed size with those of all
    items; documents without a hit go no further.  Hits are joined to the items
    that have the shingle, and all of a (document, item) pair meet in one task:
    no more rows than the document has words.
2.  Bound.  A window can't share more with the item than the whole document
    does; pairs that cannot reach 0.8 go.
3.  Intervals.  A shingle that the item has c times counts c times at most in a
    window, so its j-th place in the document counts in the windows that
    contain it and don't contain the (j - c)-th place: those that start within
    one interval.  The number of intervals over a start is the exact weighted
    overlap of its window, and one running sum over the ends of the intervals
    gives it for every start.  No window is left out, in whatever order its
    shingles are.

Defined results: null texts, texts and items without words match nothing;
items of equal text all match; ids of documents and items are kept as they
are, null or repeated (equal rows give equal results, one each); every window of a very long
text is counted; an empty table on either side gives no match; further columns of either table may have
any name (``clean_documents`` keeps those of the documents)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import Scratch, free_name, written
from ratewise.llm.native import as_literal, bit_filter, held, in_filter, shingles, split_words, word_hashes

PERCENT = 80
SHINGLE = 5
FILTER_BITS = 20


def _hashed(rows: DataFrame, text: Column) -> DataFrame:
    """Adds n (words) and s (shingle hashes by place); rows without words go."""
    plain = F.btrim(F.lower(text), F.lit(" \t\n\x0b\x0c\r"))
    rows = held(rows.where(text.isNotNull() & (plain != "")), "w", word_hashes(split_words(F.lower(text))))
    return held(rows.withColumn("n", F.size("w")), "s", shingles("w", "n", SHINGLE)).drop("w")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, th, item_id, start, n_words, similarity): each document (its id and text hash) and
    item that match, with the first of the most similar windows."""
    with Scratch(docs.sparkSession, "decontaminate") as tmp:
        return written(_matches(docs, items, id_col, text_col, item_id_col, item_text_col, tmp), "contaminated")


def _matches(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id_col: str, item_text_col: str, tmp: Scratch) -> DataFrame:
    things = _hashed(items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text")), F.col("text"))
    things = tmp.keep(things.withColumn("item", F.xxhash64("item_id", "text")).select("item", "item_id", "n", "s").dropDuplicates(["item"]), "items")
    parts = things.select("item", "n", F.posexplode_outer("s").alias("q", "x"))
    # two filters, by the leading and by later bits of a hash: few texts pass both by chance
    leading = as_literal(bit_filter(parts, "x", FILTER_BITS))
    later = as_literal(bit_filter(parts.select(F.shiftleft("x", 32).alias("x")), "x", FILTER_BITS))

    def picked(x: Column) -> Column:
        return in_filter(leading, x, FILTER_BITS) & in_filter(later, F.shiftleft(x, 32), FILTER_BITS)

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = _hashed(src, F.col("text")).select("doc_id", F.xxhash64("text").alias("th"), F.col("n").alias("words"), "s")
    places = F.transform("s", lambda x, p: F.struct(p.alias("p"), x.alias("x")))
    texts = held(texts, "hits", F.filter(places, lambda h: picked(h["x"]))).drop("s").where(F.size("hits") > 0)
    texts = tmp.keep(texts.withColumn("doc", F.xxhash64("doc_id", "th", "words")).dropDuplicates(["doc"]), "texts")
    own = tmp.keep(parts.groupBy("item", "n", "x").agg(F.count("*").alias("c")), "weights")

    # all that follows is grouped within (doc, item), by one exchange
    pair = ["doc", "item", "n", "words"]
    hits = (texts.select("doc", "words", F.explode("hits").alias("h")).select("doc", "words", "h.*")
                 .join(own, "x").repartition("doc", "item"))
    at = hits.groupBy(*pair, "x", "c").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    size = F.least("n", "words")
    width = F.greatest(size - SHINGLE + 1, F.lit(1))
    both_sizes = width + F.greatest(F.col("n") - SHINGLE + 1, F.lit(1))

    def enough(both: Column) -> Column:
        return (100 + PERCENT) * both >= PERCENT * both_sizes

    def interval(p: Column, j: Column) -> Column:
        before = F.coalesce(F.get("ps", j - F.col("c").cast("int")), F.lit(-1))
        return F.struct(F.greatest(p - width + 1, before + 1, F.lit(0)).alias("lo"), F.least(p, F.col("words") - size).alias("hi"))

    at = (at.groupBy(*pair).agg(F.sum(F.least(F.size("ps"), "c")).alias("most"), F.collect_list(F.transform("ps", interval)).alias("spans"))
            .where(enough(F.col("most"))).select(*pair, F.explode(F.flatten("spans")).alias("span")).where("span.lo <= span.hi"))
    ends = F.array(F.struct(F.col("span.lo").alias("start"), F.lit(1).alias("step")), F.struct((F.col("span.hi") + 1).alias("start"), F.lit(-1).alias("step")))
    steps = at.select(*pair, F.explode(ends).alias("e")).groupBy(*pair, F.col("e.start").alias("start")).agg(F.sum("e.step").alias("step"))
    both = F.sum("step").over(Window.partitionBy(*pair).orderBy("start"))
    best = (steps.withColumn("both", both).where(enough(F.col("both")))
                 .groupBy(*pair).agg(F.max(F.struct("both", (-F.col("start")).alias("back"))).alias("b")))
    found = best.select("doc", "item", (-F.col("b.back")).cast("long").alias("start"), size.cast("long").alias("n_words"),
                        (F.col("b.both") / (both_sizes - F.col("b.both"))).alias("similarity"))
    return (found.join(things.select("item", "item_id"), "item").join(texts.select("doc", "doc_id", "th"), "doc")
                 .select("doc_id", "th", "item_id", "start", "n_words", "similarity"))


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that match an item."""
    th, bad_id, bad_th = (free_name(docs, c) for c in ("th", "bad_id", "bad_th"))
    bad = contaminated(docs, items, id_col, text_col).select(F.col("doc_id").alias(bad_id), F.col("th").alias(bad_th)).distinct()
    keyed = docs.withColumn(th, F.xxhash64(F.col(text_col)))
    return keyed.join(bad, F.col(id_col).eqNullSafe(F.col(bad_id)) & (F.col(th) == F.col(bad_th)), "left_anti").drop(th)
