"""Derived input views built from the driver tables.

The reference's own inputs (item, rating, tag, comment, word-vector files)
are not shipped, so each one is derived from the driver tables by a fixed
rule.  Each view is a lazy DataFrame; its DuckDB twin lives in
``ratewise.plans.views`` and both define the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.columns import RATING_PREFIX, epoch_seconds, tokens
from ratewise.operators.ranking import global_row_number, spread
from ratewise.session import materialize, new_subdir
from ratewise.sources.tables import read_table
from ratewise.sources.text_files import text_folder, write_lines

# The category list used by the per-category top-k (stands in
# for the reference's fixed list of category names).
CATEGORIES = ["Economy", "Promo", "Large", "Medium", "Standard", "Small", "Ring", "Rod", "Bolt", "Blue"]

# Market segment -> preferred category of a user.
SEGMENT_PREF = {"BUILDING": "STANDARD", "FURNITURE": "LARGE", "HOUSEHOLD": "SMALL", "MACHINERY": "ECONOMY"}
SEGMENT_PREF_DEFAULT = "PROMO"

N_STOP_WORDS = 20


# Header lines of the quoted files.
QUOTED_HEADER = "mid,name,minutes,tag"
COMMENT_HEADER = "time,content,a,b,mid,c,d,e,uid,score,f,g,h,i"


def quoted_line(*fields):
    """Fields in double quotes, joined by commas (a null field makes no line)."""
    return F.concat_ws(",", *(F.concat(F.lit('"'), f, F.lit('"')) for f in fields))


def log_lines(events: DataFrame, n_items) -> DataFrame:
    """Log lines as the web tier writes them, row by row (on a table or a stream)."""
    n = F.lit(n_items) if isinstance(n_items, int) else n_items
    score = (F.floor("value").cast("long") % 10 + 1) / F.lit(2.0)
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("INFO page hit "), F.col("event_id").cast("string"))) \
        .otherwise(F.concat(F.lit("INFO "), F.lit(RATING_PREFIX), F.col("user_id").cast("int").cast("string"), F.lit("|"),
                            (F.col("event_id") % n).cast("int").cast("string"), F.lit("|"), score.cast("decimal(3,1)").cast("string"),
                            F.lit("|"), epoch_seconds("ts").cast("string"), F.lit(" ")))
    return events.select("event_id", line.alias("line"))


def with_broken_messages(lines: DataFrame) -> DataFrame:
    """Log lines of which every 9th lacks its last two fields and every 13th has no number for the item."""
    line = F.when(F.col("event_id") % 9 == 0, F.regexp_replace("line", r"\|[^|]*\|[^|]*$", "")) \
        .when(F.col("event_id") % 13 == 0, F.regexp_replace("line", r"\|", "|x")).otherwise(F.col("line"))
    return lines.select("event_id", line.alias("line"))


class Fixtures:
    """Lazily built views over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._memo: dict[str, DataFrame] = {}

    def shared(self, name: str, build) -> DataFrame:
        """A derived table several branches of one query read, computed once
        (checkpointed to the shared folder) per Fixtures instance."""
        if name not in self._memo:
            self._memo[name] = materialize(build())
        return self._memo[name]

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # -- helpers -----------------------------------------------------------
    def n_items(self):
        """``(SELECT count(*) FROM part)`` as a scalar subquery column."""
        return self.table("part").select(F.count(F.lit(1))).scalar()

    # -- views -------------------------------------------------------------
    def items(self) -> DataFrame:
        part = self.table("part")
        first_ship = (self.table("lineitem").groupBy("l_partkey")
                      .agg(F.min("l_shipdate").alias("issue")))
        return (part.join(first_ship, part.p_partkey == first_ship.l_partkey, "left")
                .select(F.col("p_partkey").cast("int").alias("mid"),
                        F.col("p_name").alias("name"),
                        F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("descri"),
                        F.col("issue"),
                        F.col("p_size").cast("int").alias("timelong"),
                        F.concat_ws("|", F.col("p_type"),
                                    F.split_part("p_name", F.lit(" "), F.lit(1)),
                                    F.split_part("p_name", F.lit(" "), F.lit(2))).alias("genres")))

    def ratings(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate", "l_linenumber")
        od = self.table("orders").select("o_orderkey", "o_custkey")
        return (li.join(od, li.l_orderkey == od.o_orderkey)
                .select(F.col("o_custkey").cast("int").alias("uid"),
                        F.col("l_partkey").cast("int").alias("mid"),
                        (F.col("l_quantity") / F.lit(10.0)).alias("score"),
                        epoch_seconds("l_shipdate").alias("ts"),
                        "l_orderkey", "l_linenumber"))

    def item_ratings(self) -> DataFrame:
        """Ratings without their users: no join with the orders (each line has one order)."""
        return self.table("lineitem").select(F.col("l_partkey").cast("int").alias("mid"), (F.col("l_quantity") / F.lit(10.0)).alias("score"),
                                             epoch_seconds("l_shipdate").alias("ts"))

    def rating_events(self) -> DataFrame:
        return self.rating_events_with()

    def rating_events_with(self, *columns: str) -> DataFrame:
        """The rating events, with further columns of the event table."""
        ev = self.table("events").select("event_id", "user_id", "value", "ts", *columns)
        return ev.select(
            "event_id",
            F.col("user_id").cast("int").alias("uid"),
            (F.col("event_id") % self.n_items()).cast("int").alias("mid"),
            ((F.floor("value").cast("long") % 10 + 1) / F.lit(2.0)).alias("score"),
            epoch_seconds("ts").alias("ts"), *columns)

    def rating_log(self) -> DataFrame:
        ev = self.table("events").select("event_id", "user_id", "event_type", "value", "ts")
        return log_lines(ev, self.n_items())

    def item_tags(self) -> DataFrame:
        ev = self.table("events").select("event_id", "user_id", "event_type", "ts")
        return ev.select(F.col("user_id").cast("int").alias("uid"),
                         (F.col("event_id") % self.n_items()).cast("int").alias("mid"),
                         F.col("event_type").alias("tag"),
                         epoch_seconds("ts").alias("ts"))

    def comments(self) -> DataFrame:
        cv = self.table("conversations")
        return (cv.select(F.col("conv_id").cast("int").alias("uid"),
                        ((F.col("conv_id") * 7 + F.col("turn")) % self.n_items()).cast("int").alias("mid"),
                        F.col("text").alias("content")))

    def docs(self) -> DataFrame:
        return self.table("documents").select(F.col("doc_id").cast("int").alias("mid"),
                                              F.col("source").alias("name"),
                                              F.col("text").alias("descri"))

    def users(self) -> DataFrame:
        seg = F.col("c_mktsegment")
        pref = F.lit(SEGMENT_PREF_DEFAULT)
        for k, v in reversed(list(SEGMENT_PREF.items())):
            pref = F.when(seg == k, F.lit(v)).otherwise(pref)
        return self.table("customer").select(F.col("c_custkey").cast("int").alias("uid"),
                                             F.col("c_name").alias("username"),
                                             pref.alias("pref_genre"))

    def categories(self) -> DataFrame:
        return self.spark.createDataFrame([(c,) for c in CATEGORIES], "category string")

    def word_df(self) -> DataFrame:
        """Document frequency of every token over comments and docs (whole
        texts), computed once per run: stop words and vocabulary read it."""
        return self.shared("word_df", self._word_df)

    def _word_df(self) -> DataFrame:
        c = self.comments().select(F.concat(F.lit("c"), F.col("uid").cast("string"), F.lit("-"), F.col("mid").cast("string")).alias("k"),
                                   F.col("content").alias("t"))
        d = self.docs().select(F.concat(F.lit("d"), F.col("mid").cast("string")).alias("k"), F.col("descri").alias("t"))
        # texts are exchanged by key, so the distinct (k, w) are found where
        # they are made: no exploded token is shuffled
        own = spread(c.unionByName(d), "k")
        return (own.select("k", F.explode(F.array_distinct(tokens("t"))).alias("w")).distinct()
                   .groupBy("w").agg(F.count(F.lit(1)).alias("df")))

    def word_freq(self) -> DataFrame:
        ranked = global_row_number(self.word_df(), [F.col("df").desc(), F.col("w").asc()], name="rn")
        return ranked.select(F.col("w").alias("word"), (F.col("rn") - 1).alias("rk"))

    def stop_words(self) -> DataFrame:
        # top-N by document frequency: TakeOrderedAndProject, N rows.
        return self.shared("stop_words", lambda: (
            self.word_df().orderBy(F.col("df").desc(), F.col("w").asc())
            .limit(N_STOP_WORDS).select(F.col("w").alias("word"))))

    def word_vectors(self) -> DataFrame:
        def build():
            emb = self.table("embeddings").select("vec_id", "embedding")
            return (self.word_freq().join(emb, F.col("rk") == F.col("vec_id"))
                    .select("word", F.col("embedding").alias("vec")))
        return self.shared("word_vectors", build)

    # -- text files for the scans: written to the shared folder once per run ----
    def _folder(self, name: str, build) -> str:
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    def rating_files(self) -> str:
        """``uid,mid,score,ts`` lines; error events are lines with a user that is no number."""
        def build() -> str:
            good = self.ratings().select("uid", "mid", "score", "ts")
            bad = self.rating_events_with("event_type").where("event_type = 'error'").select(F.concat(F.lit("u"), F.col("uid").cast("string")).alias("uid"), "mid", "score", "ts")
            return text_folder(self.spark, "rating-files", (good, True), (bad, True))
        return self._folder("rating_files", build)

    def tag_files(self) -> str:
        """``uid,mid,tag,ts`` lines with blanks around the tag; every 11th event lacks the time."""
        def build() -> str:
            row = self.table("events").select("event_id", F.col("user_id").cast("int").alias("uid"), (F.col("event_id") % self.n_items()).cast("int").alias("mid"),
                           F.concat(F.lit(" "), "event_type", F.lit(" ")).alias("tag"), epoch_seconds("ts").alias("ts"))
            good = row.where("event_id % 11 <> 0").select("uid", "mid", "tag", "ts")
            return text_folder(self.spark, "tag-files", (good, True), (row.where("event_id % 11 = 0").select("uid", "mid", "tag"), True))
        return self._folder("tag_files", build)

    def item_files(self) -> str:
        """``^``-separated item lines without a header, blanks around the name; items whose id
        ends in 7 have a cut-off line."""
        def build() -> str:
            it = self.items()
            cols = [F.col("mid").cast("string").alias("mid"), F.concat(F.lit(" "), "name", F.lit(" ")).alias("name"), "descri",
                    (F.col("timelong") % 10).cast("string").alias("timelong"), F.col("issue").cast("string").alias("issue"),
                    F.lit("x").alias("shoot"), F.lit("en").alias("language"), "genres", F.lit("a").alias("actors"), F.lit("d").alias("directors")]
            whole = it.where("mid % 10 <> 7").select(*cols)
            return text_folder(self.spark, "item-files", (whole, False), (it.where("mid % 10 = 7").select(*cols[:4]), False), sep="^")
        return self._folder("item_files", build)

    def quoted_item_files(self) -> str:
        """``"mid","name, descri","minutes.0",""`` lines, each file with a header line."""
        def build() -> str:
            path = new_subdir(self.spark, "quoted-files")
            write_lines(self.items().select(quoted_line(F.col("mid").cast("string"), F.concat("name", F.lit(", "), "descri"),
                                                        F.concat((F.col("timelong") % 10).cast("string"), F.lit(".0")), F.lit("")).alias("line")),
                        path, QUOTED_HEADER)
            return path
        return self._folder("quoted_item_files", build)

    def comment_files(self) -> str:
        """Lines of 14 quoted fields, each file with a header line; those of every 5th user have one field more."""
        def build() -> str:
            path = new_subdir(self.spark, "comment-files")
            e, k = F.lit(""), F.col("uid") + F.col("mid")
            uid, mid = F.col("uid").cast("string"), F.col("mid").cast("string")
            score = F.when(k % 6 == 0, e).otherwise((k % 5 + 1).cast("string"))
            line = quoted_line(F.concat(uid, F.lit("-"), mid), F.regexp_replace("content", "[\\r\\n]+", " "), e, e, mid, e, e, e, uid, score, e, e, e, e)
            longer = F.when(F.col("uid") % 5 == 0, F.concat(line, F.lit(',""'))).otherwise(line)
            write_lines(self.comments().select(longer.alias("line")), path, COMMENT_HEADER)
            return path
        return self._folder("comment_files", build)

    def word_vector_files(self) -> str:
        """``word f1 .. fn`` lines; words of every 10th rank have no number in their last field."""
        def build() -> str:
            path = new_subdir(self.spark, "vector-files")
            wv = self.word_freq().join(self.word_vectors(), "word")
            v = F.array_join(F.transform("vec", lambda x: x.cast("string")), " ")
            line = F.concat("word", F.lit(" "), F.when(F.col("rk") % 10 == 0, F.concat(v, F.lit("?"))).otherwise(v))
            write_lines(wv.select(line.alias("line")), path)
            return path
        return self._folder("word_vector_files", build)
