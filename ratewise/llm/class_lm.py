"""Language-model scores with Brown class-based n-grams.

P(word i | word i-1) = P(class of i | class of i-1) * P(word i | its class).

Vocabulary.  Words go by 64-bit hashes, made for all words of a group of texts at once.
Every distinct word of all training documents is counted in one aggregation (counts are
summed in each task first).
Classes.  Words that make up at least 1 / ``CLUSTERED`` of the training tokens -
at most ``CLUSTERED`` words, at any size of the corpus - are put into
``CLASSES`` classes by exchange clustering: from classes by frequency rank, each
word in turn moves to the class that raises the likelihood of the training
bigrams most.  Bigrams of symbols (such a word, ending, end) are counted over
all training documents in one scan; the rounds of the exchange work on that
table, and only a words-by-classes matrix of bounded size reaches the driver.
Every other word that occurs ``SEEN`` times or more in training - a set that
grows with the corpus - starts in the class of its ending and moves to the class
that fits its neighbours best, of all those of the exchange and of the endings as
they then are: an occurrence between classes l and r adds the first-order gain of the
bigram likelihood, log P(r | class) + log P(l before class), and the gains of
all its occurrences are summed in an exchange by word.  Only words that occur
less often, also unknown ones, stay in one of ``ENDINGS`` classes by their last
two bytes; the end of a text is a class of its own.
Scores.  One scan turns every text into its class sequence, a byte a token.
Counts and classes of words that make up 1 / ``KNOWN`` of the tokens are at hand
there (at most ``KNOWN`` words); the others are joined by word and filled in by
place.  Class bigrams are counted over the sequences of the training texts, and
the scores are read off the sequences.

Probabilities are smoothed: transitions by ``ALPHA`` for each class, words by
``DELTA`` for each word of the class and one unknown word.

The base score is that of a unigram model: sum over tokens of
``log10((c + 0.1) / (N + 0.1 * (V + 1)))``.

Defined results: a null text is empty and has one token, its end; an empty
training set gives all words the count 0; rows are kept one to one with null or
equal ids; a very long text is scored whole; an empty table gives an empty result; further
columns may have any name."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import Scratch, fold, hashed_words_and_ends, kernel, text_groups, written

CLUSTERED = 1 << 13
SEEN = 5
KNOWN = 1 << 17
CLASSES = 64
ENDINGS = 32
ROUNDS = 6
ALPHA = 0.1
DELTA = 0.1
GROUP_BYTES = 3 << 20
_OPEN = 255  # class of a word that isn't at hand


#: Class of each ending: of the last two bytes as ``hashed_words_and_ends`` gives them.
_ENDING = np.array([zlib.crc32(bytes([i] if i < 256 else [(i >> 8) - 1, i & 255])) % ENDINGS for i in range(257 << 8)], np.int64)


def _find(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The place of each hash in a sorted table, -1 where it isn't in it."""
    if not len(table):
        return np.full(len(hashes), -1)
    kinds, back = np.unique(hashes, return_inverse=True)
    at = np.minimum(np.searchsorted(table, kinds), len(table) - 1)
    return np.where(table[at] == kinds, at, -1)[back]


class _Tokens:
    """All words of a group of texts, as hashes with their endings."""

    def __init__(self, texts: list[str | None]):
        h, self.counts, last = hashed_words_and_ends(texts, lower=True)
        self.h, self.ending = h.view(np.int64), _ENDING[last]


@dataclass
class _Symbols:
    """Clustered words are 0 .. size - 1, then the endings, then the end."""
    hashes: np.ndarray   # of the clustered words, sorted
    number: np.ndarray   # their symbols

    @property
    def size(self) -> int:
        return len(self.hashes)

    @property
    def end(self) -> int:
        return self.size + ENDINGS

    def text_symbols(self, words: _Tokens) -> np.ndarray:
        """Symbols of all texts, each with its end."""
        at = _find(self.hashes, words.h)
        got = np.where(at < 0, self.size + words.ending, self.number[at] if self.size else 0)
        return np.insert(got, np.cumsum(words.counts), self.end)


def _summed(keys: np.ndarray, counts: np.ndarray, more: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two (distinct key, count) lists as one."""
    keys, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([counts, n]), len(keys)).astype(np.int64)


def _before(symbols: np.ndarray, end: int) -> np.ndarray:
    """The symbol before each one; a text begins after an end."""
    return np.concatenate([[end], symbols[:-1]])


def exchange(rounds: int, classes: int, words: int, endings: int, contexts) -> tuple[np.ndarray, np.ndarray]:
    """Exchange clustering: class of each symbol, and the class bigram counts.

    ``contexts(class_of)`` gives the counts of each symbol with the classes of
    its left and of its right neighbours, two (symbols, classes) matrices."""
    total = classes + endings + 1
    class_of = np.concatenate([np.arange(words) % classes, np.arange(classes, total)])
    f = lambda x: x * np.log(np.maximum(x, 1.0))
    best = (-np.inf, class_of, np.zeros((total, total)))
    for step in range(rounds + 1):
        left, right = contexts(class_of)
        pairs = np.zeros((total, total))
        np.add.at(pairs, class_of, right)
        likelihood = f(pairs).sum() - f(pairs.sum(axis=1)).sum() - f(pairs.sum(axis=0)).sum()
        if likelihood <= best[0]:
            break
        best = (likelihood, class_of, pairs.copy())
        if step == rounds:
            break
        class_of = class_of.copy()
        row, col = pairs.sum(axis=1), pairs.sum(axis=0)
        k = slice(0, classes)
        for w in range(words):
            n, now = right[w].sum(), class_of[w]
            if n == 0:
                continue
            pairs[now] -= right[w]
            pairs[:, now] -= left[w]
            np.maximum(pairs, 0, out=pairs)
            row[now] -= n
            col[now] -= left[w].sum()
            out, into = pairs[k], pairs[:, k].T
            gain = (f(out + right[w]) - f(out)).sum(axis=1) + (f(into + left[w]) - f(into)).sum(axis=1)
            gain -= f(row[k] + n) - f(row[k]) + f(col[k] + left[w].sum()) - f(col[k])
            to = int(gain.argmax())
            to = now if gain[now] >= gain[to] - 1e-9 else to
            class_of[w] = to
            pairs[to] += right[w]
            pairs[:, to] += left[w]
            row[to] += n
            col[to] += left[w].sum()
    return best[1], best[2]


def merits(pairs: np.ndarray, classes: int) -> np.ndarray | None:
    """(left class * classes in all + right class, class) table of what a word's
    occurrence between two classes adds to the log likelihood in each of the first
    ``classes`` classes, in millionths (whole numbers: sums don't depend on their
    order); None if these classes have no words."""
    total = len(pairs)
    n_out, n_in = pairs.sum(axis=1), pairs.sum(axis=0)
    used = n_in[:classes] > 0
    if not used.any():
        return None
    after = np.log((pairs[:classes] + ALPHA) / (n_out[:classes, None] + ALPHA * total))
    before = np.log((pairs[:, :classes] + ALPHA) / (n_in[:classes] + ALPHA * total))
    gain = np.rint(1e6 * (before[:, None, :] + after.T[None, :, :])).astype(np.int64)
    gain[:, :, ~used] = -(1 << 40)
    return gain.reshape(total * total, classes)


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                    rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of
    every row of ``docs``; the model learns from the rows that aren't held out."""
    with Scratch(kernel(docs), "lm") as tmp:
        return written(_scored(docs, held_out, id_col, text_col, rounds, tmp), "lm-scores")


def _fewer_tasks(df: DataFrame) -> DataFrame:
    """A task for every three: what a task sums over more text is fewer rows to exchange."""
    return df.coalesce(max(1, df.rdd.getNumPartitions() // 3))


def _scored(docs: DataFrame, held_out: Column, id_col: str, text_col: str, rounds: int, tmp: Scratch) -> DataFrame:
    spark = docs.sparkSession
    context = spark.sparkContext
    src = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    train = src.where("not held_out").select("text")

    def summing(of, most: int = 2_000_000):
        """A function of batches: the counts of the keys that ``of`` gives for a group of texts."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            none = np.empty(0, np.int64)
            keys, counts = none, none
            for b in text_groups(batches, "text", GROUP_BYTES):
                keys, counts = _summed(keys, counts, *np.unique(of(b.column("text").to_pylist()), return_counts=True))
                if len(keys) > most:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["k", "n"])
                    keys, counts = none, none
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["k", "n"])
        return run

    counted = _fewer_tasks(train).mapInArrow(summing(lambda texts: _Tokens(texts).h), "k long, n long")
    vocabulary = tmp.keep(counted.groupBy("k").agg(F.sum("n").alias("c")), "vocabulary")
    ends = train.count()
    n_words, kinds = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_train, n_kinds = n_words + ends, kinds + (ends > 0)
    top = vocabulary.where(F.col("c") * KNOWN >= n_train).orderBy(F.desc("c"), "k").limit(KNOWN).collect()
    tmp.drop(vocabulary)
    top = [(r["k"], r["c"]) for r in top if r["c"] * CLUSTERED >= n_train]
    clustered = np.array([k for k, _ in top], np.int64)
    by_hash = np.argsort(clustered)
    symbols = _Symbols(clustered[by_hash], by_hash)
    size = symbols.size
    n_symbols, n_classes = size + ENDINGS + 1, CLASSES + ENDINGS + 1
    shared = context.broadcast(symbols)

    def bigrams(texts: list[str | None]) -> np.ndarray:
        sym = shared.value
        s = sym.text_symbols(_Tokens(texts))
        return _before(s, sym.end) * n_symbols + s

    summed = _fewer_tasks(train).mapInArrow(summing(bigrams, 3_000_000), "k long, n long")
    pairs = tmp.keep(summed.groupBy(F.col("k").alias("pair")).agg(F.sum("n").alias("n")), "bigrams")

    def contexts(class_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                a, z = np.divmod(b.column("pair").to_numpy(), n_symbols)
                n = b.column("n").to_numpy()
                cell = np.concatenate([z * n_classes + class_of[a], (n_symbols + a) * n_classes + class_of[z]])
                u, at = np.unique(cell, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(np.bincount(at, np.concatenate([n, n])).astype(np.int64))], ["cell", "n"])
        got = pairs.mapInArrow(add, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        flat = np.zeros(2 * n_symbols * n_classes)
        flat[got.column("cell").to_numpy()] = got.column("n").to_numpy()
        return tuple(flat.reshape(2, n_symbols, n_classes))

    class_of, core_pairs = exchange(rounds, CLASSES, size, ENDINGS, contexts)
    tmp.drop(pairs)
    placed = context.broadcast((class_of, merits(core_pairs, CLASSES + ENDINGS)))

    cells = n_classes * n_classes

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each word outside the exchange: its hash, and its ending with the classes around
        it as one number; equal rows of a group of texts are one."""
        sym, class_of = shared.value, placed.value[0]
        for b in text_groups(batches, "text", GROUP_BYTES):
            words = _Tokens(b.column("text").to_pylist())
            s = sym.text_symbols(words)
            c = class_of[s]
            at = np.flatnonzero(s != sym.end)
            other = np.flatnonzero(s[at] >= sym.size)
            at = at[other]
            h, cell = words.h[other], words.ending[other] * cells + c[at - 1] * n_classes + c[at + 1]
            order = np.lexsort((cell, h))
            h, cell = h[order], cell[order]
            first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (cell[1:] != cell[:-1])])) if len(h) else order
            yield pa.RecordBatch.from_arrays([pa.array(h[first]), pa.array(cell[first].astype(np.int32)),
                                              pa.array(np.diff(np.append(first, len(h))).astype(np.int32))], ["word", "cell", "n"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Count and class of each word of rows sorted by word; the last word of a batch may go on in the next."""
        gain = placed.value[1]

        def out(words: np.ndarray, n: np.ndarray, ending: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            to = np.where(n < SEEN, CLASSES + ending, sums.argmax(axis=1)) if gain is not None else CLASSES + ending
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(n), pa.array(to.astype(np.int32))], ["word", "c", "class"])
        rest: tuple | None = None
        for b in batches:
            if not b.num_rows:
                continue
            word = b.column("word").to_numpy()
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            words, n = word[first], b.column("n").to_numpy().astype(np.int64)
            ending, cell = np.divmod(b.column("cell").to_numpy().astype(np.int64), cells)
            ending = ending[first]
            sums = np.zeros((len(first), CLASSES + ENDINGS), np.int64)
            if gain is not None:
                sums = np.add.reduceat(gain[cell] * n[:, None], first)
            n = np.add.reduceat(n, first)
            if rest is not None and rest[0][0] == words[0]:
                n[0] += rest[1][0]
                sums[0] += rest[3][0]
            elif rest is not None:
                yield out(*rest)
            if len(words) > 1:
                yield out(words[:-1], n[:-1], ending[:-1], sums[:-1])
            rest = (words[-1:], n[-1:], ending[-1:], sums[-1:])
        if rest is not None:
            yield out(*rest)

    # no word outside the exchange makes up more than 1 / CLUSTERED of the rows
    around = train.mapInArrow(occurrences, "word long, cell int, n int").repartition("word").sortWithinPartitions("word")
    others = tmp.keep(around.mapInArrow(assign, "word long, c long, class int"), "classes")
    members = np.bincount(class_of[:size], minlength=n_classes).astype(float)  # distinct words of each class
    for r in others.groupBy("class").count().collect():
        members[r["class"]] += r["count"]
    near = others.where(F.col("c") * KNOWN >= n_train).collect()
    hashes = np.array([k for k, _ in top] + [r["word"] for r in near], np.int64)
    order = np.argsort(hashes)
    # the last entry is for words that aren't at hand
    index = hashes[order]
    count_of = np.append(np.array([c for _, c in top] + [r["c"] for r in near], float)[order], 0.0)
    place_of = np.append(np.array(class_of[:size].tolist() + [r["class"] for r in near], np.uint8)[order], np.uint8(_OPEN))
    model = context.broadcast((index, count_of, place_of))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text (word null) and for each of its words that isn't at hand."""
        index, count_of, place_of = model.value
        row = TaskContext.get().partitionId() << 40
        names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "own", "classes", "word", "place"]
        for b in text_groups(batches, "text", GROUP_BYTES):
            words = _Tokens(b.column("text").to_pylist())
            lengths = words.counts + 1
            last = np.cumsum(lengths)
            first = last - lengths
            at = _find(index, words.h)
            cut = np.cumsum(words.counts)
            n = np.insert(count_of[at], cut, float(ends))
            c = np.insert(place_of[at], cut, n_classes - 1)
            own = np.where(c != _OPEN, np.log10(n + 0.1), 0.0)  # DELTA and the base's 0.1 are one number
            k = b.num_rows
            rows = row + np.arange(k)
            row += k
            line = c.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), b.column("doc_id"), b.column("held_out"), pa.array(lengths), pa.array(np.add.reduceat((n > 0).astype(np.int64), first)),
                 pa.array(np.add.reduceat(own, first)), pa.array([line[i:j] for i, j in zip(first.tolist(), last.tolist())], pa.binary()),
                 pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names)
            open_, away = np.flatnonzero(c == _OPEN), np.flatnonzero(at < 0)
            owner = np.searchsorted(last, open_, side="right")
            k = len(open_)
            # the place, and the class that the word's ending gives it if it has no other
            place = ((open_ - first[owner]) << 8) | (CLASSES + words.ending[away])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[owner], pa.int64()), pa.nulls(k, b.column("doc_id").type), pa.nulls(k, pa.bool_()), pa.nulls(k, pa.int64()),
                 pa.nulls(k, pa.int64()), pa.nulls(k, pa.float64()), pa.nulls(k, pa.binary()), pa.array(words.h[away]), pa.array(place)], names)

    kind = src.schema["doc_id"].dataType.simpleString()
    scanned = tmp.keep(src.mapInArrow(scan, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, own double, "
                                           "classes binary, word long, place long"), "scan")
    filled = F.when(F.col("class").isNull(), F.col("place")).otherwise(F.shiftleft(F.shiftright("place", 8), 8).bitwiseOR(F.col("class").cast("long")))
    rare = (scanned.where("word is not null").select("row", "word", "place")
                   .join(others.where(~(F.col("c") * KNOWN >= n_train)), "word", "left")
                   .select("row", "c", filled.alias("filled"))
                   .groupBy("row").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("more_own"),
                                       F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("more"), F.collect_list("filled").alias("filled")))
    joined = (scanned.where("word is null").drop("word", "place").join(rare, "row", "left")
                     .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
                             (F.col("own") + F.coalesce("more_own", F.lit(0.0))).alias("own"), "classes", "filled"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            full = []
            for line, filled in zip(b.column("classes").to_pylist(), b.column("filled")):
                if filled.is_valid:
                    line, got = np.frombuffer(line, np.uint8).copy(), filled.values.to_numpy()
                    line[got >> 8] = got & 255
                    line = line.tobytes()
                full.append(line)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(full, pa.binary())], [*b.schema.names[:5], "classes"])

    lines = tmp.keep(joined.mapInArrow(fill, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, own double, classes binary"), "lines")
    tmp.drop(scanned)
    tmp.drop(others)

    def class_bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_classes * n_classes, np.int64)
        for b in batches:
            c = np.frombuffer(b"".join(b.column("classes").to_pylist()), np.uint8).astype(np.int64)
            held += np.bincount(_before(c, n_classes - 1) * n_classes + c, minlength=len(held)) if len(c) else 0
        cell = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(held[cell])], ["cell", "n"])

    class_pairs = np.zeros(n_classes * n_classes)
    for r in (lines.where("not held_out").select("classes").mapInArrow(class_bigrams, "cell long, n long")
                   .groupBy("cell").agg(F.sum("n").alias("n")).collect()):
        class_pairs[r["cell"]] = r["n"]
    class_pairs = class_pairs.reshape(n_classes, n_classes)
    transition = np.log10((class_pairs + ALPHA) / (class_pairs.sum(axis=1, keepdims=True) + ALPHA * n_classes))
    floor = np.log10(class_pairs.sum(axis=0) + DELTA * (members + 1))  # log of each class's denominator
    base_floor = float(np.log10(n_train + 0.1 * (n_kinds + 1)))
    steps = context.broadcast(transition - floor)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            c = np.frombuffer(b"".join(b.column("classes").to_pylist()), np.uint8)
            lengths = b.column("n_tokens").to_numpy()
            own = b.column("own").to_numpy()
            got = own + np.add.reduceat(steps.value[_before(c, n_classes - 1), c], np.cumsum(lengths) - lengths)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(np.full(b.num_rows, n_train, np.int64)), pa.array(own - lengths * base_floor), pa.array(got)],
                                             [*b.schema.names[:4], "train_tokens", "base_score", "score"])

    return lines.mapInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(id_col: Column) -> Column:
    """True for the fold that the registered query doesn't learn from."""
    return fold(id_col, 10) == 0
