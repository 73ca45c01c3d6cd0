"""Toxicity of disguised texts: a noisy channel is undone first, then the restored text is scored.

Character model.  The chance of a letter after the three before it, smoothed by those of
shorter contexts, from the words of all documents: words are summed in each task, then the
four-letter sequences in one aggregation.  A letter is one of 64 symbols (a-z, 37 classes of
other letters, the end of a word), so at most 2^24 counts reach the driver.
Lattice.  A token that may be disguised becomes a lattice of what it can stand for: digits and
signs that look like letters (``LOOKS_LIKE``), signs put between letters, a star for a hidden
letter, letters repeated three times or more; three or more single letters in a row (``i d i o t``)
become one lattice in which each blank may go.  Every reading has a fixed cost of the channel, and
Viterbi decoding over the last three letters finds the path that is best by channel and
character model together.  A token of letters without such a repetition has one path only,
itself, and isn't decoded; signs at a token's edges are punctuation (``$`` and ``@`` count as
letters where fewer than three stand together).
Score.  Evidence is the beginnings of 4, 5 and 6 letters of the restored words (a shorter word
counts with its end).  Their log odds between toxic and other documents come from a sample of at
most ``MOST_LABELLED`` labelled documents, those of the smallest id hashes, which is therefore small enough
to be broadcast; beginnings whose likelihood ratio (G) is under ``SURE``, and may be chance, are left out.  A logistic regression on five figures of a document
(sum and maximum of the odds of its distinct words, their number, those against, the text's words) is
fitted on the same sample.

Defined results: a null text is empty; empty texts get the regression's value for no words;
very long texts are read whole, in one task; without labels of both kinds every score is the smoothed
share of toxic labels; a document with several labels counts as toxic if one says so, null labels
are left out; rows are kept one to one, also with null or equal ids; an empty table gives an
empty result; further columns of the inputs may have any name."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import fold, kernel, text_groups, written

MOST_LABELLED = 1 << 16
SURE = 24.0
FOLDS = 5
GROUP_BYTES = 3 << 20
_KNOWN_TYPES = 400_000

#: Letters that a digit or sign may stand for.
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c"}
#: Costs of the channel, as natural logarithms.
LOOK, LITERAL, DROPPED, HIDDEN, SHORTENED, JOINED = -1.0, -6.0, -1.5, -2.0, -0.5, -0.5
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_LEFT = ".,;:?\"'()[]{}<>*&%#~^-_=/\\`…»«„“”’"
_RIGHT = _LEFT + "!|"
_THRICE = re.compile(r"(.)\1\1")
_SIGNS = re.compile(r"^([$@])\1\1+|([$@])\2\2+$")
_RUNS = re.compile(r"(.)\1*", re.S)


# -- the character model ----------------------------------------------------------

def symbol(c: str) -> int:
    """0 for what isn't a letter (the end of a word), 1 to 63 for letters."""
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 + ord(c) % 37 if c.isalpha() else 0


def sequence_counts(words: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (24 bits) of all four-letter sequences of the words and their ends, and their counts."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = " ".join(words) + " "
    cps = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    s = np.where((cps >= 97) & (cps <= 122), cps - 96, 27 + cps % 37)
    s[cps == 32] = 0
    weight = np.repeat(np.fromiter(words.values(), np.int64, len(words)), np.diff(np.flatnonzero(s == 0), prepend=-1))
    p1 = np.concatenate([[0], s[:-1]])
    p2 = np.where(p1 == 0, 0, np.concatenate([[0], p1[:-1]]))
    p3 = np.where(p2 == 0, 0, np.concatenate([[0, 0], p1[:-2]]))
    code, at = np.unique(((p3 * 64 + p2) * 64 + p1) * 64 + s, return_inverse=True)
    return code, np.bincount(at, weight, len(code)).astype(np.int64)


class CharacterModel:
    """Smoothed log chances of a symbol after three others."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, weight: float = 4.0):
        order = np.argsort(codes)
        self.codes, self.counts, self.weight = codes[order], counts[order].astype(float), weight
        self.shorter = [np.bincount(codes % 64 ** (k + 1), counts, 64 ** (k + 1)) for k in range(3)]  # of 0 to 2 symbols before
        self.full = np.bincount(codes // 64, counts, 64 ** 3)
        self.known: dict[int, float] = {}

    def __call__(self, context: int, s: int) -> float:
        """``context``: the code of the last three symbols."""
        code = context * 64 + s
        got = self.known.get(code)
        if got is None:
            p = 1 / 64
            for k, table in enumerate(self.shorter):
                c = code % 64 ** (k + 1)
                first = c - c % 64
                p = (table[c] + self.weight * p) / (table[first:first + 64].sum() + self.weight)
            i = int(np.searchsorted(self.codes, code))
            n = self.counts[i] if i < len(self.codes) and self.codes[i] == code else 0.0
            got = self.known[code] = float(np.log((n + self.weight * p) / (self.full[context] + self.weight)))
            if len(self.known) > _KNOWN_TYPES:
                self.known.clear()
        return got


# -- lattice and decoding ------------------------------------------------------------

def lattice(token: str) -> list[list[tuple[str, float]]]:
    """What each stretch of a lower-cased token can stand for, with the cost; a blank may go."""
    out = []
    for m in _RUNS.finditer(token):
        c, n = m[1], len(m[0])
        if c.isalpha():
            out += [[(c, SHORTENED), (c + c, SHORTENED), (m[0], LITERAL)]] if n > 2 else [[(c, 0.0)]] * n
        elif c.isspace():
            out.append([(" ", 0.0), ("", JOINED)])
        else:
            options = [(x, LOOK) for x in LOOKS_LIKE.get(c, "")] + [(c, LITERAL)]
            if not c.isalnum():
                options.append(("", DROPPED))
            if c == "*":
                options += [(x, HIDDEN) for x in _LETTERS]
            out += [options] * min(n, 2) + [[("", 0.0)]] * (n > 2)
    return out


def decode(arcs: list[list[tuple[str, float]]], model) -> str:
    """The best path: the reading of the highest score by channel and model together."""
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for options in arcs:
        new: dict[int, tuple[float, tuple | None]] = {}
        for context, (score, back) in states.items():
            for reading, cost in options:
                now, at = score + cost, context
                for c in reading:
                    s = symbol(c)
                    if s:
                        now, at = now + model(at, s), (at % 4096) * 64 + s
                    elif at:
                        now, at = now + model(at, 0), 0
                if at not in new or now > new[at][0]:
                    new[at] = (now, (back, reading))
        states = new
    _, back = max(((score + (model(at, 0) if at else 0.0), back) for at, (score, back) in states.items()), key=lambda x: x[0])
    out = []
    while back is not None:
        back, reading = back
        out.append(reading)
    return "".join(reversed(out))


def core(token: str) -> str:
    """The token in lower case without the punctuation at its edges."""
    return _SIGNS.sub("", token.lower().lstrip(_LEFT).rstrip(_RIGHT)).lstrip(_LEFT).rstrip(_RIGHT)


def is_plain(word: str) -> bool:
    """True if there is one reading only."""
    return word.isalpha() and not _THRICE.search(word) or not any(map(str.isalpha, word))


def restored(token: str, model) -> str:
    """A token as it was meant, in lower case and without punctuation at its edges."""
    word = core(token)
    return word if is_plain(word) else decode(lattice(word), model)


def letter_words(text: str) -> list[str]:
    """The runs of letters of a decoded token."""
    return [text] if text.isalpha() else "".join(c if c.isalpha() else " " for c in text).split()


def spaced_runs(tokens: list[str]) -> Iterator[str]:
    """Runs of three or more single letters (the last one may end in punctuation)."""
    single = bytes([len(t) == 1 for t in tokens])
    at = single.find(b"\1\1\1")
    while at >= 0:
        end = single.find(b"\0", at)
        end = len(tokens) if end < 0 else end
        run = tokens[at:end]
        if end < len(tokens) and len(core(tokens[end])) == 1:
            run.append(core(tokens[end]))
        yield " ".join(run).lower()
        at = single.find(b"\1\1\1", end)


def restore_text(text: str, model) -> str:
    """The whole text as it was meant; tokens in one reading only stay as they are."""
    tokens, out, k = text.split(), [], 0
    while k < len(tokens):
        run = k
        while run < len(tokens) and len(tokens[run]) == 1:
            run += 1
        if run - k >= 3:
            if run < len(tokens) and len(core(tokens[run])) == 1:
                run += 1
            out.append(decode(lattice(" ".join(core(t) or t for t in tokens[k:run]).lower()), model))
            k = run
            continue
        word = core(tokens[k])
        out.append(tokens[k] if is_plain(word) else decode(lattice(word), model))
        k += 1
    return " ".join(out)


# -- evidence -----------------------------------------------------------------------------

def beginnings(word: str) -> tuple[str, ...]:
    """Of 4, 5 and 6 letters; a shorter word counts with its end."""
    marked = word + "."
    return tuple({marked[:n] for n in (4, 5, 6)})


class Reader:
    """The distinct restored words of texts; what tokens stand for is remembered."""

    def __init__(self, model: CharacterModel, weights: dict[str, float] | None = None):
        self.model, self.weights = model, weights
        self.plain: set[str] = set()                          # tokens without evidence
        self.words: dict[str, tuple[str, ...]] = {}           # words of the other tokens
        self.odds_of: dict[str, float] = {}

    def _read(self, token: str, decoded: str) -> None:
        words = tuple(letter_words(decoded))
        if self.weights is not None:
            words = tuple(w for w in words if self.odds(w))
        if words:
            self.words[token] = words
        else:
            self.plain.add(token)

    def odds(self, word: str) -> float:
        """The largest log odds of a word's beginnings, by absolute value."""
        got = self.odds_of.get(word)
        if got is None:
            got = max((self.weights.get(b, 0.0) for b in beginnings(word)), key=abs, default=0.0)
            if got:
                self.odds_of[word] = got
        return got

    def distinct(self, text: str) -> tuple[set[str], int]:
        """The words that matter (all, without weights) and the number of tokens."""
        if len(self.plain) + len(self.words) > _KNOWN_TYPES:
            self.plain.clear()
            self.words.clear()
            self.odds_of.clear()
        tokens = text.split()
        left = set(tokens) - self.plain
        for t in [t for t in left if t not in self.words]:
            self._read(t, restored(t, self.model))
        found = {w for t in left if t in self.words for w in self.words[t]}
        for run in spaced_runs(tokens):
            if run not in self.plain and run not in self.words:
                self._read(run, decode(lattice(run), self.model))
            found.update(self.words.get(run, ()))
        return found, len(tokens)

    def figures(self, text: str) -> list[float]:
        """The five figures of the regression."""
        words, n = self.distinct(text)
        odds = [self.odds(w) for w in words]
        up = [x for x in odds if x > 0]
        return [min(sum(up), 100.0), max(up, default=0.0), np.log1p(len(up)), np.log1p(len(odds) - len(up)), np.log1p(n)]


def log_odds(rows: Iterable[tuple[str, int, int]], toxic: int, other: int) -> dict[str, float]:
    """Beginning -> log odds between toxic and other documents, where these are sure."""
    out = {}
    share = toxic / (toxic + other)
    for b, n1, n0 in rows:
        n = n1 + n0
        g = sum(x * np.log(x / e) for x, e in ((n1, n * share), (n0, n - n * share), (toxic - n1, toxic - n * share),
                                                (other - n0, other - n + n * share)) if x > 0)
        if 2 * g >= SURE:
            out[b] = float(np.log((n1 + 0.5) / (toxic - n1 + 0.5)) - np.log((n0 + 0.5) / (other - n0 + 0.5)))
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method, the constant first (not shrunk)."""
    x = np.column_stack([np.ones(len(x)), x])
    w, shrink = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    shrink[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + shrink * w
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink) + 1e-9 * np.eye(len(w)), grad)
        w = w - move * min(1.0, 5.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-8:
            break
    return w


# -- Spark ------------------------------------------------------------------------------------

@dataclass
class Model:
    characters: CharacterModel
    weights: dict[str, float]
    regression: np.ndarray


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, FOLDS) == 0


def character_model(docs: DataFrame, text_col: str = "text") -> CharacterModel:
    """From the words of all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            words: Counter = Counter()
            for t, n in held.items():
                for w in letter_words(t.lower()):
                    words[w] += n
            held.clear()
            code, n = sequence_counts(words)
            return pa.RecordBatch.from_arrays([pa.array(code, pa.int32()), pa.array(n)], ["code", "n"])
        for b in text_groups(batches, "text", GROUP_BYTES):
            for t in b.column("text").to_pylist():
                if t:
                    held.update(t.split())
            if len(held) > _KNOWN_TYPES:
                yield out()
        yield out()

    kernel(docs)
    got = (docs.select(F.col(text_col).alias("text")).mapInArrow(count, "code int, n long")
               .groupBy("code").agg(F.sum("n").alias("n")).toArrow())
    return CharacterModel(got.column("code").to_numpy().astype(np.int64), got.column("n").to_numpy())


def labelled_sample(docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str, most: int) -> DataFrame:
    """(text, toxic) of at most ``most`` labelled documents of the training part."""
    few = (labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).where(train)
                 .groupBy(F.col(id_col).alias("label_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
                 .orderBy(F.xxhash64("label_id"), "label_id").limit(most))
    # at most ``most`` rows of two numbers
    return (docs.select(F.col(id_col).alias("own_id"), F.col(text_col).alias("text"))
                .join(F.broadcast(few), F.col("own_id") == F.col("label_id")).select("text", "toxic"))


def fit(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_LABELLED) -> Model:
    """Learns from the labels of the documents in ``train``, a condition on the id column."""
    spark = kernel(docs)
    characters = character_model(docs, text_col)
    sample = labelled_sample(docs, labels, train, id_col, text_col, most)
    shared = spark.sparkContext.broadcast(characters)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        held: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            keys = list(held[0].keys() | held[1].keys())
            columns = [pa.array(keys, pa.string()), pa.array([held[1][k] for k in keys], pa.int64()), pa.array([held[0][k] for k in keys], pa.int64())]
            held[0].clear()
            held[1].clear()
            return pa.RecordBatch.from_arrays(columns, ["beginning", "n1", "n0"])
        for b in text_groups(batches, "text", GROUP_BYTES):
            for t, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                held[int(y > 0)].update({x for w in reader.distinct(t or "")[0] for x in beginnings(w)})
                held[int(y > 0)][""] += 1
            if len(held[0]) + len(held[1]) > _KNOWN_TYPES:
                yield out()
        yield out()

    counted = (sample.mapInArrow(evidence, "beginning string, n1 long, n0 long").groupBy("beginning")
                     .agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")))
    counted = written(counted, "toxicity-evidence")
    # the documents' own numbers are those of ''
    toxic, other = next(((r["n1"], r["n0"]) for r in counted.where("beginning = ''").collect()), (0, 0))
    if not toxic or not other:
        share = (toxic + 1) / (toxic + other + 2)
        return Model(characters, {}, np.array([np.log(share / (1 - share)), 0, 0, 0, 0, 0]))
    # n documents of one kind have a G of -2 n log(share) at most, so rarer ones needn't reach the driver
    least = SURE / (-2 * np.log(min(toxic, other) / (toxic + other)))
    found = counted.where((F.col("n1") + F.col("n0") >= float(least)) & (F.col("beginning") != "")
                          & ((F.col("n1") * other >= 1.2 * F.col("n0") * toxic) | (F.col("n0") * toxic >= 1.2 * F.col("n1") * other))).toArrow()
    weights = log_odds(zip(*(found.column(c).to_pylist() for c in ("beginning", "n1", "n0"))), toxic, other)
    known = spark.sparkContext.broadcast((characters, weights))

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(*known.value)
        for b in text_groups(batches, "text", GROUP_BYTES):
            x = pa.array([reader.figures(t or "") for t in b.column("text").to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([x, b.column("toxic")], ["x", "toxic"])

    rows = sample.mapInArrow(figures, "x array<double>, toxic int").toArrow()
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, 5)
    order = np.lexsort((*x.T, y := (rows.column("toxic").to_numpy() > 0).astype(float)))  # sums in a fixed order
    return Model(characters, weights, fit_logistic(x[order], y[order]))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    spark = kernel(docs)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        reader = Reader(m.characters, m.weights)
        for b in text_groups(batches, "text", GROUP_BYTES):
            x = np.array([reader.figures(t or "") for t in b.column("text").to_pylist()]).reshape(-1, 5)
            p = 1 / (1 + np.exp(-np.clip(m.regression[0] + x @ m.regression[1:], -700, 700)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
                .mapInArrow(score, f"doc_id {kind}, score double, predicted int"))


def restore_documents(docs: DataFrame, characters: CharacterModel, text_col: str = "text", name: str = "restored") -> DataFrame:
    """``docs`` with the restored text in a new column (null stays null)."""
    shared = kernel(docs).sparkContext.broadcast(characters)

    @F.pandas_udf("string")
    def restore(texts):
        return texts.map(lambda t: None if t is None else restore_text(t, shared.value))
    return docs.withColumn(name, restore(F.col(text_col)))
