"""Language identification with a linear-chain conditional random field.

Every word (a run of letters and marks, lower-cased) of a text is one position
of the chain.  Features of a word are its prefixes and suffixes, its letter
n-grams and its entry in a lexicon (the language that most uses it, in three
grades of certainty); feature weights and the transitions between languages
are learned together by maximum likelihood.  Forward-backward gives each word
a probability for each language, so text that switches languages is labelled
word by word; a document gets the language with the largest mean probability.

Learning.  The model is fitted on a bounded sample of labelled rows, which is
all that ever reaches the driver: at most ``DOCS_PER_LANGUAGE`` documents of a
language, cut into runs of ``RUN_WORDS`` words, of which at most
``RUNS_PER_LANGUAGE`` of a language and ``MOST_RUNS`` in all are taken, each in
the order of a hash.  Two runs, often of two languages, are joined to one
training sequence, so switches are seen.  Half of the runs make the lexicon,
the other half the weights.

Applying.  One scan, no shuffle: an Arrow function labels whole texts, of any
length, in groups of about ``GROUP_BYTES``, the only part of a batch that is held
as Python words; a word's score is computed once per group
of words that are remembered, and forward-backward runs over all texts of a
group side by side.

Defined results: ``und`` and score 0 for a null text, a text without a letter,
and everything if no labelled row exists; equal texts get equal results; rows
are kept one to one, also with null or equal ids; rows without a language are never
learned from; a very long text is a group of its own, read whole; an empty table gives an
empty result; further columns may have any name (``with_language`` keeps them, its own
column is named by the caller)."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.llm.common import fold, kernel, mix, text_groups, words_of

DOCS_PER_LANGUAGE = 200
RUN_WORDS = 20
RUNS_PER_LANGUAGE = 1500
MOST_RUNS = 60_000
FEATURES = 1 << 16
EPOCHS = 60
UNKNOWN = "und"

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
GROUP_BYTES = 2 << 20
_KNOWN_WORDS = 150_000


def letter_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, feature) of all features of all words: letter n-grams of two and three with the word's
    edges, prefixes and suffixes of one to four letters, the lexicon's entry."""
    n = len(words)
    c = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, n)
    first = np.cumsum(size + 2) - size - 1  # place of each word's first letter
    owner = np.repeat(np.arange(n), size + 2)
    owners, hashes = [], []

    def put(own: np.ndarray, kind: int, starts: np.ndarray, k: int) -> None:
        h = np.full(len(starts), np.uint64(kind))
        for j in range(k):
            h = mix(h * np.uint64(31) + c[starts + j])
        owners.append(own)
        hashes.append(h)
    for k in (2, 3):
        at = np.flatnonzero(owner[:max(0, len(owner) - k + 1)] == owner[k - 1:]) if len(owner) >= k else owner[:0]
        put(owner[at], k, at, k)
    for k in (1, 2, 3, 4):
        long = np.flatnonzero(size >= k)
        put(long, 10 + k, first[long], k)
        put(long, 20 + k, first[long] + size[long] - k, k)
    entry = np.fromiter((lexicon.get(w, -1) for w in words), np.int64, n)
    owners.append(np.arange(n))
    hashes.append(mix(np.uint64(1 << 40) + (entry + 1).astype(np.uint64)))
    return np.concatenate(owners), (np.concatenate(hashes) % np.uint64(FEATURES)).astype(np.int64)


def _word_scores(words: list[str], lexicon: dict[str, int], weights: np.ndarray) -> np.ndarray:
    """The sum of the weights of each word's features, a row a word."""
    owner, flat = _features(words, lexicon)
    return np.stack([np.bincount(owner, weights[flat, k], len(words)) for k in range(weights.shape[1])], axis=1).astype(np.float32)


def forward_backward(potential: np.ndarray, trans: np.ndarray, start: np.ndarray, offsets: np.ndarray,
                     lengths: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Label probabilities of every position of many sequences at once.

    ``potential`` holds the positions' label potentials, sequence after
    sequence; sequences start at ``offsets``.  Step t is taken for all
    sequences longer than t together.  With ``pairs`` also the expected number
    of each transition."""
    order = np.argsort(-lengths, kind="stable")
    offsets, lengths = offsets[order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps + 1), side="left")
    ahead = np.empty_like(potential)
    a = None
    for t in range(steps):
        at = offsets[:active[t]] + t
        a = potential[at] * (start if t == 0 else a[:active[t]] @ trans)
        a /= a.sum(axis=1, keepdims=True)
        ahead[at] = a
    expected = np.zeros_like(trans) if pairs else None
    out = np.empty_like(potential)
    back, later = None, 0
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = offsets[:n] + t
        b = np.ones((n, potential.shape[1]), potential.dtype)
        if later:
            carried = potential[at[:later] + 1] * back
            b[:later] = carried @ trans.T
            b[:later] /= b[:later].sum(axis=1, keepdims=True)
            if pairs:
                joint = ahead[at[:later]][:, :, None] * trans[None] * carried[:, None, :]
                expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        out[at] = ahead[at] * b
        back, later = b, n
    out /= out.sum(axis=1, keepdims=True)
    return out, expected


def _potentials(scores: np.ndarray) -> np.ndarray:
    return np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -30))


@dataclass
class LanguageModel:
    """Languages, feature weights, transition and start scores, lexicon (word -> entry)."""
    languages: list[str]
    weights: np.ndarray
    trans: np.ndarray
    start: np.ndarray
    lexicon: dict[str, int]
    known: dict[str, int] = field(default_factory=dict, repr=False)
    scores: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "known": {}, "scores": None}

    def forget(self) -> None:
        """Drop the remembered word scores."""
        self.known, self.scores = {}, None

    def word_scores(self, words: list[str]) -> np.ndarray:
        """One row of label scores for each word."""
        new = list(set(words).difference(self.known))
        if len(self.known) + len(new) > _KNOWN_WORDS:
            self.forget()
            new = list(set(words))
        if new:
            rows = _word_scores(new, self.lexicon, self.weights)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.scores = rows if self.scores is None else np.concatenate([self.scores, rows])
        return self.scores[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]

    def marginals(self, sequences: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Label probabilities of all words of non-empty sequences, with offsets and lengths."""
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        offsets = np.cumsum(lengths) - lengths
        pot = _potentials(self.word_scores([w for s in sequences for w in s]))
        probs, _ = forward_backward(pot, _potentials(self.trans).astype(pot.dtype),
                                    _potentials(self.start[None])[0].astype(pot.dtype), offsets, lengths)
        return probs, offsets, lengths

    def classify(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return langs, scores
        at, group = [], []
        for i, text in enumerate(texts):
            if text and (words := letter_words(text)):
                at.append(i)
                group.append(words)
        if group:
            self._classify(at, group, langs, scores)
        return langs, scores

    def _classify(self, at, group, langs, scores) -> None:
        probs, offsets, lengths = self.marginals(group)
        mean = np.add.reduceat(probs, offsets, axis=0, dtype=np.float64) / lengths[:, None]
        best = mean.argmax(axis=1)
        for i, k, p in zip(at, best.tolist(), mean.max(axis=1).tolist()):
            langs[i], scores[i] = self.languages[k], min(1.0, p)


def _lexicon(runs: list[tuple[str, list[str]]], languages: list[str]) -> dict[str, int]:
    """Word -> 3 * language + grade, for words seen at least twice."""
    use: dict[str, Counter] = defaultdict(Counter)
    for lang, words in runs:
        for w in words:
            use[w][lang] += 1
    number = {x: i for i, x in enumerate(languages)}
    out = {}
    for w, c in use.items():
        (lang, n), total = min(c.items(), key=lambda x: (-x[1], x[0])), sum(c.values())
        if total >= 2:
            share = n / total
            out[w] = 3 * number[lang] + (2 if share >= 0.95 else 1 if share >= 0.7 else 0)
    return out


def fit_runs(runs: list[tuple[str, list[str]]], epochs: int = EPOCHS) -> LanguageModel:
    """A model from (language, words) runs: maximum likelihood by Adam over the
    whole (bounded) sample, with a small quadratic penalty."""
    runs = [(lang, words) for lang, words in runs if words]
    languages = sorted({lang for lang, _ in runs})
    n = len(languages)
    lexicon = _lexicon(runs[::2], languages)
    model = LanguageModel(languages, np.zeros((FEATURES, n), np.float32), np.zeros((n, n)), np.zeros(n), lexicon)
    learn = runs[1::2] or runs
    if n == 0:
        return model
    half = (len(learn) + 1) // 2
    number = {x: i for i, x in enumerate(languages)}
    joined = [[learn[i], learn[i + half]] if i + half < len(learn) else [learn[i]] for i in range(half)]
    words = [w for seq in joined for _, ws in seq for w in ws]
    gold = np.array([number[lang] for seq in joined for lang, ws in seq for _ in ws])
    lengths = np.array([sum(len(ws) for _, ws in seq) for seq in joined])
    offsets = np.cumsum(lengths) - lengths
    kinds = sorted(set(words))
    place = {w: i for i, w in enumerate(kinds)}
    token = np.array([place[w] for w in words])
    owner, flat = _features(kinds, lexicon)
    by_word = np.argsort(owner, kind="stable")
    owner, flat = owner[by_word], flat[by_word]
    ends = np.flatnonzero(np.diff(owner, prepend=-1))
    hot = np.eye(n)[gold]
    inner = np.ones(len(words), bool)
    inner[offsets] = False
    nxt = inner.nonzero()[0]
    seen = np.zeros((n, n))
    np.add.at(seen, (gold[nxt - 1], gold[nxt]), 1)
    seen_start = np.bincount(gold[offsets], minlength=n)
    w, trans, start = np.zeros((FEATURES, n)), np.zeros((n, n)), np.zeros(n)
    params, moments = [w, trans, start], [[np.zeros_like(p), np.zeros_like(p)] for p in (w, trans, start)]
    for step in range(1, epochs + 1):
        score = np.add.reduceat(w[flat], ends, axis=0)
        probs, pairs = forward_backward(_potentials(score[token]), _potentials(trans), _potentials(start[None])[0],
                                        offsets, lengths, pairs=True)
        diff = hot - probs
        by_kind = np.stack([np.bincount(token, diff[:, k], len(kinds)) for k in range(n)], axis=1)
        grad_w = np.stack([np.bincount(flat, by_kind[owner, k], FEATURES) for k in range(n)], axis=1)
        grads = [grad_w / len(words) - 1e-6 * w, (seen - pairs) / len(words) - 1e-6 * trans,
                 (seen_start - probs[offsets].sum(axis=0)) / len(offsets) - 1e-6 * start]
        for p, g, (m, v) in zip(params, grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model.weights, model.trans, model.start = w.astype(np.float32), trans, start
    return model


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        where: Column | None = None) -> LanguageModel:
    """Fit on the bounded sample of labelled rows (see the module) for which ``where`` holds."""
    rows = docs if where is None else docs.where(where)
    rows = (rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
                .where(F.col("lang").isNotNull() & F.col("text").isNotNull()))
    by_lang = Window.partitionBy("lang")
    drawn = (rows.withColumn("h", F.xxhash64("id", "text"))
                 .withColumn("r", F.row_number().over(by_lang.orderBy("h", "text")))
                 .where(F.col("r") <= DOCS_PER_LANGUAGE))
    words = drawn.select("lang", "h", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.floor((F.size("w") - 1) / RUN_WORDS).cast("int"))
    runs = (words.select("lang", "h", "w", F.explode(starts).alias("i"))
                 .select("lang", F.xxhash64("h", "i").alias("h"),
                         F.array_join(F.slice("w", F.col("i") * RUN_WORDS + 1, RUN_WORDS), " ").alias("run"))
                 .withColumn("r", F.row_number().over(by_lang.orderBy("h", "run")))
                 .where(F.col("r") <= RUNS_PER_LANGUAGE)
                 .orderBy("r", "h", "lang", "run").limit(MOST_RUNS))
    sample = [(r["lang"], letter_words(r["run"])) for r in runs.select("lang", "run", "r", "h").collect()]
    return fit_runs(sample)


def with_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", name: str = "language") -> DataFrame:
    """``docs`` with a struct(lang_pred, score) of each whole text in a new column."""
    shared = kernel(docs).sparkContext.broadcast(model)
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_groups(batches, text_col, GROUP_BYTES):
            langs, scores = shared.value.classify(b.column(text_col).to_pylist())
            found = pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])
            yield pa.RecordBatch.from_arrays([*b.columns, found], [*b.schema.names, name])
        shared.value.forget()  # workers live on; what they remember of this task's words does not

    return docs.mapInArrow(classify, T.StructType([*docs.schema.fields, T.StructField(name, kind)]))


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_language(src, model, name="p").select("doc_id", "p.lang_pred", "p.score")


def label_words(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, words, langs, probs): each word of each text with its most
    probable language and that probability; empty arrays without letters."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kernel(src)

    @F.pandas_udf("words array<string>, langs array<string>, probs array<double>")
    def label(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts.tolist():
            words = letter_words(text) if text and model.languages else []
            if not words:
                rows.append(([], [], []))
                continue
            probs, _, _ = model.marginals([words])
            rows.append((words, [model.languages[k] for k in probs.argmax(axis=1)], probs.max(axis=1).astype(float).tolist()))
        return pd.DataFrame(rows, columns=["words", "langs", "probs"])

    return src.withColumn("p", label("text")).select("doc_id", "p.words", "p.langs", "p.probs")


def held_out(id_col: Column) -> Column:
    """True for the fold that the registered query doesn't learn from."""
    return fold(id_col, 4) == 2
