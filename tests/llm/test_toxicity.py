"""Deobfuscation against trying every path, and toxicity scores on held-out documents."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import toxicity as T

WORDS = ("the river takes stone over water under quiet morning light gathers along narrow street while people carry "
         "letters toward garden where older trees shade benches after summer rain stops").split()
BAD = ["idiot", "moron", "stupid", "worthless"]


def _model(extra=()):
    code, n = T.sequence_counts({**{w: 50 for w in WORDS}, **{w: 5 for w in BAD}, **{w: 5 for w in extra}})
    return T.CharacterModel(code, n)


def test_sequence_counts_equal_a_plain_count():
    words = {"ab": 2, "b": 3, "äaa": 1}
    plain = {}
    for w, n in words.items():
        s = [T.symbol(c) for c in w] + [0]
        for i, x in enumerate(s):
            before = ([0, 0, 0] + s[:i])[-3:]
            code = ((before[0] * 64 + before[1]) * 64 + before[2]) * 64 + x
            plain[code] = plain.get(code, 0) + n
    code, n = T.sequence_counts(words)
    assert dict(zip(code.tolist(), n.tolist())) == plain
    assert len(T.sequence_counts({})[0]) == 0


def test_chances_add_up_to_one():
    m = _model()
    for context in (0, 5, 64 * 3 + 9, (20 * 64 + 8) * 64 + 5):
        assert abs(sum(np.exp(m(context, s)) for s in range(64)) - 1) < 1e-9


@pytest.mark.parametrize("token", ["1d10t", "m0r-n", "st*p", "looo$e", "a b c", "$$t"])
def test_decoding_equals_trying_every_path(token):
    m = _model()

    def value(path):
        at, score = 0, 0.0
        for reading, cost in path:
            score += cost
            for c in reading:
                s = T.symbol(c)
                if s:
                    score, at = score + m(at, s), (at % 4096) * 64 + s
                elif at:
                    score, at = score + m(at, 0), 0
        return score + (m(at, 0) if at else 0.0)
    arcs = T.lattice(token)
    best = max(value(p) for p in itertools.product(*arcs))
    found = T.decode(arcs, m)
    assert any("".join(r for r, _ in p) == found and abs(value(p) - best) < 1e-9 for p in itertools.product(*arcs))


@pytest.mark.parametrize("disguised,meant", [("1d10t", "idiot"), ("m0r0n", "moron"), ("i d i o t", "idiot"), ("m.o.r.o.n", "moron"), ("stuuuupid", "stupid"),
                                             ("$tup1d!!", "stupid"), ("st*pid", "stupid"), ("w0rth1e$$", "worthless"), ("I D I O T.", "idiot"), ("id1ot&&&", "idiot")])
def test_disguises(disguised, meant):
    assert T.restore_text(f"the {disguised} takes", _model()) == f"the {meant} takes"


def test_plain_text_stays():
    text = " ".join(WORDS) + " Straße, 2024 a b! (the) &&& x"
    assert T.restore_text(text, _model()) == text
    assert T.restore_text("", _model()) == ""


def _corpus(n=600, seed=5):
    rnd, docs, labels = random.Random(seed), [], []
    disguises = [lambda w: w, lambda w: w.replace("o", "0").replace("i", "1"), lambda w: " ".join(w), lambda w: ".".join(w), lambda w: w.upper() + "!!", lambda w: w[0] + w[1] * 4 + w[2:]]
    for i in range(n):
        words = [rnd.choice(WORDS) for _ in range(rnd.choice([8, 40, 200]))]
        toxic = i % 5 == 1 or i % 7 == 3
        if toxic:
            out = zlib.crc32(str(i).encode()) % 5 == 0
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(disguises if out else disguises[:2])(rnd.choice(BAD)))
        docs.append((i, " ".join(words), "x", "y"))
        labels.append((i, int(toxic), "z"))
    return docs, labels


DOCS, LABELS = "doc_id long, text string, toxic string, label_id string", "doc_id long, toxic int, text string"


def test_held_out_documents(spark):
    docs, labels = _corpus()
    d, y = spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(labels, LABELS)
    model = T.fit(d, y, ~T.held_out(F.col("doc_id")))
    got = {r["doc_id"]: r for r in T.score_documents(d, model).collect()}
    assert len(got) == len(docs)
    held = [(i, t) for i, t, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i]["predicted"] == t for i, t in held) >= 0.98 * len(held) and any(t for _, t in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    # the scores of a second fit over other partitions are the same
    again = T.fit(d.repartition(3), y.repartition(2), ~T.held_out(F.col("doc_id")))
    assert again.weights == model.weights and np.allclose(again.regression, model.regression, atol=1e-9)


def test_no_use_of_held_out_labels(spark):
    docs, labels = _corpus(200)
    d = spark.createDataFrame(docs, DOCS)
    train = ~T.held_out(F.col("doc_id"))
    one = T.fit(d, spark.createDataFrame(labels, LABELS), train)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, x) for i, t, x in labels]
    two = T.fit(d, spark.createDataFrame(flipped, LABELS), train)
    assert one.weights == two.weights and np.array_equal(one.regression, two.regression)


def test_nulls_empty_long_and_repeated(spark):
    docs, labels = _corpus(200)
    odd = [(None, "the idiot", None, None), (1000, None, None, None), (1001, "", None, None), (1001, "", None, None), (1002, "a " * 200_000 + "id10t", None, None),
           (1003, "x" * 300_000, None, None), (1004, "ö" * 5 + " ＩＤ ٣ \u0000 �", None, None), (3, "other text of an id", None, None)]
    labels = labels + [(None, 1, ""), (5, None, ""), (3, 0, ""), (99999, 1, "")]
    d = spark.createDataFrame(docs + odd, DOCS)
    model = T.fit(d, spark.createDataFrame(labels, LABELS), ~T.held_out(F.col("doc_id")))
    got = T.score_documents(d, model).collect()
    assert len(got) == len(docs) + len(odd) and all(0 <= r["score"] <= 1 for r in got)
    none = [r["score"] for r in got if r["doc_id"] in (1000, 1001)]
    assert len(set(none)) == 1 and none[0] < 0.5


def test_no_labels_and_empty_tables(spark):
    docs, labels = _corpus(50)
    d, none = spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS)
    model = T.fit(d, none, F.lit(True))
    assert {r["score"] for r in T.score_documents(d, model).collect()} == {0.5}
    empty = spark.createDataFrame([], DOCS)
    assert T.score_documents(empty, T.fit(empty, none, F.lit(True))).collect() == []
    only = T.fit(d, spark.createDataFrame([x for x in labels if not x[1]], LABELS), F.lit(True))
    assert max(r["score"] for r in T.score_documents(d, only).collect()) < 0.1


def test_restored_column(spark):
    d = spark.createDataFrame([(1, "the m0r0n"), (2, None)], "doc_id long, text string")
    got = T.restore_documents(d, _model()).collect()
    assert [r["restored"] for r in got] == ["the moron", None]
