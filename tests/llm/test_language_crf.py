"""Language CRF: forward-backward against enumeration, held-out accuracy, code-switched words, edge cases."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import language_crf as crf


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    lengths = np.array([4, 1, 3])
    offsets = np.cumsum(lengths) - lengths
    pot, trans, start = rng.random((8, 3)), rng.random((3, 3)), rng.random(3)
    probs, pairs = crf.forward_backward(pot, trans, start, offsets, lengths, pairs=True)
    want, want_pairs = np.zeros((8, 3)), np.zeros((3, 3))
    for o, n in zip(offsets, lengths):
        total, own, own_pairs = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in product(range(3), repeat=int(n)):
            p = start[path[0]] * np.prod([pot[o + i, k] for i, k in enumerate(path)]) * np.prod([trans[a, b] for a, b in zip(path, path[1:])])
            total += p
            for i, k in enumerate(path):
                own[i, k] += p
            for a, b in zip(path, path[1:]):
                own_pairs[a, b] += p
        want[o:o + n] = own / total
        want_pairs += own_pairs / total
    assert np.allclose(probs, want) and np.allclose(pairs, want_pairs)


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, crf.fit(docs, where=~crf.held_out(F.col("doc_id")))


def test_held_out_accuracy(model):
    docs, m = model
    got = crf.identify(docs, m).join(docs.select("doc_id", "lang"), "doc_id").where(crf.held_out(F.col("doc_id"))).toPandas()
    assert len(got) > 150
    assert (got.lang_pred == got.lang).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_code_switched_words(spark, model):
    docs, m = model
    held = docs.where(crf.held_out(F.col("doc_id"))).where("n_chars > 400").toPandas()
    one = crf.letter_words(held[held.lang == "en"].text.iloc[0])[:40]
    two = crf.letter_words(held[held.lang == "de"].text.iloc[0])[:40]
    row = crf.label_words(spark.createDataFrame([(1, " ".join(one + two))], "doc_id long, text string"), m).first()
    assert row.words == one + two
    right = sum(a == b for a, b in zip(row.langs, ["en"] * len(one) + ["de"] * len(two)))
    assert right >= 0.9 * len(row.words)


def test_edge_cases(spark, model):
    _, m = model
    rows = [(1, None, "x"), (None, "", "x"), (2, "123 --- \n", "x"), (3, "the and of " * 60_000, "x"), (3, "the and of " * 60_000, "x"), (4, "z" * 5000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = crf.identify(docs, m).collect()
    assert [(r.lang_pred, r.score) for r in got[:3]] == [("und", 0.0)] * 3
    assert got[3] == got[4] and got[3].lang_pred == "en"
    assert got[5].lang_pred in m.languages
    empty = crf.fit(spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string"))
    assert empty.languages == [] and crf.identify(docs, empty).where("lang_pred <> 'und'").count() == 0
    assert crf.identify(docs.where("false"), m).count() == 0
    one = crf.fit(spark.createDataFrame([(1, "hello", "en")], "doc_id long, text string, lang string"))
    assert crf.identify(docs, one).where("lang_pred = 'en'").count() == 3
