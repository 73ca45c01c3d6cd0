"""Substring dedup against brute force over all windows."""

import random

import pytest

from ratewise.llm import substring_dedup as sd


def brute(rows, window):
    seen = {}
    words = [(i, (t or "").encode().split()) for i, t in rows]
    key = lambda i: (i is not None, i if i is not None else 0)
    for i, w in words:
        for s in range(len(w) - window + 1):
            k, at = tuple(w[s:s + window]), (key(i), s)
            seen[k] = min(seen.get(k, at), at)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s:s + window])] < (key(i), s):
                gone[s:s + window] = [True] * window
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(12 if seed % 2 else 400)]
    some = lambda k: [rng.choice(vocab) for _ in range(k)]
    passage, texts = some(60), []
    for i in range(n):
        w = some(rng.randrange(0, 120))
        if i % 3 == 0:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[rng.randrange(10):]
        if i % 7 == 0 and texts:
            w = texts[rng.randrange(len(texts))].split()
            if i % 2 and w:
                w[rng.randrange(len(w))] = "edit"
        texts.append((" " if i % 5 else "\n\t ").join(w))
    ids = list(range(n))
    rng.shuffle(ids)
    return list(zip(ids, texts))


@pytest.mark.parametrize("seed,window,anchor", [(1, 20, 8), (2, 20, 8), (3, 6, 3), (4, 6, 6)])
def test_equals_brute_force(spark, monkeypatch, seed, window, anchor):
    rows = corpus(seed, 150) + [(1000, None), (1001, ""), (1002, " \n "), (None, "a b c"), (1003, "loop " * 5000)]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, n_words int").repartition(7)
    got = sd.dedup_substrings(docs, window, anchor).collect()
    key = lambda r: str(r)
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got], key=key) == sorted(brute(rows, window), key=key)
    # every factor is a copy of its source
    words = {i: (t or "").split() for i, t in rows}
    for r in got:
        for f in r.factors:
            assert words[r.doc_id][f.start:f.start + f.n_words] == words[f.ref_doc][f.ref_start:f.ref_start + f.n_words]


def test_small_blocks_and_repeated_ids(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(5, text), (5, text), (5, "other " + text), (9, text), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in sd.dedup_substrings(docs).collect())
    # equal ids are one place: only a smaller start is earlier
    assert got == [(2, 0, 0), (5, 30, 0), (5, 30, 0), (5, 31, 30), (9, 30, 30)]
    assert sd.dedup_substrings(docs.where("false")).count() == 0
