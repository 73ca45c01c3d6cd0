"""N-gram Jaccard join against brute force."""

import random

import numpy as np
import pytest

from ratewise.llm import ngram_join as nj


def grams(text, n=5):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def links(a, b, percent):
    return bool(a) and 100 * len(a & b) >= percent * len(a | b)


def brute(rows, percent=80):
    sets = [grams(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if links(sets[i], sets[j], percent):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed, n):
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        w = [f"v{rng.randrange(900)}" for _ in range(rng.choice([0, 2, 5, 6, 30, 80, 200]))]
        if texts and i % 2:
            w = texts[rng.randrange(len(texts))].split()
            for _ in range(rng.randrange(0, 5)):
                if w:
                    w[rng.randrange(len(w))] = f"e{rng.randrange(50)}"
            w = w[rng.randrange(3):]
        if i % 4 == 0:
            w += [f"shared{j}" for j in range(40)]
        texts.append(" ".join(w) if i % 3 else " ".join(w).upper())
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed, 260) + [(900, ""), (901, None), (902, " \n"), (903, "long one " * 4000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, cls string").repartition(5)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in nj.jaccard_components(docs).collect())
    assert got == brute(rows)


def test_chain_and_star_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):  # each links with the base, few with one another
        w = list(base)
        for _ in range(2):
            w[rng.randrange(len(w))] = f"x{i}"
        rows.append((i, " ".join(w)))
    w = list(base)
    for i in range(60, 90):  # a chain of single edits
        w = list(w)
        w[(i * 4) % 120] = f"c{i}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in nj.jaccard_components(docs).collect())
    assert got == brute(rows)


def test_trie_walk_equals_sets():
    rng = random.Random(9)
    for _ in range(200):
        q = sorted(rng.sample(range(40), rng.randrange(1, 30)))
        recs = [sorted(set(q) ^ set(rng.sample(range(60), rng.randrange(0, 9)))) for _ in range(30)]
        recs = [r for r in recs if r]
        want = [i for i, r in enumerate(recs) if links(set(q), set(r), 80)]
        assert sorted(nj.walk_trie(q, recs, 80)) == want


def test_ties_nulls_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c"), (4, "A b c"), (4, "a b c"), (6, None), (None, None)], "doc_id long, text string")
    got = sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id) for r in nj.jaccard_components(docs).collect())))
    assert got == sorted(map(str, [(None, 1, 4), (4, 1, 4), (4, 1, 4), (6, 0, 6), (None, 0, None)]))
    assert nj.jaccard_components(docs.where("false")).count() == 0


def test_sketch_bounds_the_overlap():
    """No pair that links is left out, most others are; large sets aren't judged."""
    rng = np.random.default_rng(2)
    kept = 0
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, size=rng.integers(1, 400)).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([rng.permutation(a)[rng.integers(0, max(1, len(a) // 3)):], rng.integers(0, 2**63, size=rng.integers(0, 60)).astype(np.uint64)]))
        ok = bool(nj.may_link(*(np.frombuffer(nj.sketch(x), np.uint8)[None] for x in (a, b)), 80)[0])
        both = len(np.intersect1d(a, b))
        linked = 100 * both >= 80 * (len(a) + len(b) - both)
        assert ok or not linked
        kept += ok and not linked
    assert kept < 60
    huge = np.zeros((1, 256), np.uint8)
    huge[0, 0] = 255
    assert nj.may_link(huge, np.zeros((1, 256), np.uint8), 80)[0]
