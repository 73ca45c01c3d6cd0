"""Order MinHash fingerprints: contract columns, equality, order sensitivity, brute-force neighbours."""

import hashlib
import random

import pytest

from ratewise.llm import order_minhash as om


def expected(rows):
    """(id, n_chars, edited text) with the next document in descending order of id."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        out[i] = (len(t), t[:len(t) - half] + nxt[:half])
    return out


def corpus(n):
    rng = random.Random(8)
    rows = [(i * 3, " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else f"w{rng.randrange(900)}" for _ in range(rng.randrange(0, 400)))) for i in range(n)]
    return rows + [(1, None), (2, ""), (4, " \n "), (5, "one"), (7, "😀 é " * 50), (8, "long text here " * 20_000), (10, rows[3][1]), (11, rows[3][1])]


@pytest.mark.parametrize("range_bytes", [8 << 20, 20_000])
def test_contract(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(om, "RANGE_BYTES", range_bytes)
    rows = corpus(60)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, range string, row int").repartition(4)
    got = {r.doc_id: r for r in om.document_fingerprints(docs).collect()}
    assert len(got) == len(rows)
    want = expected(rows)
    texts = dict(rows)
    by_text = {}
    for i, (n, edited) in want.items():
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 8 * om.TUPLES
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        for text, print_ in ((texts[i] or "", r.fingerprint), (edited, r.edited_fingerprint)):
            assert by_text.setdefault(text, print_) == print_
    order = sorted(got, reverse=True)
    parts = lambda f: [f[k:k + 8] for k in range(0, len(f), 8)]

    def like(a, b):
        filled = [(x, y) for x, y in zip(parts(a), parts(b)) if x != om._EMPTY or y != om._EMPTY]
        return sum(x == y for x, y in filled) / len(filled) if filled else 1.0
    for i, j in zip(order, order[1:] + order[:1]):
        assert got[i].near_next == pytest.approx(like(got[i].fingerprint, got[j].fingerprint))
        assert got[i].near_edited == pytest.approx(like(got[i].fingerprint, got[i].edited_fingerprint))
    far = [r for r in got.values() if r.n_chars > 800 and r.doc_id % 3 == 0]
    assert sum(r.near_edited for r in far) > 3 * sum(r.near_next for r in far)


def test_sensitive_to_edits_and_order(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(5000)}" for _ in range(600)]
    few = list(base)
    for _ in range(6):
        few[rng.randrange(600)] = "edit"
    many = list(base)
    for _ in range(150):
        many[rng.randrange(600)] = f"e{rng.randrange(5000)}"
    blocks = [base[i:i + 60] for i in range(0, 600, 60)]
    moved = [w for b in reversed(blocks) for w in b]
    texts = [base, few, many, moved, base]
    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "i int, text string")
    parts = {r.i: r.parts for r in om.fingerprints(rows, ["i"]).collect()}
    like = lambda i: sum(a == b for a, b in zip(parts[0], parts[i])) / om.TUPLES
    assert like(4) == 1.0
    assert like(1) > 0.8 > like(2)
    # the same k-mers in another order
    assert like(3) < 0.75


def test_ties_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "z y x"), (None, None)], "doc_id long, text string")
    got = om.document_fingerprints(docs).collect()
    assert len(got) == 4 and len({r.fingerprint for r in got if r.doc_id == 1}) == 1
    one = om.document_fingerprints(docs.where("text like 'z%'")).collect()
    assert one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"z yz ").hexdigest()
    assert om.document_fingerprints(docs.where("false")).count() == 0
