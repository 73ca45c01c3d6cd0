"""Merkle manifest against a plain tree, at block sizes that give several butterfly rounds."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from ratewise.llm import merkle

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, sid string, pos string"


def _h(s):
    return sha256(s.encode()).hexdigest()


def _leaf(r, text):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return _h("".join(field(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def _tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([_h("".join(low[i:i + 16])) for i in range(0, len(low), 16)])
    return levels


def _path(levels, i):
    out = []
    for low in levels[:-1]:
        run = i - i % 16
        out.append((low[run:i], low[i + 1:run + 16]))
        i //= 16
    return out


def naive(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r["source"], []).append((r["doc_id"] if r["doc_id"] is not None else -10**18, _leaf(r, r["text"]), r))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    inner = {}
    for s in order:
        trees[s].sort(key=lambda x: x[:2])
        inner[s] = _tree([x[1] for x in trees[s]])
    top = _tree([inner[s][-1][0] for s in order])
    root, out = top[-1][0], []
    for k, s in enumerate(order):
        for i, (_, leaf, r) in enumerate(trees[s]):
            path = _path(inner[s], i) + _path(top, k)
            now = leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                now = _leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]))
            for before, after in path:
                now = _h("".join(before) + now + "".join(after))
            proof = _h("".join(x for before, after in path for x in before + after))
            out.append((r["doc_id"], leaf, inner[s][-1][0], root, proof, now, now == root))
    return out


def _found(df):
    return [tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


def _rows(sizes):
    rows, i = [], 0
    for source, n in sizes:
        for _ in range(n):
            rows.append(dict(doc_id=i * 7 % 100_003, text=f"Text {i} ÄÖ é" if i % 3 else "plain", lang="en", source=source, n_chars=i, sid="x", pos="y"))
            i += 1
    return rows


def _key(r):
    return (r[0] is not None, r[0] or 0, *r[1:])


@pytest.mark.parametrize("levels", [1, 2])
def test_equals_a_plain_tree(spark, levels):
    rows = _rows([("b", 1), ("a", 16), (None, 17), ("é", 300), ("hot", 4500), ("", 257)] + [(f"s{i}", 1 + i % 3) for i in range(40)])
    rows += [dict(doc_id=None, text=None, lang=None, source=None, n_chars=None, sid=None, pos=None)] * 2
    rows += [dict(rows[5]), dict(rows[5]), dict(rows[400], text="another text of the same id"), dict(rows[6], text="Long " * 300_000)]
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], SHAPE).repartition(7)
    got = _found(merkle.manifest(docs, merkle.tampered(F.col("doc_id")), levels=levels, proofs=False))
    assert sorted(got, key=_key) == sorted(naive(rows), key=_key)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 258, 273, 4097])
def test_sizes_at_the_edges(spark, n):
    rows = _rows([("one", n)])
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], SHAPE)
    assert sorted(_found(merkle.manifest(docs, merkle.tampered(F.col("doc_id")), levels=1, proofs=False))) == sorted(naive(rows))


def test_proofs_lead_to_the_root_and_tampering_shows(spark):
    docs = spark.createDataFrame([tuple(r.values()) for r in _rows([("a", 40), ("b", 3)])], SHAPE)
    rows = merkle.manifest(docs, merkle.tampered(F.col("doc_id"))).collect()
    for r in rows:
        assert merkle.fold_up(r["leaf"], [(p["before"], p["after"]) for p in r["proof"]]) == r["root"]
        assert r["proof_sha256"] == _h("".join(p["before"] + p["after"] for p in r["proof"]))
    assert {r["verified"] for r in rows} == {True, False}


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SHAPE)).collect() == []
