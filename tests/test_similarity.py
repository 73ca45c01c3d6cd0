import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratewise.operators import similarity as sim


def _sparse_rows(rng, n, vocab, zero_ids=()):
    rows = []
    for i in range(n):
        if i in zero_ids:
            continue
        terms = rng.choice(vocab, size=rng.integers(1, 6), replace=False)
        for t in terms:
            rows.append((i, f"t{t}", float(rng.integers(1, 4))))
    return rows


def _brute(rows, t, other_rows=None):
    def vecs(rs):
        d = {}
        for i, term, w in rs:
            d.setdefault(i, {})[term] = w
        return d
    a = vecs(rows)
    b = vecs(other_rows) if other_rows is not None else a
    out = {}
    for i, vi in a.items():
        ni = np.sqrt(sum(x * x for x in vi.values()))
        for j, vj in b.items():
            if other_rows is None and i == j:
                continue
            nj = np.sqrt(sum(x * x for x in vj.values()))
            c = sum(vi[k] * vj.get(k, 0.0) for k in vi) / (ni * nj)
            if c > t:
                out[(i, j)] = round(c, 9)
    return out


def test_sparse_self_pairs_exact(spark):
    rng = np.random.default_rng(1)
    rows = _sparse_rows(rng, 60, np.arange(12))
    df = spark.createDataFrame(rows, "id long, term string, w double")
    for t in (0.3, 0.6, 0.9):
        got = {(r.id, r.other): round(r.cos, 9)
               for r in sim.cosine_pairs_sparse(df, None, "id", "other", t).collect()}
        assert got == _brute(rows, t)


def test_sparse_two_sided_and_zero_vector(spark):
    rng = np.random.default_rng(2)
    left = _sparse_rows(rng, 30, np.arange(10)) + [(99, "t1", 0.0)]   # zero vector
    right = _sparse_rows(rng, 40, np.arange(10))
    l = spark.createDataFrame(left, "id long, term string, w double")
    r = spark.createDataFrame(right, "other long, term string, w double")
    got = {(x.id, x.other): round(x.cos, 9) for x in sim.cosine_pairs_sparse(l, r, "id", "other", 0.5).collect()}
    assert got == _brute([x for x in left if x[0] != 99], 0.5, right)
    assert all(i != 99 for i, _ in got)


def test_dense_threshold_multi_block(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(90, 8)).astype(np.float32)
    df = spark.createDataFrame([(int(i), m[i].tolist()) for i in range(90)], "id long, v array<float>")
    got = {(r.a, r.b): round(r.cos, 6)
           for r in sim.cosine_pairs_dense(df, "id", "v", 0.5, block_rows=16).collect()}
    u = m.astype(np.float64) / np.linalg.norm(m.astype(np.float64), axis=1, keepdims=True)
    s = u @ u.T
    want = {(i, j): round(float(s[i, j]), 6) for i in range(90) for j in range(90) if i != j and s[i, j] > 0.5}
    assert got == want


def _rows_of(near, members, k):
    """The k nearest other rows of every row, with those that tie with the k-th."""
    reps = {r.id: r.rep for r in members.collect()}
    group = {}
    for i, rep in reps.items():
        group.setdefault(rep, []).append(i)
    lists = {}
    for r in near.collect():
        lists.setdefault(r.a, []).append((r.cos, r.b))
    out = {}
    for i, rep in reps.items():
        found = [(1.0, j) for j in group[rep] if j != i] + [(c, j) for c, b in lists.get(rep, []) for j in group[b]]
        least = sorted((c for c, _ in found), reverse=True)[:k][-1:]
        out[i] = {(j, c) for c, j in found if c >= least[0]} if found else set()
    return out


def _brute_rows(m, k):
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    out = {}
    for i in range(len(m)):
        rest = sorted(((s[i, j], j) for j in range(len(m)) if j != i), reverse=True)
        out[i] = {(j, c) for c, j in rest if c >= rest[k - 1][0]}
    return out


def test_dense_nearest_k(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(50, 6))
    df = spark.createDataFrame([(int(i), m[i].tolist()) for i in range(50)], "id long, v array<double>")
    got = _rows_of(*sim.nearest_dense(df, "id", "v", 3, block_rows=8), 3)
    want = _brute_rows(m, 3)
    assert {i: {j for j, _ in x} for i, x in got.items()} == {i: {j for j, _ in x} for i, x in want.items()}


@pytest.mark.parametrize("block_rows", [96, 48, 12])
def test_dense_nearest_k_with_many_equal_vectors(spark, block_rows):
    """Few vectors, one of a third of the rows: the same result from 1, 2 and 8 blocks, and rows per vector only."""
    rng = np.random.default_rng(5)
    kinds = rng.normal(size=(12, 6))
    m = kinds[np.where(np.arange(96) % 3 == 0, 0, rng.integers(1, 12, size=96))]
    df = spark.createDataFrame([(int(i), m[i].tolist()) for i in range(96)], "id long, v array<double>")
    near, members = sim.nearest_dense(df, "id", "v", 4, block_rows=block_rows)
    assert near.count() == 12 * 4 and members.count() == 96
    got, want = _rows_of(near, members, 4), _brute_rows(m, 4)
    assert all({j for j, _ in got[i]} == {j for j, _ in want[i]} for i in range(96))


def _clusters(n, seed=6, d=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    return np.concatenate([centres[np.arange(n) % 6] + rng.normal(size=(n, d)) * 0.15, np.zeros((1, d))])


@pytest.mark.parametrize("block_rows", [400, 60, 20])
def test_dense_pruning_skips_pairs_and_loses_none(spark, block_rows):
    m = _clusters(200)
    df = spark.createDataFrame([(int(i), m[i].tolist()) for i in range(len(m))], "id long, v array<double>")
    u = m[:200] / np.linalg.norm(m[:200], axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    skipped, topk = {}, {}
    got = {(r.a, r.b): round(r.cos, 6) for r in sim.cosine_pairs_dense(df, "id", "v", 0.8, block_rows=block_rows, skipped=skipped).collect()}
    assert got == {(i, j): float(s[i, j]) for i in range(200) for j in range(200) if i != j and (u @ u.T)[i, j] > 0.8}
    near = _rows_of(*sim.nearest_dense(df, "id", "v", 3, block_rows=block_rows, skipped=topk), 3)
    want = _brute_rows(m[:200], 3)
    assert all({j for j, _ in near[i]} == {j for j, _ in want[i]} for i in range(200))
    if block_rows == 20:
        assert skipped["skipped"] > 0 and topk["skipped"] > 0


def test_dense_pairs_of_two_tables(spark):
    m = _clusters(120, 8)
    left = spark.createDataFrame([(int(i), m[i].tolist()) for i in range(0, 120, 3)], "x long, v array<double>")
    right = spark.createDataFrame([(int(i), m[i].tolist()) for i in [*range(120), 120]] + [(500, m[3].tolist())], "y long, v array<double>")
    got = {(r.a, r.b) for r in sim.cosine_pairs_dense(left, "x", "v", 0.8, right=right, right_id="y", block_rows=16).collect()}
    u = m[:120] / np.linalg.norm(m[:120], axis=1, keepdims=True)
    want = {(i, j) for i in range(0, 120, 3) for j in range(120) if u[i] @ u[j] > 0.8}
    assert got == want | {(i, 500) for i, j in want if j == 3}


def test_no_dense_rows(spark):
    empty = spark.createDataFrame([], "id long, v array<double>")
    assert sim.cosine_pairs_dense(empty, "id", "v", 0.5).count() == 0
    assert sim.nearest_dense(empty, "id", "v", 3)[0].count() == 0


@pytest.mark.parametrize("block_rows,width", [(1000, 4096), (17, 4096), (17, 7), (1000, 1)])
def test_sparse_blocked_over_blocks_and_slices(spark, block_rows, width):
    rnd = random.Random(9)
    def side(n, key):
        return [(i, f"t{t}", rnd.random() + 0.1, i % 4) for i in range(n) for t in sorted({int(40 * rnd.random() ** 2) for _ in range(rnd.randrange(1, 20))})]
    left, right = side(60, 0), side(45, 1) + [(99, "t0", 0.0, 1)]
    l = spark.createDataFrame([(f"c{i}", t, w, o) for i, t, w, o in left], "cid string, term string, w double, uid int")
    r = spark.createDataFrame([(i, t, w) for i, t, w, _ in right], "mid int, term string, w double")

    def unit(rows):
        out = {}
        for i, t, w, *_ in rows:
            out.setdefault(i, {})[t] = w
        norm = {i: math.sqrt(sum(w * w for w in v.values())) for i, v in out.items()}
        return {i: {t: w / norm[i] for t, w in v.items()} for i, v in out.items() if norm[i]}
    lu, ru = unit(left), unit(right)
    want = {(i, j): sum(x * b.get(t, 0) for t, x in a.items()) for i, a in lu.items() for j, b in ru.items()}
    want = {k: c for k, c in want.items() if c > 0.4}
    got = {(int(x.cid[1:]), x.mid): x.cos for x in sim.cosine_pairs_sparse_blocked(l, r, "cid", "mid", 0.4, block_rows, width).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want) and want
    users = sim.cosine_pairs_sparse_blocked(l, r, "cid", "mid", 0.4, block_rows, width, payload="uid")
    assert sorted((x.uid, x.mid) for x in users.collect()) == sorted((i % 4, j) for i, j in want)


def test_slices_leave_out_what_cannot_reach():
    """Rows whose remaining norm is too small are not multiplied any more."""
    rng = np.random.default_rng(1)
    def block(n):
        rows = []
        for i in range(n):
            t = np.sort(rng.choice(400, size=30, replace=False))
            x = rng.random(30)
            rows.append({"id": str(i), "t": t, "x": x / np.linalg.norm(x)})
        return sim._csr(rows)
    left, right = block(80), block(70)
    dense = []
    for ids, o, t, x in (left, right):
        m = np.zeros((len(ids), 400))
        m[o, t] = x
        dense.append(m)
    full = dense[0] @ dense[1].T
    for threshold in (0.2, 0.5, 0.9):
        a, b, c = sim.sliced_products(left, right, threshold, 16)
        assert set(zip(a.tolist(), b.tolist())) == set(zip(*map(list, np.nonzero(full > threshold))))
        assert np.allclose(c, full[a, b])


def test_sparse_blocks_meet_once_and_go_to_few_cells(spark):
    """Each block of one side meets each of the other once; it is not exchanged once a partner."""
    left = sim.materialize(spark.range(0, 120, 1, 30).withColumnRenamed("id", "x").withColumn("y", F.lit(None).cast("long")))
    right = sim.materialize(spark.range(0, 200, 1, 7).withColumnRenamed("id", "y").select(F.lit(None).cast("long").alias("x"), "y"))
    rows = sim._sparse_cells(left, right).collect()
    cells = {}
    for r in rows:
        cells.setdefault((r.p1, r.p2), ([], []))[r.side].append(r.y if r.side == 0 else r.x)
    met = [(x, y) for held, come in cells.values() for x in come for y in held]
    assert sorted(met) == [(x, y) for x in range(120) for y in range(200)]
    assert len(rows) < 120 * 200 / 4 and max(len(held) for held, _ in cells.values()) <= 2 * sim.HELD_BLOCKS


def test_bound_leaves_out_no_product_over_many_terms():
    """Terms far more than slices: every product over the threshold is found, few pairs pass the bound."""
    rng = np.random.default_rng(5)
    def block(n):
        t = [np.sort(rng.choice(50_000, size=40, replace=False)) for _ in range(n)]
        for i in range(0, n, 7):
            t[i] = np.unique(np.concatenate([np.arange(30), t[i][:10] + 30]))
        x = [rng.normal(size=len(v)) + (np.arange(len(v)) < 30) * 2 for v in t]
        return sim._csr([{"id": str(i), "t": v, "x": w / np.linalg.norm(w)} for i, (v, w) in enumerate(zip(t, x))])
    left, right = block(90), block(80)
    dense = []
    for ids, o, t, x in (left, right):
        m = np.zeros((len(ids), 50_031))
        m[o, t] = x
        dense.append(m)
    full = dense[0] @ dense[1].T
    a, b, c = sim.sliced_products(left, right, 0.4, 512)
    assert set(zip(a.tolist(), b.tolist())) == set(zip(*map(list, np.nonzero(full > 0.4)))) and len(a) > 20
    assert np.allclose(c, full[a, b])
    bound = sim.slice_norms(left, 512, 50_031) @ sim.slice_norms(right, 512, 50_031).T
    assert (bound > np.abs(full) - 1e-5).all() and (bound > 0.4).mean() < 0.2


def test_zero_vector_never_similar(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (2, "a", 1.0), (3, "a", 2.0)], "id long, term string, w double")
    got = sim.cosine_pairs_sparse(df, None, "id", "other", 0.6).where(F.col("id") == 1).count()
    assert got == 0


def test_hashed_item_similarity_equals_all_pairs(spark):
    """Content pairs on hashed vectors, against the features of every item."""
    from pyspark.ml.functions import vector_to_array

    from ratewise.operators import text
    from ratewise.plans import content
    from ratewise.sources.fixtures import Fixtures
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    toks = text.category_tokens(fx.items()).groupBy("mid").agg(F.collect_list("token").alias("toks"))
    rows = text.hashed_tfidf(toks, "mid", "toks", content.HASHED_FEATURES).select("mid", vector_to_array("features").alias("x")).collect()
    ids, m = [r.mid for r in rows], np.array([r.x for r in rows])
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = u @ u.T
    got = {(r.mid, r.other): r.cos for r in content.hashed_item_similarity(fx).collect()}
    want = {(ids[i], ids[j]): s[i, j] for i in range(len(ids)) for j in range(len(ids)) if i != j and s[i, j] > 0.6 + 1e-9}
    near = {(ids[i], ids[j]) for i in range(len(ids)) for j in range(len(ids)) if i != j and abs(s[i, j] - 0.6) <= 1e-9}
    assert got.keys() - near == want.keys() - near and all(abs(got[k] - want[k]) < 1e-6 for k in want if k in got)


def test_a_wide_grid_of_sparse_blocks_comes_in_rounds(spark, monkeypatch):
    """However many blocks there are, a round exchanges a block of the left side a fixed number of times; all
    rounds together give the pairs of one."""
    rng = random.Random(3)
    rows = [(i, f"t{t}", rng.random() + 0.1) for i in range(90) for t in rng.sample(range(30), 6)]
    l = spark.createDataFrame([(f"c{i}", t, w) for i, t, w in rows if i < 40], "cid string, term string, w double")
    r = spark.createDataFrame([(i, t, w) for i, t, w in rows if i >= 40], "mid int, term string, w double")

    def pairs():
        return sorted((x.cid, x.mid, round(x.cos, 9)) for x in sim.cosine_pairs_sparse_blocked(l, r, "cid", "mid", 0.4, 3, 64).collect())
    copies, cells = [], sim._sparse_cells

    def seen(left, right, *more):
        out = cells(left, right, *more)
        copies.append(out.where("side = 1").count() / left.count())
        return out
    monkeypatch.setattr(sim, "_sparse_cells", seen)
    once = pairs()
    most, rounds = max(copies), len(copies)
    copies.clear()
    monkeypatch.setattr(sim, "HELD_BLOCKS", 1)
    assert pairs() == once and once
    assert len(copies) > rounds == 1 and max(copies) <= most


def test_best_products_equal_brute_force_and_skip_blocks(spark):
    """Largest products with ties, a zero and a long vector, lists left aside, more items than a block; few of the pairs are scored."""
    rng = np.random.default_rng(5)
    items = rng.normal(size=(3000, 4)) * rng.uniform(0.2, 3, (3000, 1))
    items[7], items[8:30] = 0, items[30]
    asked = np.concatenate([rng.normal(size=(60, 4)), items[28:31], np.zeros((1, 4))])
    out = [list(range(k % 3 * 20)) for k in range(len(asked))]
    q = spark.createDataFrame([(k, v.tolist(), o or None) for k, (v, o) in enumerate(zip(asked, out))], "id long, v array<double>, out array<bigint>")
    i = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(items)], "id long, v array<double>")
    for block_rows in (50, 2048):
        got = {}
        for r in sim.best_products(q, i, 6, 0.5, digits=6, block_rows=block_rows).collect():
            got.setdefault(r.id, {})[r["rank"]] = r.item
        for k, v in enumerate(asked):
            scores = items @ v
            best = sorted((-round(float(x), 6), m) for m, x in enumerate(scores) if x > 0.5 and m not in out[k])[:6]
            assert [m for _, m in sorted(got.get(k, {}).items())] == [m for _, m in best]


def test_best_products_read_few_units(spark):
    """Near neighbours on a circle: a query goes to a few of the units only."""
    angle = np.linspace(0, 6.28, 20_000)
    v = np.stack([np.cos(angle), np.sin(angle)], 1)
    units = pd.DataFrame({"unit": range(64), "c": range(64), "band": 0, "far": 0.06, "top": 1.0, "n": 300})
    pivots = np.stack([np.cos(np.arange(64) * 6.28 / 64), np.sin(np.arange(64) * 6.28 / 64)], 1)
    rows = pd.DataFrame({"id": range(1000), "v": list(v[::20]), "out": [np.array([], np.int64)] * 1000,
                         "out_unit": [np.array([], np.int32)] * 1000, "least": 0.9999})
    packs = pd.concat(sim._choose_units(pivots, units, 10, 0.6, False)(iter([rows])))
    assert 1000 <= packs["qid"].map(len).sum() < 4000


def test_rounding_as_sql_does(spark):
    x = np.array([0.1234565, -0.1234565, 0.9999995, 1e-7, 0.5, 2.0000005, 0.12345649999])
    want = [r[0] for r in spark.createDataFrame([(float(a),) for a in x], "x double").select(F.round("x", 6)).collect()]
    assert sim.half_up(x, 6).tolist() == want


def test_item_pairs_are_not_exchanged(spark):
    """Vector pairs meet as member arrays: all pairs of different items, vectors of more members than a row holds among them."""
    n = sim.MEMBERS_A_ROW + 300
    members = spark.range(n + 3).select(F.col("id").cast("int").alias("mid"), F.when(F.col("id") < n, "a").otherwise("b").alias("vkey"))
    pairs = spark.createDataFrame([("a", "b", 0.7), ("b", "a", 0.7), ("a", "a", 1.0), ("b", "b", 1.0)], "vkey string, okey string, cos double")
    arrays = sim.member_arrays(members, "vkey", "mid", "ms").select(F.size("ms").alias("n")).collect()
    assert len(arrays) == 3 and max(r.n for r in arrays) <= sim.MEMBERS_A_ROW
    out = sim.expand_vector_pairs(pairs, members, "vkey", "mid", "okey", "other")
    got = out.groupBy("cos").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("mid", "other").alias("d"), F.sum((F.col("mid") == F.col("other")).cast("int")).alias("same"))
    want = {0.7: 2 * 3 * n, 1.0: n * (n - 1) + 6}
    assert {r.cos: r.n for r in got.collect()} == {r.cos: r.d for r in got.collect()} == want
    assert all(r.same == 0 for r in got.collect())


def test_dense_pairs_are_made_where_they_are_found(spark):
    """Classes of more members than an array holds, small blocks: all pairs of different ids once, and after the
    kernel nothing is exchanged or joined."""
    n = sim.MEMBERS_A_ROW + 200
    rows = [(i, [1.0, 0.0]) for i in range(n)] + [(n, [0.9, 0.1]), (n + 1, [2.7, 0.3]), (n + 2, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    out = sim.cosine_pairs_dense(df, "id", "v", 0.5, block_rows=2)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan[:plan.index("MapInArrow")] and "Repartition" not in plan[:plan.index("MapInArrow")]
    got = out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("a", "b").alias("d"), F.sum((F.col("a") == F.col("b")).cast("int")).alias("same"),
                  F.count_if(F.col("cos") == 1.0).alias("ones")).first()
    assert got.n == got.d == n * (n - 1) + 2 * 2 * n + 2 and got.same == 0 and got.ones >= n * (n - 1) + 2


def test_dense_blocks_are_copied_as_often_as_the_grid_is_wide(spark):
    """Four times the blocks are four times the exchanged rows, not sixteen times."""
    def copies(n):
        blocks = spark.range(n).select(F.col("id").cast("int").alias("c"), F.lit(0).alias("s"))
        rows = sim._cells(blocks, blocks, True).collect()
        met = {}
        for r in rows:
            met.setdefault((r.p1, r.p2), ([], []))[r.side].append(r.c)
        pairs = [tuple(sorted((x, y))) for (p1, p2), (held, come) in met.items() for x in come for y in held if p1 != p2 or x <= y]
        assert sorted(pairs) == [(x, y) for x in range(n) for y in range(x, n)]  # each unordered pair meets once
        return len(rows)
    assert copies(80) <= 2.5 * copies(40)


def test_expanded_texts_meet_synonyms_once(spark):
    """Distinct own terms and synonyms of each text, sorted; null keys and terms without synonyms among them,
    and no second copy of the terms for their synonyms."""
    from ratewise.plans import content
    terms = spark.createDataFrame([(1, "b"), (1, "b"), (1, "z"), (2, "a"), (None, "b")], "mid int, term string")
    syn = spark.createDataFrame([("b", "c", 1), ("b", "a", 2), ("b", "d", 3), ("a", "b", 1)], "word string, syn string, rank long")
    sets = content.expanded_sets(terms, ["mid"], syn, 2)
    assert {r.mid: r.t for r in sets.collect()} == {1: ["a", "b", "c", "z"], 2: ["a", "b"], None: ["a", "b", "c"]}
    rows = content.expanded(terms, ["mid"], syn, 1)
    assert sorted((r.mid or 0, r.term) for r in rows.collect()) == [(0, "b"), (0, "c"), (1, "b"), (1, "c"), (1, "z"), (2, "a"), (2, "b")]
    assert "Union" not in rows._jdf.queryExecution().optimizedPlan().toString()
