"""Hard negatives against scoring every pair."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import hard_negatives as hn

SHAPE = "vec_id long, embedding array<float>, label int, at string, id string, block string"


def naive(rows, every=100):
    def whole(v):
        return [max(-2**27, min(2**27, math.floor(256 * float(np.float32(x))))) for x in v]
    use = []
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((i, whole(v), (y + 1) % 10 if i % 7 == 0 else y))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for k, (i, v, y) in enumerate(use):
        if i % every:
            continue
        ranked = sorted((-dot(v, w), j) for n, (j, w, z) in enumerate(use) if n != k and z == y)[:5]
        others = sorted((-dot(v, w), j) for j, w, z in use if z != y)
        for s, p in ranked:
            fit = [(j, -t) for t, j in others if 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(i, p, r + 1, j, -s, t) for r, (j, t) in enumerate(fit)]
    return sorted(out)


def run(spark, rows, parts=5, **kw):
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SHAPE).repartition(parts)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hn.hard_negatives(df, F.col("id") % 100 == 0, label, **kw)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def _vectors(n, d, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, d))
    return [(centres[i % 6] * 0.1 + r.normal(size=d) * 0.06).astype(np.float32).tolist() for i in range(n)]


@pytest.mark.parametrize("block,slab", [(10_000, 512), (60, 3)])
def test_equals_every_pair(spark, block, slab):
    vs = _vectors(900, 12, 1)
    rnd = random.Random(2)
    rows = [(i, v, rnd.randrange(10)) for i, v in enumerate(vs)]
    same = vs[0]
    rows += [(1000 + i, same, i % 3) for i in range(150)]             # many equal vectors, ties by id
    rows += [(100, vs[7], 4), (100, vs[7], 4), (200, vs[8], 1)]        # repeated rows and ids
    rows += [(None, same, 1), (2000, None, 1), (2100, same, None), (2200, [0.1, None], 2), (2300, [float("nan")] * 12, 2),
             (2400, [float("inf")] + same[1:], 2), (2500, [], 3), (2600, [0.5, 0.25], 3), (2700, [0.0] * 12, 3), (2800, [3e38, -3e38], 0), (-700, same, 9)]
    rnd.shuffle(rows)
    assert run(spark, rows, block=block, slab=slab) == naive(rows)


def test_one_label_one_row_and_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(100, [1.0], 1)]) == []
    assert run(spark, [(100, [1.0], 1), (101, [0.9], 1)]) == []
    rows = [(100, [1.0], 1), (101, [1.0], 1), (102, [0.8], 2), (103, [0.79], 2), (104, [1.0], 3)]
    assert run(spark, rows) == naive(rows) != []


def test_search_stops_early_and_is_whole():
    """Where few rows score high, the search ends before the lists do, with the same result."""
    r = np.random.default_rng(3)
    m = r.integers(-20, 20, size=(5000, 8))
    anchor = r.integers(-100, 100, size=8)
    m[17] = np.sign(anchor) * 400
    m[18] = np.sign(anchor) * 390
    lists = hn.SortedLists(m)
    (best,), score, depth = lists.search(anchor, np.ones(5000, bool), np.arange(5000), 2, [(None, None)])
    assert best.tolist() == [17, 18] and depth < 5000
    assert score[best].tolist() == (m[best] @ anchor).tolist()
