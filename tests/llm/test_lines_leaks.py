"""Line dedup and benchmark decontamination against brute force."""

import random
from collections import Counter

import pytest

from ratewise.llm import decontaminate, line_dedup


def words(t):
    return t.lower().encode().split()


def shingle_list(w, k=5):
    return [tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []


def brute_lines(rows):
    """(id, kept text) by comparing every line with all earlier ones; ids must differ."""
    lines = [(i, k, frozenset(shingle_list(words(x)))) for i, t in sorted(r for r in rows if r[1] is not None) for k, x in enumerate(t.split("\n"))]
    gone = set()
    for at, (i, k, s) in enumerate(lines):
        if s and any(e and 100 * len(s & e) >= 80 * len(s | e) for _, _, e in lines[:at]):
            gone.add((i, k))
    return {i: (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)) for i, t in rows}


def line_corpus(seed):
    rng = random.Random(seed)
    some = lambda n: [f"v{rng.randrange(300)}" for _ in range(n)]
    family, rows = some(40), []
    for i in range(80):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.randrange(6)
            if kind == 0:
                w = list(family)
                for _ in range(rng.randrange(0, 3)):
                    w[rng.randrange(len(w))] = f"e{rng.randrange(30)}"
            elif kind == 1:
                w = ["the", "common", "line", "of", "all", "documents"][:rng.randrange(1, 7)]
            elif kind == 2:
                w = []
            else:
                w = some(rng.choice([1, 3, 8, 20, 60]))
            lines.append((" " * rng.randrange(3)).join(["", " ".join(w).title() if kind == 1 else " ".join(w)]))
        rows.append((i, "\n".join(lines)))
    rng.shuffle(rows)
    return rows


def test_only_lines_that_can_be_similar_are_verified(spark, monkeypatch):
    """Lines that share most of a passage but lie clearly under the threshold leave no shingle set; near copies do."""
    rng = random.Random(5)
    rows, verified, keep = [], [], line_dedup.Scratch.keep
    for i in range(40):
        w = [f"w{rng.randrange(10**6)}" for _ in range(54)]
        rows += [(3 * i, " ".join(w)), (3 * i + 1, " ".join(w[:44] + [f"x{rng.randrange(10**6)}" for _ in range(10)]))]
        if i < 4:
            rows.append((3 * i + 2, " ".join(w[:53] + ["end"])))

    def counted(self, df, name, release=True):
        out = keep(self, df, name, release)
        if name == "sets":
            verified.append(out.count())
        return out
    monkeypatch.setattr(line_dedup.Scratch, "keep", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.clean_lines(docs).collect()}
    assert got == brute_lines(rows) and sum(t == "" for t in got.values()) == 4
    assert 8 <= sum(verified) <= 16  # 84 lines share shingles with another
    assert line_dedup._filter_bits(10) == line_dedup.FILTER_BITS < line_dedup._filter_bits(2 * 10**6) <= line_dedup.FILTER_BITS + 4


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_equal_brute_force(spark, seed):
    rows = line_corpus(seed) + [(900, None), (901, ""), (902, "\n\n"), (903, "a very long line " * 3000)]
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, h string, n int").repartition(3)
    got = line_dedup.clean_lines(docs).collect()
    want = brute_lines(rows)
    assert {r.doc_id: r.text for r in got} == want and len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        assert r.n_lines == (0 if texts[r.doc_id] is None else len(texts[r.doc_id].split("\n")))
    assert {r.h for r in got} == {"x"}


def test_lines_ties_and_empty(spark):
    docs = spark.createDataFrame([(1, "one two\nthree"), (1, "one two\nthree"), (None, "three"), (2, "ONE two \nnew")], "doc_id long, text string")
    got = sorted(str((r.doc_id, r.text, r.n_lines, r.n_removed)) for r in line_dedup.clean_lines(docs).collect())
    assert got == sorted(map(str, [(1, "one two", 2, 1), (1, "one two", 2, 1), (None, "three", 1, 0), (2, "new", 2, 1)]))
    assert line_dedup.clean_lines(docs.where("false")).count() == 0


def brute_leaks(rows, items):
    found = {}
    for i, t in rows:
        w = words(t or "")
        for j, x in items:
            v = words(x or "")
            if not w or not v:
                continue
            if len(v) < 5:
                if v == w:
                    found[(i, j)] = 1.0
                continue
            own, size = Counter(shingle_list(v)), min(len(v), len(w))
            for s in range(len(w) - size + 1):
                c = Counter(shingle_list(w[s:s + size]))
                both, union = sum((c & own).values()), sum((c | own).values())
                if 100 * both >= 80 * union:
                    found[(i, j)] = max(found.get((i, j), 0), both / union)
    return found


def test_leaks_equal_brute_force(spark):
    rng = random.Random(4)
    some = lambda n: [f"v{rng.randrange(400)}" for _ in range(n)]
    items = [(j, " ".join(some(rng.choice([3, 12, 14, 25, 40])))) for j in range(30)] + [(90, None), (91, " "), (92, "a a a a a a a a a a a a")]
    items += [(93, items[5][1]), (None, items[6][1])]
    rows = []
    for i in range(150):
        w = some(rng.randrange(0, 150))
        if i % 2:
            leak = items[rng.randrange(30)][1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                leak[rng.randrange(len(leak))] = "edit"
            if i % 3 == 0:
                leak = [x.upper() for x in leak]
            at = rng.randrange(len(w) + 1)
            w[at:at] = leak
        rows.append((i, (" " if i % 5 else "\n ").join(w)))
    rows += [(700, None), (701, ""), (702, "a " * 40), (705, items[4][1]), (703, " ".join(items[7][1].split()[:-1])), (704, "long text " * 30_000)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, item int").repartition(4)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs, table).collect()}
    want = brute_leaks(rows, items)
    assert got == pytest.approx(want)
    clean = decontaminate.clean_documents(docs, table)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - {i for i, _ in got}


def leaks(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    table = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs, table).collect()}


def test_reordered_items_equal_brute_force(spark):
    rng = random.Random(6)
    some = lambda n: [f"v{rng.randrange(900)}" for _ in range(n)]
    parts = [[some(n) for _ in range(k)] for n, k in [(25, 2), (30, 2), (40, 3), (40, 4), (28, 3), (60, 2)] * 4]
    items = [(j, " ".join(w for p in ps for w in p)) for j, ps in enumerate(parts)]
    rows = []
    for j, ps in enumerate(parts):
        w = [w for p in ps[1:] + ps[:1] for w in p]  # every part moved
        rows.append((j, " ".join(some(rng.randrange(40)) + w + some(rng.randrange(40)))))
    want = brute_leaks(rows, items)
    assert (0, 0) in want and len(want) > 15
    assert leaks(spark, rows, items) == pytest.approx(want)


def test_repeated_shingles_equal_brute_force(spark):
    rng = random.Random(7)
    some = lambda n: [f"v{rng.randrange(9000)}" for _ in range(n)]
    texts = [some(136) for _ in range(20)]
    # a row of blanks in the item, one shingle twelve times, that the document has filled in
    items = [(j, " ".join(w + ["_"] * 16)) for j, w in enumerate(texts)]
    rows = [(j, " ".join(some(rng.randrange(9)) + w + some(16))) for j, w in enumerate(texts)]
    want = brute_leaks(rows, items)
    assert len(want) == 20
    assert leaks(spark, rows, items) == pytest.approx(want)


def test_leaks_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text of five words here"), (None, "some text of five words here")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "some text of five words here")], "item_id long, text string")
    assert decontaminate.contaminated(docs, items.where("false")).count() == 0
    assert decontaminate.contaminated(docs.where("false"), items).count() == 0
    assert decontaminate.contaminated(docs, items).count() == 2
    assert decontaminate.clean_documents(docs, items).count() == 0
