"""N-gram Jaccard join of documents with prefix trees.

A document is the set of its distinct word n-grams.  Two documents link when
``100 * |A & B| >= percent * |A | B|``; documents with the same set are one
class and never compared.  The classes that links connect form components.

1.  Order.  A counting sketch of fixed size (``SKETCH`` counters, summed over
    all tasks) gives every n-gram a rarity; (rarity, hash) is one global order.
    The order decides only how much work there is, so a sketch will do.
2.  Candidates.  Two sets can link only if they share one of the rarest
    ``n - ceil(n * percent / 100) + 1`` n-grams of each.  These prefixes are
    dealt out by n-gram; an n-gram of one class alone is dropped.
    So is what passes the length and position filters with no other.
3.  Rounds.  In each group of classes that share a prefix n-gram, everyone has
    one hub of a fitting size and another label (the most shared one, then the
    smallest, then again the most shared one); each class is paired with the most shared of its
    hubs, the pairs are verified, and links merge labels.  An edit makes n-grams of
    its own, so in a family of edited copies the text that they come from has the largest
    share of prefix n-grams in common with others: it is their hub, and links with them even
    where they don't link with each other.  The last round
    pairs all that share an n-gram but still have different labels, by length
    and position filters and the sketches (see 4).  A group of thousands of near copies costs one pair
    a member, because its members have one label after the first round; no
    pair that could join two components is left out.
4.  Verification.  A sketch of each set, how many of its n-grams begin with each byte,
    bounds the overlap of a pair from above; only pairs that can link read their sets.  The
    sets paired with one hub are stored, a bounded number at
    a time, in a trie along the global order (most common first, so that near
    copies share paths).  One walk counts the overlap with the hub for all of
    them: a path's count is shared by everything below it, and a subtree ends
    where the remaining lengths can't reach the needed overlap.

Sets are made from 64-bit n-gram hashes.  Texts are scanned three times rather
than stored again: for order and classes, for prefixes, and for the sets of the
classes that have a candidate (a bitmap of fixed size says which).  The sets are
stored in buckets by class, so no round shuffles them for its join.

Defined results: a null text, or one without words, has no n-gram, size 0, and
links with nothing; a text of fewer words than n is one n-gram; equal texts
link if they have a word; ids may be null or repeated (rows are kept one to
one, a component's id is its smallest id that isn't null); a very long text is read whole,
its set goes through one task at a time; an empty table gives an empty result; further columns
may have any name."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import Scratch, bitmap_of, hashed_words, in_bitmap, kernel, shingle_hashes, text_groups, written
from ratewise.llm.components import merged

SKETCH_BITS = 20
SEGMENT = 1 << 13
FILTER_BITS = 24
GROUP_BYTES = 2 << 20
TRIE_SETS = 256
SMALL_GROUP = 64
BUCKETS = 64


def _sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """The sorted n-gram set of each text; n-grams are hashed for all texts together."""
    flat, counts = hashed_words(texts, lower=True)
    grams = shingle_hashes(flat, n) if len(flat) >= n else flat[:0]
    out, at = [], 0
    for k in counts.tolist():
        own = np.sort(grams[at:at + k - n + 1] if k >= n else shingle_hashes(flat[at:at + k], n))
        out.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) > 1 else own)
        at += k
    return out


def _classes(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit name of each set."""
    import xxhash
    return np.array([xxhash.xxh3_64_intdigest(s.tobytes(), 7) for s in sets], np.uint64).view(np.int64)


def _counter(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _rare_first(s: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The set in the global order: by rarity, then by hash."""
    return s[np.argsort((rank[_counter(s)].astype(np.uint64) << np.uint64(53)) | (s >> np.uint64(11)), kind="stable")]


def prefix_length(n: int, percent: int) -> int:
    return n + (-n * percent) // 100 + 1


def needed_overlap(a, b, percent: int):
    """Smallest overlap at which sets of sizes a and b link."""
    return -(-percent * (a + b) // (100 + percent))


def walk_trie(query: list[int], records: list[list[int]], percent: int) -> list[int]:
    """Indices of the records that link with the query; all lists follow one global order.

    The trie is the sorted list of the records: those that share a path are
    neighbours, and the path's overlaps with the query, kept by depth, serve
    them all.  A record is left, and with it every one below the same node, at
    the depth where the lengths that remain can't reach the needed overlap."""
    at = {x: i + 1 for i, x in enumerate(query)}.get
    nq, found = len(query), []
    overlaps, passed = [0], [0]  # along the current path, by depth
    path: list[int] = []
    for i in sorted(range(len(records)), key=records.__getitem__):
        rec = records[i]
        size = len(rec)
        need = needed_overlap(nq, size, percent)
        spare, spare_q = size - need, nq - need  # what may be missed on either side
        depth, known = 0, min(len(overlaps) - 1, size)
        while depth < known and path[depth] == rec[depth]:
            depth += 1
        del overlaps[depth + 1:], passed[depth + 1:]
        path = rec
        o, p = overlaps[depth], passed[depth]
        while depth < size and depth - o <= spare and p - o <= spare_q:
            q = at(rec[depth])
            if q:
                o, p = o + 1, q
            depth += 1
            overlaps.append(o)
            passed.append(p)
        if depth == size and o >= need:
            found.append(i)
    return found


def _run_pairs(rows: tuple[np.ndarray, ...], percent: int, mode: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate pairs within one group (sorted by size): (hub, class, the hub's share); in mode
    "all" the sketches stand in the place of the shares, and only pairs that they let through."""
    cls, size, pos, label, share = rows
    if (label == label[0]).all():
        return cls[:0], cls[:0], share[:0]
    left, right, weight = [], [], []
    if mode != "all":
        at = 0
        while at < len(cls):
            stop = int(np.searchsorted(size * percent, 100 * size[at], side="right"))  # sizes that fit the smallest
            hub = at + int(share[at:stop].argmax()) if mode == "shared" else at
            big, small = np.maximum(size[at:stop], size[hub]), np.minimum(size[at:stop], size[hub])
            bound = 1 + np.minimum(size[at:stop] - pos[at:stop], size[hub] - pos[hub])
            ok = (label[at:stop] != label[hub]) & (100 * small >= percent * big) & (bound >= needed_overlap(size[at:stop], size[hub], percent))
            right.append(cls[at:stop][ok])
            left.append(np.full(len(right[-1]), cls[hub]))
            weight.append(np.full(len(right[-1]), share[hub]))
            at = stop
        return np.concatenate(left), np.concatenate(right), np.concatenate(weight)
    start = np.searchsorted(100 * size, percent * size, side="left")
    for i in range(1, len(cls)):
        j = slice(start[i], i)
        bound = 1 + np.minimum(size[j] - pos[j], size[i] - pos[i])
        ok = (label[j] != label[i]) & (bound >= needed_overlap(size[j], size[i], percent))
        at = start[i] + np.flatnonzero(ok)
        for part in np.split(at, range(4096, len(at), 4096)) if len(at) else ():
            fit = part[may_link(share[part], np.broadcast_to(share[i], (len(part), 256)), percent)]
            left.append(cls[fit])
            right.append(np.full(len(fit), cls[i]))
    none = [cls[:0]]
    a, b = np.concatenate(left or none), np.concatenate(right or none)
    return a, b, np.zeros(len(a))


def _with_partner(b: pa.RecordBatch, percent: int) -> pa.RecordBatch:
    """Rows (sorted by h, n) that pass the length and position filters with another
    row of their n-gram; groups over SMALL_GROUP rows are kept as they are."""
    h, n, pos = (b.column(c).to_numpy() for c in ("h", "n", "pos"))
    run = np.cumsum(np.concatenate([[False], h[1:] != h[:-1]]))
    keep = np.bincount(run)[run] > SMALL_GROUP
    for d in range(1, SMALL_GROUP):
        i = np.flatnonzero((run[d:] == run[:-d]) & ~(keep[d:] & keep[:-d])) if d < len(run) else run[:0]
        if not len(i):
            break
        j = i + d
        bound = 1 + np.minimum(n[i] - pos[i], n[j] - pos[j])
        ok = (100 * n[i] >= percent * n[j]) & (bound >= needed_overlap(n[i], n[j], percent))
        keep[i[ok]] = keep[j[ok]] = True
    return b.filter(pa.array(keep))


def _pairs(batches: Iterator[pa.RecordBatch], percent: int, mode: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h, n, cls); the group at the end of a batch waits for the next.  Of a
    class's hubs in a batch the most shared one leaves the task."""
    names = ["cls", "n", "pos", "label"]

    def last(batch: pa.RecordBatch) -> np.ndarray:
        if mode == "all":
            return np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, 256)
        return batch.column("share").to_numpy()

    def out(runs) -> pa.RecordBatch:
        found = [_run_pairs(r, percent, mode) for r in runs if len(r[0]) > 1]
        a, b, w = (np.concatenate([f[i] for f in found] or [np.empty(0, t)]) for i, t in enumerate((np.int64, np.int64, float)))
        if mode == "all":  # either end may be the hub of the walk
            a, b = np.minimum(a, b), np.maximum(a, b)
            order = np.lexsort((a, b))
            new = np.flatnonzero(np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])) if len(a) else order
            keep = order[new]
        else:
            best = np.lexsort((a, w, b))
            keep = best[np.flatnonzero(np.concatenate([b[best][1:] != b[best][:-1], [True]]))] if len(b) else best
        return pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep]), pa.array(w[keep])], ["a", "b", "share"])

    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column("h").to_numpy()
        cols = [h, *(batch.column(c).to_numpy() for c in names), last(batch)]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        cut = np.flatnonzero(np.concatenate([[True], cols[0][1:] != cols[0][:-1]]))
        runs = [tuple(c[i:j] for c in cols[1:]) for i, j in zip(cut[:-1], cut[1:])]
        held = [c[cut[-1]:] for c in cols]
        if runs:
            yield out(runs)
    if held is not None:
        yield out([tuple(held[1:])])


def sketch(s: np.ndarray) -> bytes:
    """How many n-grams of a set begin with each byte; 255 stands for as many or more."""
    return np.minimum(np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=256), 255).astype(np.uint8).tobytes()


def may_link(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sketches (rows of 256) can belong to sets that link: two sets share, of
    each first byte, at most the smaller number.  True where a number isn't known."""
    unknown = (a == 255).any(axis=1) | (b == 255).any(axis=1)
    a, b = a.astype(np.int64), b.astype(np.int64)
    return unknown | (np.minimum(a, b).sum(axis=1) >= needed_overlap(a.sum(axis=1), b.sum(axis=1), percent))


def _fitting(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose sketches (sa, sb) may link."""
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            sa, sb = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(-1, 256) for c in ("sa", "sb"))
            yield part.select(["a", "b"]).filter(pa.array(may_link(sa, sb, percent)))


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, chunk, b), the hub's own set (b null) first."""
    at, query, names, records = None, None, [], []

    def flush() -> pa.RecordBatch:
        hit = [names[i] for i in walk_trie(query, records, percent)] if records else []
        return pa.RecordBatch.from_arrays([pa.array([at[0]] * len(hit), pa.int64()), pa.array(hit, pa.int64())], ["a", "b"])

    for batch in batches:
        for start in range(0, batch.num_rows, 256):  # sets become Python lists few at a time
            part = batch.slice(start, 256)
            for a, chunk, b, grams in zip(*(part.column(c).to_pylist() for c in ("a", "chunk", "b", "grams"))):
                if (a, chunk) != at:
                    if records:
                        yield flush()
                    at, names, records = (a, chunk), [], []
                if b is None:
                    query = grams
                    continue
                names.append(b)
                records.append(grams)
                if len(records) >= TRIE_SETS:
                    yield flush()
                    names, records = [], []
    if records:
        yield flush()


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    spark = kernel(docs)
    with Scratch(spark, "ngram-join") as tmp:
        return written(_components_of(docs, n, percent, id_col, text_col, tmp), "ngram-components")


def _components_of(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str, tmp: Scratch) -> DataFrame:
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def first_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int32)
        names = ["doc_id", "n", "cls", "segment", "counts"]
        none, id_type = pa.list_(pa.int32()), None
        for b in text_groups(batches, "text", GROUP_BYTES):
            sets = _sets(b.column("text").to_pylist(), n)
            ids, id_type = b.column("doc_id"), b.column("doc_id").type
            counts += np.bincount(_counter(np.concatenate(sets)), minlength=len(counts)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(_classes(sets)),
                                              pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), none)], names)
        for k, part in enumerate(counts.reshape(-1, SEGMENT)):
            if id_type is not None and part.any():
                yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([k], pa.int32()),
                                                  pa.array([part], none)], names)

    scanned = tmp.keep(src.mapInArrow(first_scan, f"doc_id {kind}, n long, cls long, segment int, counts array<int>"), "ngram-scan")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column("segment").to_pylist(), b.column("counts")):
                total[k] = total.get(k, 0) + c.values.to_numpy().astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.int64()))], ["segment", "counts"])

    segments = (scanned.where("segment is not null").select("segment", "counts").repartition("segment")
                       .mapInArrow(add, "segment int, counts array<long>"))
    counts = np.zeros((1 << SKETCH_BITS) // SEGMENT * SEGMENT, np.int64).reshape(-1, SEGMENT)
    for r in segments.collect():  # at most 2 ** SKETCH_BITS numbers
        counts[r["segment"]] = r["counts"]
    # steps of 2 percent, up to 2 ** 64
    rarity = spark.sparkContext.broadcast(np.round(32 * np.log2(counts.ravel() + 1.0)).astype(np.uint16))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = rarity.value
        for b in text_groups(batches, "text", GROUP_BYTES):
            sets = _sets(b.column("text").to_pylist(), n)
            names = _classes(sets)
            first = [i for i in np.unique(names, return_index=True)[1] if len(sets[i])]
            if not first:
                continue
            cut = [prefix_length(len(sets[i]), percent) for i in first]
            grams = np.concatenate([_rare_first(sets[i], rank)[:k] for i, k in zip(first, cut)]).view(np.int64)
            pos = np.concatenate([np.arange(1, k + 1) for k in cut])
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams), pa.array(np.repeat(names[first], cut)),
                 pa.array(np.repeat([len(sets[i]) for i in first], cut).astype(np.int32)), pa.array(pos.astype(np.int32))], ["h", "cls", "n", "pos"])

    def shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by (h, n, cls): rows of n-grams with two classes or more, each class once."""
        held = None
        for b in batches:
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            h, c = b.column("h").to_numpy(), b.column("cls").to_numpy()
            same = h[1:] == h[:-1]
            new = np.concatenate([[True], ~same | (c[1:] != c[:-1])])
            starts = np.flatnonzero(np.concatenate([[True], ~same]))
            tail = int(starts[-1])
            distinct = np.add.reduceat(new.astype(np.int64), starts)
            keep = new & np.repeat(distinct > 1, np.diff(np.append(starts, len(h))))
            keep[tail:] = False
            if keep.any():
                yield _with_partner(b.filter(pa.array(keep)), percent)
            held = b.slice(tail).filter(pa.array(new[tail:]))
        if held is not None and held.num_rows > 1:
            yield _with_partner(held, percent)

    groups = tmp.keep(src.select("text").mapInArrow(prefixes, "h long, cls long, n int, pos int").repartition("h")
                        .sortWithinPartitions("h", "n", "cls").mapInArrow(shared_only, "h long, cls long, n int, pos int"), "ngram-groups")

    # the sets of one document of each class that is in a group
    owners = (scanned.where("segment is null").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
                     .join(groups.select("cls").distinct(), "cls"))
    owner = F.xxhash64("doc_id")
    bits = spark.sparkContext.broadcast(bitmap_of(owners.select(F.col("cls").bitwiseXOR(owner).alias("k")), "k", FILTER_BITS))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = rarity.value
        for b in text_groups(batches, "text", GROUP_BYTES):
            sets = _sets(b.column("text").to_pylist(), n)
            cls = _classes(sets)
            hit = in_bitmap(bits.value, cls ^ b.column("owner").to_numpy(), FILTER_BITS)
            keep = [i for i in np.flatnonzero(hit) if len(sets[i])]
            keep = [keep[k] for k in np.unique(cls[keep], return_index=True)[1]]
            lists = [_rare_first(sets[i], rank)[::-1].view(np.int64) for i in keep]  # most common first
            yield pa.RecordBatch.from_arrays([pa.array(cls[keep]), pa.array([sketch(sets[i]) for i in keep], pa.binary()),
                                              pa.array(lists, pa.list_(pa.int64()))], ["cls", "sketch", "grams"])

    # bucketed by class, a file a bucket: the joins of all rounds read it where it lies
    buckets = max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = f"ngram_sets_{uuid.uuid4().hex[:12]}"
    (src.select(owner.alias("owner"), "text").mapInArrow(wanted, "cls long, sketch binary, grams array<long>").repartition(buckets, "cls")
        .write.bucketBy(buckets, "cls").option("path", tmp.path("ngram-sets")).saveAsTable(table))
    grams = spark.table(table)

    shares = tmp.keep(groups.groupBy("cls").agg((F.count("*") / F.first("n")).alias("share")), "ngram-shares")
    labels = None
    for mode in ("shared", "small", "shared", "all"):
        state = shares.withColumn("label", F.col("cls"))
        if labels is not None:
            state = (shares.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
                           .select("cls", "share", F.coalesce("label", "cls").alias("label")))
        rows = groups.join(state, "cls")
        sketches = grams.select("cls", "sketch")
        if mode == "all":  # only groups of several labels, with the sketches of their classes
            mixed = rows.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("h")
            rows = rows.join(mixed, "h", "left_semi").join(sketches, "cls")
        rows = rows.select("h", "cls", "n", "pos", "label", "sketch" if mode == "all" else "share")
        pairs = (rows.repartition("h").sortWithinPartitions("h", "n", "cls")
                     .mapInArrow(partial(_pairs, percent=percent, mode=mode), "a long, b long, share double"))
        if mode == "all":
            pairs = pairs.select("a", "b").distinct()
        else:  # of the hubs of all its groups, the most shared one, if the sketches fit
            pairs = pairs.groupBy("b").agg(F.max(F.struct("share", "a")).alias("best")).select("best.a", "b")
            ends = sketches.toDF("a", "sa"), sketches.toDF("b", "sb")
            pairs = pairs.join(ends[0], "a").join(ends[1], "b").select("a", "b", "sa", "sb").mapInArrow(partial(_fitting, percent=percent), "a long, b long")
        pairs = tmp.keep(pairs.withColumn("chunk", F.pmod(F.xxhash64("b"), F.lit(64))), "ngram-pairs")
        roles = (pairs.select(F.col("b").alias("cls"), "a", "chunk", "b")
                      .unionByName(pairs.select(F.col("a").alias("cls"), "a", "chunk", F.lit(None).cast("long").alias("b")).distinct()))
        found = (roles.join(grams.select("cls", "grams"), "cls").select("a", "chunk", "b", "grams").repartition("a", "chunk")
                      .sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
                      .mapInArrow(partial(_verify, percent=percent), "a long, b long").distinct())
        found = tmp.keep(found, "ngram-links")
        tmp.drop(pairs)
        labels = merged(labels, found, tmp)
    spark.sql(f"DROP TABLE {table}")

    docs_ = scanned.where("segment is null").select("doc_id", "n", "cls")
    known = docs_.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    smallest = known.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    linked = known.where("n > 0").join(smallest, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(docs_.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
