"""All-pairs cosine similarity above a threshold.

Sparse vectors (TF-IDF): exact, candidate pairs by prefix filtering.
  Each vector is L2-normalised and its terms ordered rarest first.  If two
  vectors have cosine > t they must share a term in the *prefix* of each
  one, where the prefix is the leading terms whose remaining tail still has
  norm > t (the tail alone contributes at most ||tail|| <= t to any dot
  product).  Only prefix terms are indexed and probed against all terms of
  the other side, so a frequent (low-idf) term - usually in the tail - does
  not pair up every vector that contains it.  Candidate pairs then get
  their exact dot product from a join on (pair, term).

Dense vectors (embeddings, factors, word vectors): exact, block kernel.
  Equal vectors are one class.  Classes are gathered around pivots (a bounded
  number of them) into blocks of bounded size, each packed into one row; two blocks
  meet only if the angle between their pivots, less both radii, leaves a cosine that
  counts (over the threshold, or over a row's k-th best).  Blocks are dealt over a square
  grid of cells, so each is exchanged as often as the grid is wide, not once a partner.
  One task multiplies the blocks of a cell two by two with numpy.  Memory per task: one
  side of a cell.  Pairs are made where they are found; none is exchanged.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.operators.ranking import global_row_number, top_k_per_group
from ratewise.session import materialize

BLOCK_ROWS = 2048


# --------------------------------------------------------------------------
# sparse
# --------------------------------------------------------------------------
def normalise_sparse(weights: DataFrame, id_col: str) -> DataFrame:
    """(id, term, w) -> (id, term, x = w / ||w||); zero vectors dropped
    (Q1: a zero vector has no defined cosine)."""
    norms = weights.groupBy(id_col).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    return (weights.join(norms.where(F.col("_norm") > 0), id_col)
            .select(id_col, "term", (F.col("w") / F.col("_norm")).alias("x"))
            .where(F.col("x") != 0))


def _term_rank(*units: DataFrame) -> DataFrame:
    """Document frequency of each term over all given vector sets; the
    rarest-first order is (df asc, term asc)."""
    df = None
    for u in units:
        part = u.groupBy("term").agg(F.count(F.lit(1)).alias("_n"))
        df = part if df is None else df.unionByName(part)
    return df.groupBy("term").agg(F.sum("_n").alias("_df"))


def _prefix_terms(unit: DataFrame, id_col: str, rank: DataFrame, t: float) -> DataFrame:
    """Terms of each vector, rarest first, kept while the tail from that term
    on (itself and every more frequent term) has squared norm > t^2 (with a
    small slack so rounding never prunes a qualifying pair)."""
    w = (Window.partitionBy(id_col).orderBy(F.col("_df").desc(), F.col("term").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (unit.join(rank, "term")
            .withColumn("_tail_sq", F.sum(F.col("x") * F.col("x")).over(w))
            .where(F.col("_tail_sq") > t * t - 1e-9).select(id_col, "term"))


def cosine_pairs_sparse(left: DataFrame, right: DataFrame | None, left_id: str, right_id: str,
                        threshold: float) -> DataFrame:
    """Pairs (left_id, right_id, cos) with cos > threshold.

    ``left``/``right`` are (id, term, w) rows.  ``right=None`` means a self
    join of ``left``: pairs a != b, both orders emitted."""
    t = float(threshold)
    self_join = right is None
    lu = normalise_sparse(left, left_id)
    ru = lu.withColumnRenamed(left_id, right_id) if self_join else normalise_sparse(right, right_id)
    rank = _term_rank(lu, ru) if not self_join else _term_rank(lu)
    # candidates: a prefix term of the left vector appears in the right one
    lpre = _prefix_terms(lu, left_id, rank, t)
    cand = lpre.join(ru.select(right_id, "term"), "term").select(left_id, right_id)
    if self_join:
        cand = cand.where(F.col(left_id) < F.col(right_id))
    cand = cand.distinct()
    # exact dot products for candidates: (pair, term) joins
    lx = lu.select(left_id, "term", F.col("x").alias("_xl"))
    rx = ru.select(right_id, "term", F.col("x").alias("_xr"))
    dots = (cand.join(lx, left_id).join(rx, [right_id, "term"])
            .groupBy(left_id, right_id).agg(F.sum(F.col("_xl") * F.col("_xr")).alias("cos"))
            .where(F.col("cos") > t))
    if self_join:
        dots = dots.unionByName(dots.select(F.col(right_id).alias(left_id), F.col(left_id).alias(right_id), "cos"))
    return dots


#: Slices of the vocabulary by which the products of two blocks are bounded.
TERM_SLICES = 4096
#: Terms of the vectors of one block at most (but for one vector that has more), entries multiplied at once.
BLOCK_TERMS, ENTRIES = 1 << 21, 1 << 20
#: Blocks that a cell of the grid holds (about).
HELD_BLOCKS = 12


def _sparse_blocks(weights: DataFrame, id_col: str, block_rows: int, rank: DataFrame, payload: str | None) -> DataFrame:
    """(ids, ns, t, x): vectors over their norms, packed where they lie into blocks of bounded size, with terms
    as numbers: the ids (or payloads) of a block, the number of terms of each, terms and values one after another."""
    cols = [id_col] + ([payload] if payload else [])
    live = weights.where((F.col("w") != 0) & F.col(id_col).isNotNull())
    vecs = (live.join(rank.select("term", "tid"), "term").groupBy(*cols).agg(F.array_sort(F.collect_list(F.struct("tid", "w"))).alias("v"))
                .select(F.col(payload or id_col).cast("string").alias("id"), F.col("v.tid").cast("array<int>").alias("t"), F.col("v.w").cast("array<double>").alias("w")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch.column("t")).to_numpy())
            start = 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, min(start + block_rows, int(np.searchsorted(ends, before + BLOCK_TERMS, side="right"))))
                part = batch.slice(start, min(stop, batch.num_rows) - start)
                sizes = pc.list_value_length(part.column("t"))
                w, row = part.column("w").flatten().to_numpy(), np.repeat(np.arange(part.num_rows), sizes.to_numpy())
                norm = np.sqrt(np.bincount(row, w * w, part.num_rows))
                if not norm.all():  # squares too small for a number
                    live = norm > 0
                    part, sizes, w, row, norm = part.filter(pa.array(live)), sizes.filter(pa.array(live)), w[live[row]], (np.cumsum(live) - 1)[row[live[row]]], norm[live]
                flat = [part.column("id"), sizes, part.column("t").flatten(), pa.array(w / norm[row])]
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(v)], v) for v in flat], ["ids", "ns", "t", "x"])
                start = stop
    return materialize(vecs.mapInArrow(pack, "ids array<string>, ns array<int>, t array<int>, x array<double>"))


def _csr(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, row of each entry, term of each entry, value of each entry)."""
    ids = np.asarray([r["id"] for r in rows], dtype=object)
    lengths = np.fromiter((len(r["t"]) for r in rows), np.int64, len(rows))
    owner = np.repeat(np.arange(len(rows)), lengths)
    t = np.concatenate([np.asarray(r["t"], np.int64) for r in rows]) if len(rows) else np.empty(0, np.int64)
    x = np.concatenate([np.asarray(r["x"], np.float64) for r in rows]) if len(rows) else np.empty(0)
    return ids, owner, t, x


def slice_norms(block, width: int, top: int) -> np.ndarray:
    """Norm of each vector within each slice of the terms.  The most frequent terms (the largest numbers, up
    to ``top``) have slices of their own, the others share the rest."""
    ids, owner, t, x = block
    own = width // 8
    at = np.where(top - t < own, top - t, own + t % (width - own))
    return np.sqrt(np.bincount(owner * width + at, x * x, len(ids) * width)).astype(np.float32).reshape(len(ids), width)


def sliced_products(left, right, threshold: float, width: int = TERM_SLICES, top: int | None = None,
                    norms: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, row, product) over the threshold of two blocks of unit vectors.

    Two vectors' product is at most the sum, over the slices of the terms, of the products of their norms within
    the slice: one product of two matrices of ``width`` columns, whatever the number of terms.
    Only pairs whose bound is over the threshold (less all that rounding to 32 bits can move it) are
    multiplied term by term.  Memory: rows x rows, rows x ``width`` and a few vectors over the terms."""
    (ids1, o1, t1, x1), (ids2, o2, t2, x2) = left, right
    if not len(t1) or not len(t2):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    top = int(max(t1.max(), t2.max())) if top is None else top
    p, q = norms or (slice_norms(left, width, top), slice_norms(right, width, top))
    b, a = np.nonzero(q @ p.T > threshold - (width + 8) * 2.0 ** -23)
    starts1, starts2 = (np.searchsorted(o, np.arange(len(ids) + 1)) for o, ids in ((o1, ids1), (o2, ids2)))
    n = np.diff(starts1)[a]
    upto = np.cumsum(n)
    m = top + 1
    some = max(1, min(len(ids2), (1 << 18) // m))  # rows of the right block that are looked up at once
    table = np.zeros(some * m)
    cos = np.zeros(len(a))
    for row in range(0, len(ids2), some):
        first, last = np.searchsorted(b, [row, row + some])
        if first == last:
            continue
        mine = slice(starts2[row], starts2[min(row + some, len(ids2))])
        places = (o2[mine] - row) * m + t2[mine]
        table[places] = x2[mine]
        at = first
        while at < last:
            end = min(last, max(at + 1, int(np.searchsorted(upto, upto[at] - n[at] + ENTRIES, "right"))))
            k = n[at:end]
            pair = np.repeat(np.arange(end - at), k)
            entry = np.arange(len(pair)) + np.repeat(starts1[a[at:end]] - (np.cumsum(k) - k), k)
            cos[at:end] = np.bincount(pair, table[(b[at:end] - row)[pair] * m + t1[entry]] * x1[entry], end - at)
            at = end
        table[places] = 0
    keep = cos > threshold
    return a[keep], b[keep], cos[keep]


def _sparse_grid(left: DataFrame, right: DataFrame) -> tuple[int, int, int]:
    """Rows and columns of the grid of cells, and columns of one round.  With the blocks the grid grows wider than
    the tasks ask for: then its columns come in rounds, and a round exchanges a block of ``left`` a fixed
    number of times."""
    parallel = 4 * left.sparkSession.sparkContext.defaultParallelism
    n1, n2 = max(1, left.count()), max(1, right.count())
    at_once = math.ceil(math.sqrt(parallel))
    wide2 = min(n2, max(-(-n2 // HELD_BLOCKS), at_once))
    return min(n1, -(-parallel // min(wide2, at_once))), wide2, at_once


def _sparse_cells(left: DataFrame, right: DataFrame, grid: tuple[int, int] | None = None, columns: tuple[int, int] | None = None) -> DataFrame:
    """(p1, p2, side, block): the blocks dealt over a grid, in each cell those of ``right`` (side 0) before those of
    ``left``; of the ``columns`` from the first to the last one, if given.  A block goes to one column or one row
    of the grid: it is exchanged as often as the other side has bands."""
    wide1, wide2 = grid or _sparse_grid(left, right)[:2]
    first, last = columns or (0, wide2 - 1)

    def dealt(blocks: DataFrame, wide: int):
        number = F.monotonically_increasing_id()  # task and place of the block: neighbours go to different bands
        return blocks.withColumn("_n", number).withColumn("_p", F.pmod(F.shiftright("_n", 33) + F.col("_n").bitwiseAND(F.lit((1 << 33) - 1)), F.lit(wide)).cast("int")).drop("_n")
    held = dealt(right, wide2).withColumnRenamed("_p", "p2").where(F.col("p2").between(first, last))
    held = held.withColumn("p1", F.explode(F.sequence(F.lit(0), F.lit(wide1 - 1)))).withColumn("side", F.lit(0))
    come = dealt(left, wide1).withColumnRenamed("_p", "p1").withColumn("p2", F.explode(F.sequence(F.lit(first), F.lit(last)))).withColumn("side", F.lit(1))
    return held.unionByName(come).repartition(2 * wide1 * (last - first + 1), "p1", "p2").sortWithinPartitions("p1", "p2", "side")


def _sparse_block_kernel(threshold: float, width: int, top: int):
    def blocks(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: col[i] for name, col in zip(batch.schema.names, batch.columns)}
                ns = row["ns"].values.to_numpy()
                block = (row["ids"].values, np.repeat(np.arange(len(ns)), ns), row["t"].values.to_numpy().astype(np.int64), row["x"].values.to_numpy())
                yield (row["p1"].as_py(), row["p2"].as_py()), row["side"].as_py(), block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for at, side, block in blocks(batches):
            if at != cell:
                cell, held = at, []
            norms = slice_norms(block, width, top)
            if side == 0:
                held.append((block, norms))
                continue
            for other, theirs in held:
                a, b, cos = sliced_products(block, other, threshold, width, top, (norms, theirs))
                yield pa.RecordBatch.from_arrays([block[0].take(pa.array(a)), other[0].take(pa.array(b)), pa.array(cos)], ["a", "b", "cos"])
    return run


def cosine_pairs_sparse_blocked(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                                threshold: float, block_rows: int = BLOCK_ROWS, width: int = TERM_SLICES,
                                payload: str | None = None) -> DataFrame:
    """Exact cross-set cosine > threshold for long sparse vectors (texts).

    When vectors share many terms (token sets of whole texts, expanded with
    synonyms) prefix filtering keeps nearly every pair, and a per-(pair,
    term) join costs pairs x terms rows.  Here each side is packed into
    blocks of at most ``block_rows`` vectors with terms as numbers (rarest first), which are
    dealt over a grid of cells; a task bounds the products of two blocks, multiplies the
    vectors that the bound lets through (``sliced_products``) and emits only pairs
    above the threshold.  ``payload`` names a column of ``left``, the same for all rows of an
    id, that stands for the id in the result."""
    # numbers by rarity over both sides; terms of one side only add nothing to a product but count in its norm
    rank = materialize(global_row_number(_term_rank(*(s.where(F.col("w") != 0) for s in (left, right))), [F.col("_df").asc(), F.col("term").asc()], "tid"))
    top = rank.count()
    lb = _sparse_blocks(left, left_id, block_rows, rank, payload)
    rb = _sparse_blocks(right, right_id, block_rows, rank, None)
    *grid, at_once = _sparse_grid(lb, rb)
    rounds = [_sparse_cells(lb, rb, grid, (first, min(first + at_once, grid[1]) - 1)).mapInArrow(
        _sparse_block_kernel(float(threshold), width, top), "a string, b string, cos double") for first in range(0, grid[1], at_once)]
    out = rounds[0] if len(rounds) == 1 else _one_by_one(rounds)
    name = payload or left_id
    lt = dict(left.dtypes)[name]
    rtp = dict(right.dtypes)[right_id]
    return out.select(F.col("a").cast(lt).alias(name), F.col("b").cast(rtp).alias(right_id), "cos")


def _one_by_one(rounds: list[DataFrame]) -> DataFrame:
    """The rows of all rounds, each run to its end before the next: the disk holds the exchange of one round."""
    out = None
    while rounds:
        done = materialize(rounds.pop(0))
        out = done if out is None else out.unionByName(done)
        gc.collect()  # Spark removes a round's shuffle files once its plan is collected
        out.sparkSession._jvm.System.gc()
    return out


#: Members of one vector that stand in one row.
MEMBERS_A_ROW = 1024


def member_arrays(members: DataFrame, vec_col: str, item_col: str, name: str) -> DataFrame:
    """(vec, name): the items of each vector in arrays of about ``MEMBERS_A_ROW`` at most."""
    sizes = members.groupBy(vec_col).agg(F.count(F.lit(1)).alias("_c"))
    part = F.pmod(F.xxhash64(item_col), F.ceil(F.col("_c") / F.lit(MEMBERS_A_ROW)))
    return members.join(sizes, vec_col).groupBy(vec_col, part.alias("_p")).agg(F.collect_list(item_col).alias(name)).drop("_p")


def expand_vector_pairs(vec_pairs: DataFrame, members: DataFrame, vec_col: str, item_col: str,
                        other_vec: str, other_item: str) -> DataFrame:
    """Distinct-vector pairs -> item pairs of different items; a pair of a vector with itself stands for
    the items that share it.

    ``members`` is (item, vec).  Items with identical content collapse to
    one vector before the pair search, so the search scales with the number
    of distinct contents; this step only materialises the requested output.
    Vectors meet as pairs of member arrays, which are taken apart where they lie: no
    item pair is exchanged."""
    m1 = materialize(member_arrays(members, vec_col, item_col, "_ms"))
    m2 = m1.select(F.col(vec_col).alias(other_vec), F.col("_ms").alias("_os"))
    tasks = max(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), members.sparkSession.sparkContext.defaultParallelism)
    # small tables that stand for many rows: spread over all tasks before they are taken apart
    met = vec_pairs.join(m1, vec_col).join(m2, other_vec).repartition(4 * tasks)
    return (met.select(F.explode("_ms").alias(item_col), "_os", "cos").select(item_col, F.explode("_os").alias(other_item), "cos")
               .where(F.col(item_col) != F.col(other_item)))


# --------------------------------------------------------------------------
# dense
# --------------------------------------------------------------------------
def unit_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): vectors over their norms; zero vectors dropped."""
    v = F.transform(vec_col, lambda x: x.cast("double"))
    sq = F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), lambda a, b: a + b)
    return (df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.sqrt(sq).alias("n"))
            .where(F.col("n") > 0)
            .select("id", F.transform("v", lambda x: x / F.col("n")).alias("v")))


#: Most pivots around which dense vectors are gathered; what is known of their clusters is
#: a table of this many rows, and of its square of pairs at most.
MOST_PIVOTS = 512


def vector_classes(unit: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, v) of one row for each distinct vector, and (id, rep) of all rows: equal vectors
    are compared once, however many rows share one."""
    classes = unit.groupBy("v").agg(F.min("id").alias("rep"))
    keyed = materialize(unit.withColumn("h", F.xxhash64("v")).join(
        classes.withColumn("h", F.xxhash64("v")).withColumnRenamed("v", "_v"), "h").where(F.col("v") == F.col("_v")).select("id", "rep", "v"))
    return keyed.where(F.col("id") == F.col("rep")).select("id", "v"), keyed.select("id", "rep")


def pick_pivots(unit: DataFrame, n: int) -> np.ndarray:
    """The ``n`` vectors of smallest id hash: a bounded sample, the same in every run."""
    rows = unit.orderBy(F.xxhash64("id"), "id").limit(n).select("v").collect()
    return np.asarray([r["v"] for r in rows], dtype=np.float64)


def _cluster(unit: DataFrame, pivots: np.ndarray, block_rows: int) -> DataFrame:
    """(c, s, far, ids, iv): vectors gathered around their nearest pivot c, in sub-blocks s of about
    ``block_rows`` rows (their ids, their numbers one after another), with the largest angle ``far`` to the
    pivot in the sub-block.  Columns u and ms of ``unit`` (the row of a class, some of its members) become
    us, ns (sizes of the ms) and ms."""
    more = ["u", "ms"] if "ms" in unit.columns else []

    def near(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for at in range(0, len(pdf), 4096):
                part = pdf.iloc[at:at + 4096]
                cos = np.asarray(part["v"].tolist(), dtype=np.float64) @ pivots.T
                c = cos.argmax(axis=1)
                yield pd.DataFrame({"id": part["id"].to_numpy(), "v": part["v"].to_numpy(), "c": c.astype(np.int32),
                                    "angle": np.arccos(np.clip(cos[np.arange(len(c)), c], -1, 1)), **{x: part[x].to_numpy() for x in more}})
    shape = "id long, v array<double>, c int, angle double" + (", u long, ms array<bigint>" if more else "")
    placed = materialize(unit.select("id", "v", *more).mapInPandas(near, shape))
    sizes = placed.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    cut = F.pmod(F.xxhash64("id", *more), F.greatest(F.ceil(F.col("n") / F.lit(block_rows)), F.lit(1)))
    packed = (placed.join(F.broadcast(sizes), "c").withColumn("s", cut.cast("int"))  # a row a pivot
                    .groupBy("c", "s").agg(F.max("angle").alias("far"), F.collect_list(F.struct("id", "v", *more)).alias("rows")))
    members = [F.col("rows.u").alias("us"), F.transform("rows.ms", F.size).alias("ns"), F.flatten("rows.ms").alias("ms")] if more else []
    return materialize(packed.select("c", "s", "far", F.col("rows.id").alias("ids"), F.flatten("rows.v").alias("iv"), *members))


def reachable(pivots: np.ndarray, far1: np.ndarray, far2: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which clusters (rows) can hold a vector whose cosine with one of another cluster (columns)
    exceeds ``least`` (one bound for each row): the angle between them is at least that of
    the pivots minus both radii."""
    between = np.arccos(np.clip(pivots @ pivots.T, -1, 1))
    nearest = np.maximum(between - far1[:, None] - far2[None, :], 0)
    # with a slack for rounding; a negative radius marks an empty cluster
    return (np.cos(nearest) > least[:, None] - 1e-7) & (far1 >= 0)[:, None] & (far2 >= 0)[None, :]


def _radii(blocks: DataFrame, n: int) -> np.ndarray:
    far = np.full(n, -1.0)
    for r in blocks.groupBy("c").agg(F.max("far").alias("far")).collect():  # a row a pivot
        far[r["c"]] = r["far"]
    return far


#: Sub-blocks of one side that a cell holds (about).
CELL_BLOCKS = 128
#: Rows multiplied at once, and pairs sent at once.
STRIP_ROWS, SENT_PAIRS = 256, 1 << 18


def _cells(blocks1: DataFrame, blocks2: DataFrame, self_join: bool) -> DataFrame:
    """(p1, p2, side, block): the sub-blocks dealt over a square grid, in each cell those of ``blocks2`` (side 0)
    before those of ``blocks1``.  A sub-block goes to one row or one column of the grid (of the
    half over its diagonal for a self join): as many copies as the grid is wide."""
    spark = blocks1.sparkSession
    n = blocks1.count() if self_join else max(blocks1.count(), blocks2.count())
    wide = max(1, min(n, max(math.ceil(math.sqrt(8 * spark.sparkContext.defaultParallelism)), -(-n // CELL_BLOCKS))))
    own, end = F.pmod(F.xxhash64("c", "s"), F.lit(wide)).cast("int"), F.lit(wide - 1)
    held = blocks2.withColumn("p2", own).withColumn("p1", F.explode(F.sequence(F.lit(0), F.col("p2") if self_join else end)))
    come = blocks1.withColumn("p1", own).withColumn("p2", F.explode(F.sequence(F.col("p1") if self_join else F.lit(0), end)))
    both = held.withColumn("side", F.lit(0)).unionByName(come.withColumn("side", F.lit(1)))
    return both.repartition(2 * wide * wide, "p1", "p2").sortWithinPartitions("p1", "p2", "side")


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Each row with its arrays as numpy, and its vectors as a matrix ``m``."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: col[i] for name, col in zip(batch.schema.names, batch.columns)}
            row = {k: x.values.to_numpy(zero_copy_only=False) if isinstance(x, pa.ListScalar) else x.as_py() for k, x in row.items()}
            yield row | {"m": row["iv"].reshape(len(row["ids"]), -1)}


def _meeting(kernel, allowed: np.ndarray, self_join: bool):
    """Gives each sub-block of side 1 with those of its cell that it may meet to the kernel; each unordered
    pair once for a self join."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for block in _blocks_of(batches):
            if cell != (block["p1"], block["p2"]):
                cell, held = (block["p1"], block["p2"]), []
            if block["side"] == 0:
                held.append(block)
                continue
            once = self_join and cell[0] == cell[1]
            mates = [h for h in held if allowed[block["c"], h["c"]] and (not once or (block["c"], block["s"]) <= (h["c"], h["s"]))]
            yield from kernel(block, mates)
    return run


def _equal(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of all equal values of two arrays."""
    order = np.argsort(right, kind="stable")
    low, high = np.searchsorted(right[order], left, "left"), np.searchsorted(right[order], left, "right")
    n = high - low
    a = np.repeat(np.arange(len(left)), n)
    return a, order[np.arange(len(a)) + np.repeat(low - (np.cumsum(n) - n), n)]


def _member_pairs(left: dict, right: dict, a: np.ndarray, b: np.ndarray, cos: np.ndarray, other: bool, mirror: bool) -> Iterator[pa.RecordBatch]:
    """The pairs of members of the rows a and b; of different ids only (``other``), in both orders (``mirror``)."""
    starts1, starts2 = (np.cumsum(x["ns"]) - x["ns"] for x in (left, right))
    n1, n2 = left["ns"][a].astype(np.int64), right["ns"][b].astype(np.int64)
    total = n1 * n2
    upto = np.cumsum(total)
    at = 0
    while at < len(a):
        end = max(at + 1, int(np.searchsorted(upto, upto[at] - total[at] + SENT_PAIRS, "right")))
        n, here = total[at:end], np.arange(at, end)
        row = np.repeat(here, n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        x = left["ms"][starts1[a[row]] + place // n2[row]]
        y = right["ms"][starts2[b[row]] + place % n2[row]]
        c = cos[row]
        if other:
            keep = x != y
            x, y, c = x[keep], y[keep], c[keep]
        for one, two in ((x, y), (y, x)) if mirror else ((x, y),):
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two), pa.array(c)], ["a", "b", "cos"])
        at = end


def _threshold_kernel(threshold: float, self_join: bool):
    """Member pairs of the rows over the threshold.  In a self join rows of one id don't meet, but the members
    of one row u, which may lie in several arrays, have cosine 1."""
    def run(left: dict, mates: list[dict]) -> Iterator[pa.RecordBatch]:
        for right in mates:
            same = self_join and (left["c"], left["s"]) == (right["c"], right["s"])
            for at in range(0, len(left["ids"]), STRIP_ROWS):
                sims = left["m"][at:at + STRIP_ROWS] @ right["m"].T
                a, b = np.nonzero(sims > threshold)
                cos, a = sims[a, b], a + at
                if self_join:
                    keep = left["ids"][a] != right["ids"][b]
                    if same:
                        keep &= a < b
                    a, b, cos = a[keep], b[keep], cos[keep]
                yield from _member_pairs(left, right, a, b, cos, self_join, self_join)
            if self_join and threshold < 1:
                a, b = _equal(left["us"], right["us"])
                yield from _member_pairs(left, right, a, b, np.ones(len(a)), True, not same)
    return run


def _with_members(vectors: DataFrame, members: DataFrame) -> DataFrame:
    """(id, v, u, ms): the rows of ``vectors``, numbered, with the ids of their class in arrays of bounded size."""
    arrays = member_arrays(members, "rep", "id", "ms").withColumnRenamed("rep", "id")
    return materialize(vectors.withColumn("u", F.monotonically_increasing_id())).join(arrays, "id")


def _n_pivots(n: int, block_rows: int) -> int:
    return max(1, min(MOST_PIVOTS, -(-n // block_rows)))


def cosine_pairs_dense(left: DataFrame, left_id: str, vec_col: str, threshold: float,
                       right: DataFrame | None = None, right_id: str | None = None,
                       block_rows: int = BLOCK_ROWS, skipped: dict[str, int] | None = None) -> DataFrame:
    """Exact dense all-pairs cosine > threshold; returns (a, b, cos) with
    both orders for a self join (a != b).

    Equal vectors are one class.  Classes are gathered in blocks around pivots, and a pair of
    blocks whose largest possible cosine isn't over the threshold is never joined.
    ``skipped``, if given, receives the numbers of cluster pairs, and of those left out."""
    lv, lm = vector_classes(unit_vectors(left, left_id, vec_col))
    rv, rm = (lv, lm) if right is None else vector_classes(unit_vectors(right, right_id or left_id, vec_col))
    n = lv.count() if right is None else lv.count() + rv.count()
    pivots = pick_pivots(lv if right is None else lv.unionByName(rv), _n_pivots(n, block_rows))
    if not len(pivots):
        return left.sparkSession.createDataFrame([], "a long, b long, cos double")
    lb = _cluster(_with_members(lv, lm), pivots, block_rows)
    rb = lb if right is None else _cluster(_with_members(rv, rm), pivots, block_rows)
    far1 = _radii(lb, len(pivots))
    far2 = far1 if right is None else _radii(rb, len(pivots))
    allowed = reachable(pivots, far1, far2, np.full(len(pivots), float(threshold)))
    if skipped is not None:
        held = (far1 >= 0)[:, None] & (far2 >= 0)[None, :]
        skipped |= {"pairs": int(held.sum()), "skipped": int((held & ~allowed).sum())}
    if right is None:
        allowed |= allowed.T | np.diag(far1 >= 0)  # the members of a class meet even if no cosine of two classes counts
    return _cells(lb, rb, right is None).mapInArrow(
        _meeting(_threshold_kernel(float(threshold), right is None), allowed, right is None), "a long, b long, cos double")


# more than the rounding to 6 digits can move a value
TIE_SLACK = 2e-6


def _topk_kernel(k: int):
    """For each row the k largest cosines with other ids of the cell, and all that may tie with the k-th
    once rounded."""
    def run(left: dict, mates: list[dict]) -> Iterator[pa.RecordBatch]:
        kth = np.full(len(left["ids"]), -np.inf)
        row, other, val = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        for right in mates:
            s = left["m"] @ right["m"].T
            s[_equal(left["ids"], right["ids"])] = -np.inf  # self excluded
            floor = kth
            if s.shape[1] >= k and np.isinf(kth).any():
                floor = np.maximum(kth, -np.partition(-s, k - 1, axis=1)[:, k - 1])
            r, c = np.nonzero(s >= floor[:, None] - TIE_SLACK)
            ok = np.isfinite(s[r, c])
            r, c = r[ok], c[ok]
            row, other, val = np.concatenate([row, r]), np.concatenate([other, right["ids"][c]]), np.concatenate([val, s[r, c]])
            order = np.lexsort((-val, row))
            row, other, val = row[order], other[order], val[order]
            last = np.arange(len(row)) - np.searchsorted(row, row) == k - 1
            kth[row[last]] = val[last]
            keep = val >= kth[row] - TIE_SLACK
            row, other, val = row[keep], other[keep], val[keep]
        yield pa.RecordBatch.from_arrays([pa.array(left["ids"][row]), pa.array(other), pa.array(val)], ["a", "b", "cos"])
    return run


def nearest_dense(df: DataFrame, id_col: str, vec_col: str, k: int, block_rows: int = BLOCK_ROWS,
                  skipped: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """The k nearest other distinct vectors of every distinct vector by cosine, with all that
    tie with the k-th one, as (a, b, cos), cos rounded to 6 digits; and (id, rep), the members of
    each.  m equal vectors are one row here, not m x m.

    First the blocks around the same pivot meet, which gives each row a k-th value; then
    the pairs of clusters that can still beat the smallest of these.  The result doesn't depend on
    the number of blocks.  ``skipped`` as above."""
    vectors, members = vector_classes(unit_vectors(df, id_col, vec_col))
    pivots = pick_pivots(vectors, _n_pivots(vectors.count(), block_rows))
    shape = "a long, b long, cos double"
    if not len(pivots):
        return df.sparkSession.createDataFrame([], shape), members
    blocks = _cluster(vectors, pivots, block_rows)
    far = _radii(blocks, len(pivots))
    own = np.diag(far >= 0)
    cells = _cells(blocks, blocks, False)
    first = materialize(cells.mapInArrow(_meeting(_topk_kernel(k), own, False), shape))
    # the k-th value of each row so far, and the smallest one of each cluster
    kth = first.groupBy("a").agg(F.sort_array(F.collect_list("cos"), asc=False).alias("best"))
    kth = kth.select("a", F.when(F.size("best") >= k, F.element_at("best", k)).otherwise(-1.0).alias("kth"))
    homes = blocks.select("c", F.explode("ids").alias("a"))
    least = np.full(len(pivots), -1.0)
    for r in homes.join(kth, "a", "left").groupBy("c").agg(F.min(F.coalesce("kth", F.lit(-1.0))).alias("least")).collect():  # a row a pivot
        least[r["c"]] = r["least"]
    allowed = reachable(pivots, far, far, np.where(least <= -1.0, -2.0, least - 2 * TIE_SLACK)) & ~own
    if skipped is not None:
        held = (far >= 0)[:, None] & (far >= 0)[None, :]
        skipped |= {"pairs": int(held.sum()), "skipped": int((held & ~own & ~(allowed | allowed.T)).sum())}
    cand = first.unionByName(cells.mapInArrow(_meeting(_topk_kernel(k), allowed, False), shape)).withColumn("cos", F.round("cos", 6))
    # rank 1 + the number of strictly nearer rows
    w = Window.partitionBy("a").orderBy(F.col("cos").desc())
    return cand.withColumn("_near", F.rank().over(w)).where(F.col("_near") <= k).drop("_near"), members


# --------------------------------------------------------------------------
# the largest products of queries and items, some items left out per query
# --------------------------------------------------------------------------
#: Halvings of the squared norm after which items lie in one last band.
NORM_BANDS = 6
#: Copies of an item block that share the queries which meet it.
BLOCK_SHARES = 4
#: Queries looked at together when their blocks are chosen.
QUERY_ROWS = 2048


def _matrix(flat, width: int, dtype) -> np.ndarray:
    return np.asarray(flat, dtype).reshape(-1, width)


def _item_blocks(items: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame, np.ndarray, pd.DataFrame]:
    """(blocks, homes, pivots, units): items gathered by nearest pivot and band of norms.  Each such unit
    is known by its largest angle to the pivot, largest norm and size - a table of MOST_PIVOTS x
    (NORM_BANDS + 1) rows at most; its items lie in blocks (unit, ids, iv) of about ``block_rows``,
    their units in ``homes`` (item, unit)."""
    norm = F.sqrt(F.aggregate(F.transform("v", lambda x: x.cast("double") * x), F.lit(0.0), lambda a, b: a + b))
    live = materialize(items.withColumn("norm", norm).where(F.col("norm") > 0))
    seen = live.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("most")).first()
    unit = live.withColumn("v", F.transform("v", lambda x: x.cast("double") / F.col("norm")))
    pivots = pick_pivots(unit, max(1, min(MOST_PIVOTS, seen["n"] // 256)))
    if not seen["n"]:
        return live, live, pivots, pd.DataFrame()

    def near(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            v, norm = np.asarray(pdf["v"].tolist(), np.float64), pdf["norm"].to_numpy()
            cos = (v / norm[:, None]) @ pivots.T
            c = cos.argmax(axis=1)
            pdf["c"], pdf["angle"] = c.astype(np.int32), np.arccos(np.clip(cos[np.arange(len(c)), c], -1, 1))
            yield pdf
    kind = dict(live.dtypes)["v"]
    band = F.least(F.floor(-2 * F.log2(F.col("norm") / F.lit(seen["most"]))), F.lit(NORM_BANDS)).cast("int")
    placed = materialize(live.mapInPandas(near, f"id long, v {kind}, norm double, c int, angle double").withColumn("band", band))
    units = placed.groupBy("c", "band").agg(F.max("angle").alias("far"), F.max("norm").alias("top"), F.count(F.lit(1)).alias("n")).toPandas()
    units = units.sort_values(["c", "band"]).reset_index(drop=True).rename_axis("unit").reset_index()
    known = F.broadcast(items.sparkSession.createDataFrame(units[["unit", "c", "band", "n"]], "unit int, c int, band int, n long"))
    cut = F.pmod(F.xxhash64("id"), F.greatest(F.ceil(F.col("n") / F.lit(block_rows)), F.lit(1)))
    placed = placed.join(known, ["c", "band"])
    blocks = (placed.groupBy("unit", cut.alias("s"))
                    .agg(F.collect_list(F.struct("id", "v")).alias("rows"))
                    .select("unit", F.col("rows.id").alias("ids"), F.flatten("rows.v").alias("iv")))
    return materialize(blocks), placed.select(F.col("id").alias("item"), "unit"), pivots, units


def _choose_units(pivots: np.ndarray, units: pd.DataFrame, n: int, over: float, first: bool):
    """Sends packs of queries to the units they need: at first to the two in which a query most likely finds
    ``n`` large products, then to all that can hold a product as large as the query's ``least``."""
    c, far, top, size = (units[x].to_numpy() for x in ("c", "far", "top", "n"))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        share = 0
        for pdf in it:
            for at in range(0, len(pdf), QUERY_ROWS):
                part = pdf.iloc[at:at + QUERY_ROWS]
                ids, least, lists = part["id"].to_numpy(), part["least"].to_numpy(), part["v"].to_numpy()
                v = np.asarray(lists.tolist(), np.float64)
                norm = np.sqrt((v * v).sum(axis=1))
                cos = (v / np.where(norm > 0, norm, 1)[:, None]) @ pivots.T
                angle = np.arccos(np.clip(cos, -1, 1))[:, c]
                out = part["out"].to_numpy()
                n_out = np.fromiter((len(o) for o in out), np.int64, len(out))
                left_row = np.repeat(np.arange(len(out)), n_out)
                left_unit, left_item = np.concatenate(part["out_unit"].to_numpy()), np.concatenate(out)
                by_home = np.lexsort((left_row, left_unit))
                left_row, left_unit, left_item = left_row[by_home], left_unit[by_home], left_item[by_home]
                homes = np.searchsorted(left_unit, np.arange(len(c) + 1))
                if first:
                    guess = np.cos(angle) * top[None, :]
                    guess[size[None, :] < 2 * n + n_out[:, None]] = -np.inf
                    best = np.argpartition(-guess, min(1, len(c) - 1), axis=1)[:, :2]
                    want = np.zeros(guess.shape, bool)
                    np.put_along_axis(want, best, True, axis=1)
                    want &= np.isfinite(guess)
                else:
                    reach = norm[:, None] * top[None, :] * np.cos(np.maximum(angle - far[None, :], 0))
                    want = reach * (1 + 1e-5) + TIE_SLACK >= np.maximum(least, over)[:, None]
                by_unit, rows = np.nonzero(want.T)
                starts = np.searchsorted(by_unit, np.arange(len(c) + 1))
                for u in np.flatnonzero(np.diff(starts)):
                    r = rows[starts[u]:starts[u + 1]]
                    share = (share + 1) % BLOCK_SHARES
                    here = slice(homes[u], homes[u + 1])  # only what is left out of this unit goes along
                    asked = np.isin(left_row[here], r)
                    yield pd.DataFrame({"unit": [u], "share": [share], "qid": [ids[r]], "qv": [np.concatenate(lists[r])], "least": [least[r]],
                                        "out_row": [np.searchsorted(r, left_row[here][asked])], "out": [left_item[here][asked]]})
    return run


def half_up(x: np.ndarray, digits: int) -> np.ndarray:
    """``x`` to ``digits`` digits as SQL rounds: halves of the shortest decimal form away from zero."""
    scaled = np.abs(x) * 10.0 ** digits
    out = np.floor(scaled + 0.5)
    for i in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-6):
        out[i] = int((Decimal(repr(float(abs(x[i])))) * 10 ** digits).to_integral_value(ROUND_HALF_UP))
    return np.copysign(out / 10.0 ** digits, x)


def _summed(x: np.ndarray, y: np.ndarray, fused: bool) -> np.ndarray:
    """Products of rows of single floats, summed from the first column on: each step rounded once (``fused``)
    or after the product and after the sum, whatever the shape of the block."""
    total = np.zeros(len(x), np.float32)
    for d in range(x.shape[1]):
        total = (total + x[:, d].astype(np.float64) * y[:, d]).astype(np.float32) if fused else total + x[:, d] * y[:, d]
    return total


def _products_kernel(n: int, over: float, width: int, dtype: str, digits: int | None, first: bool, fused: bool):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for qid, qv, least, out_row, out, ids, iv in zip(*(pdf[x] for x in ("qid", "qv", "least", "out_row", "out", "ids", "iv"))):
                q, i = _matrix(qv, width, dtype), _matrix(iv, width, dtype)
                score = q @ i.T
                order = np.argsort(ids)
                at = np.minimum(np.searchsorted(ids[order], out), len(ids) - 1)
                hit = ids[order[at]] == out
                score[out_row[hit], order[at[hit]]] = -np.inf
                k = min(n, len(ids))
                nth = np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k].astype(np.float64)
                if first:
                    ok = (nth > over) & (len(ids) >= n)
                    yield pd.DataFrame({"id": qid[ok], "least": nth[ok]})
                    continue
                floor = np.maximum(nth, least)
                a, b = np.nonzero(score >= (floor - 1e-5 * np.abs(floor) - TIE_SLACK)[:, None])
                s = (_summed(q[a], i[b], fused) if dtype == "float32" else score[a, b]).astype(np.float64)
                above = s > over
                a, b, s = a[above], b[above], s[above]
                # the n first of each query by score, then id
                rank = np.lexsort((ids[b], -(s if digits is None else half_up(s, digits)), a))
                a, b, s = a[rank], b[rank], s[rank]
                keep = np.arange(len(a)) - np.searchsorted(a, a) < n
                yield pd.DataFrame({"id": qid[a[keep]], "item": ids[b[keep]], "score": s[keep]})
    return run


def best_products(queries: DataFrame, items: DataFrame, n: int, over: float = 0.0, digits: int | None = None,
                  block_rows: int = BLOCK_ROWS, fused: bool = False) -> DataFrame:
    """(id, item, score, rank): for each query its ``n`` largest products over ``over`` (at least 0), the
    items in its list ``out`` left aside; ranked by score (to ``digits`` digits, if given), then item.

    ``queries`` is (id, v, out), ``items`` (id, v), ids long and vectors of one width, float or double.
    Exact.  First each query meets two units of items, which bounds its n-th product from below;
    then those units whose largest possible product with it (norms, and the angle to the pivot less
    the unit's largest angle) reaches that bound.  Packs of queries are exchanged, a block of
    items a fixed number of times; a task holds one pack and one block at a time."""
    spark = queries.sparkSession
    kind = dict(queries.dtypes)["v"]
    dtype = "float32" if kind == "array<float>" else "float64"
    blocks, homes, pivots, units = _item_blocks(items, block_rows)
    if not len(pivots):
        return spark.createDataFrame([], "id long, item long, score double, rank int")
    width = pivots.shape[1]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    left = (queries.select("id", F.explode("out").alias("item")).distinct().join(homes, "item")
                   .groupBy("id").agg(F.collect_list(F.struct("unit", "item")).alias("left")))
    none = F.array().cast("array<struct<unit:int,item:bigint>>")
    queries = queries.select("id", "v").join(left, "id", "left").withColumn("left", F.coalesce("left", none))
    queries = materialize(queries.select("id", "v", F.col("left.unit").alias("out_unit"), F.col("left.item").alias("out")).repartition(tasks))
    shared = blocks.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(BLOCK_SHARES - 1)))).repartition(4 * tasks, "unit", "share")

    def met(rows: DataFrame, first: bool, shape: str) -> DataFrame:
        packs = rows.mapInPandas(_choose_units(pivots, units, n, over, first),
                                 f"unit int, share int, qid array<long>, qv {kind}, least array<double>, out_row array<long>, out array<long>")
        return packs.repartition(4 * tasks, "unit", "share").join(shared, ["unit", "share"]).mapInPandas(
            _products_kernel(n, over, width, dtype, digits, first, fused), shape)
    bound = met(queries.withColumn("least", F.lit(float(over))), True, "id long, least double").groupBy("id").agg(F.max("least").alias("least"))
    known = queries.join(bound, "id", "left").withColumn("least", F.coalesce("least", F.lit(float(over))))
    found = met(known.select("id", "v", "out_unit", "out", "least"), False, "id long, item long, score double")
    value = F.col("score") if digits is None else F.round("score", digits)
    return top_k_per_group(found, ["id"], [value.desc(), F.col("item").asc()], n)
