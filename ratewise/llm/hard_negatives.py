"""Hard negatives of anchors, by Fagin's threshold algorithm over blocks of candidates.

Vectors are made whole numbers, ``floor(256 * x)`` for each component, so every score
is an exact integer inner product and doesn't depend on the order of its sum.

Blocks.  All rows are dealt into blocks of about ``BLOCK`` by a hash of their place, anchors
into slabs of about ``SLAB``; each slab meets each block in one task, which holds
one block and one slab.  This is a stated query set against all rows, in blocks.
Threshold algorithm.  A block has, for each dimension, the list of its rows sorted by
that component.  An anchor reads each list from the top where its own component is
positive and from the bottom where it is negative (dimensions at 0 add nothing), a
stretch of all lists at a time; each row that it meets for the first time is looked
up and scored in full.  What a row not met so far can score at most is the threshold: the sum,
over all dimensions, of the anchor's component times the value reached in its list.
Once that lies strictly below the k-th best score of each of the anchor's windows (or, where
a window isn't full, below its lower end), no row left can change the result, ties included,
and the anchor's search of the block ends.
Positives come first (one window without bounds over the rows of the same label), then the
negatives, one window a positive; the blocks' best are merged by a ranking per anchor and
window, of at most ``k`` rows from each block.

Defined results: rows without an id, with a null label, a null vector or a null or
non-finite component take no part; components beyond 2^27 are held there, so that
scores of up to 511 dimensions fit a long; a shorter vector counts as ended with zeros, an empty
one scores 0 with all; rows of equal id are rows of their own, each of them an anchor where its
id is one; ties go by smaller id; a negative positive score has an empty window;
an empty table gives an empty result; further columns may have any name."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import Scratch, kernel, written

BLOCK = 8192
SLAB = 512
POSITIVES = NEGATIVES = 5
#: The window of a positive's score, in hundredths.
LOWEST, HIGHEST = 80, 100
_MOST = 1 << 27


# -- the threshold algorithm within one block ---------------------------------------

class SortedLists:
    """A block of vectors with its list of rows for each dimension, best first."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.order = np.argsort(-matrix, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(matrix.T, self.order, axis=1)
        self.widest = int(np.abs(matrix).max(initial=0))
        self.floats = matrix.astype(np.float64)

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Random access: the whole scores of some rows."""
        if self.widest * int(np.abs(anchor).max(initial=0)) * max(1, len(anchor)) < 1 << 53:
            return np.rint(self.floats[rows] @ anchor.astype(np.float64)).astype(np.int64)  # exact below 2^53
        return self.matrix[rows] @ anchor

    def search(self, anchor: np.ndarray, eligible: np.ndarray, ids: np.ndarray, k: int, windows: list[tuple[int | None, int | None]],
               step: int = 64) -> tuple[list[np.ndarray], np.ndarray, int]:
        """The first ``k`` eligible rows of each window (lowest, highest score), by score and
        id; all rows' scores as far as met; the depth at which the search ended."""
        n = len(self.matrix)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met = np.zeros(n, bool)
        score = np.zeros(n, np.int64)
        low, high = 0, min(n, step)
        if not len(up) and not len(down):
            met[:] = True  # all rows score 0
            low = high = n
        while low < n:
            seen = np.zeros(n, bool)
            seen[self.order[up, low:high]] = True
            seen[self.order[down, n - high:n - low]] = True
            new = np.flatnonzero(seen & ~met)
            met[new] = True
            score[new] = self.scores(new, anchor)
            low = high
            if low < n:
                threshold = int(self.values[up, low - 1] @ anchor[up] + self.values[down, n - low] @ anchor[down])
                rows = np.flatnonzero(met & eligible)
                if all(self._settled(score[rows], w, k, threshold) for w in windows):
                    break
                high = min(n, 2 * low)
        rows = np.flatnonzero(met & eligible)
        best = []
        for least, most in windows:
            own = rows[_inside(score[rows], least, most)]
            best.append(own[np.lexsort((ids[own], -score[own]))[:k]])
        return best, score, low

    @staticmethod
    def _settled(scores: np.ndarray, window: tuple[int | None, int | None], k: int, threshold: int) -> bool:
        """True if no row that scores the threshold or less can enter the window's first k."""
        least, most = window
        if least is not None and (threshold < least or (most is not None and most < least)):
            return True
        own = scores[_inside(scores, least, most)]
        return len(own) >= k and threshold < int(np.partition(own, len(own) - k)[len(own) - k])


def _inside(scores: np.ndarray, least: int | None, most: int | None) -> np.ndarray:
    out = np.ones(len(scores), bool)
    if least is not None:
        out &= scores >= least
    if most is not None:
        out &= scores <= most
    return out


def score_window(score: int, lowest: int = LOWEST, highest: int = HIGHEST) -> tuple[int, int]:
    """The whole scores s with lowest * score <= 100 * s <= highest * score."""
    return -(-lowest * score // 100), highest * score // 100


# -- rows, blocks, tiles ---------------------------------------------------------------

def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, short ones ended with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(id, label, v) of the rows that take part; v has whole components."""
    x = F.col(vector_col)
    fine = ~F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    v = F.transform(x, lambda c: F.greatest(F.least(F.floor(c.cast("double") * 256), F.lit(_MOST)), F.lit(-_MOST)).cast("int"))
    return (rows.where(F.col(id_col).isNotNull() & x.isNotNull() & fine)
                .select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v")).where("label is not null"))


def _tiles(anchors: DataFrame, rows: DataFrame, n_blocks: int, n_slabs: int, shape: str, search: Callable[[pa.Table, pa.Table], pa.Table]) -> DataFrame:
    """``search`` on each slab of anchors with each block of rows."""
    blocks, slabs = F.sequence(F.lit(0), F.lit(n_blocks - 1)), F.sequence(F.lit(0), F.lit(n_slabs - 1))
    # the two sides come from one table; other names keep their columns apart
    left = (anchors.withColumn("slab", F.pmod(F.xxhash64("at"), F.lit(n_slabs)).cast("int")).withColumn("block", F.explode(blocks))
                   .withColumnsRenamed({c: f"a_{c}" for c in [*anchors.columns, "slab", "block"]}))
    right = rows.withColumn("block", F.pmod(F.xxhash64("at"), F.lit(n_blocks)).cast("int")).withColumn("slab", F.explode(slabs))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return empty
        return search(a, b)
    empty = _empty(shape)
    return left.groupBy("a_block", "a_slab").cogroup(right.groupBy("block", "slab")).applyInArrow(meet, shape)


def _empty(shape: str) -> pa.Table:
    return pa.table({part.split()[0]: pa.array([], pa.int32() if part.split()[1] == "int" else pa.int64()) for part in shape.split(", ")})


def _table(shape: str, columns: list[list[np.ndarray]]) -> pa.Table:
    empty = _empty(shape)
    if not columns:
        return empty
    return pa.table({f.name: pa.array(np.concatenate([c[i] for c in columns]), f.type) for i, f in enumerate(empty.schema)})


_POSITIVE = "at long, anchor_id long, label long, positive_id long, positive_score long"
_NEGATIVE = "at long, anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long"


def hard_negatives(rows: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST, highest: int = HIGHEST,
                   block: int = BLOCK, slab: int = SLAB) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on column ``id``, ``label`` the label as an expression
    of the input's columns."""
    spark = kernel(rows)
    with Scratch(spark, "hard-negatives") as tmp:
        table = tmp.keep(whole_vectors(rows, id_col, vector_col, label), "whole")
        # the place of a row in the written table tells rows of equal id apart
        table = tmp.keep(table.withColumn("at", F.monotonically_increasing_id()), "rows")
        anchors = table.where(is_anchor)
        n_rows, width = table.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
        n_blocks, n_slabs = max(1, -(-n_rows // block)), max(1, -(-anchors.count() // slab))

        def nearest(a: pa.Table, b: pa.Table) -> pa.Table:
            lists, out = SortedLists(_matrix(b["v"], width)), []
            vectors, ids, labels, places = _matrix(a["a_v"], width), b["id"].to_numpy(), b["label"].to_numpy(), b["at"].to_numpy()
            for i, (at, anchor_id, own) in enumerate(zip(*(a[f"a_{c}"].to_pylist() for c in ("at", "id", "label")))):
                (best,), score, _ = lists.search(vectors[i], (labels == own) & (places != at), ids, positives, [(None, None)])
                n = len(best)
                out.append([np.full(n, at), np.full(n, anchor_id), np.full(n, own), ids[best], score[best]])
            return _table(_POSITIVE, out)

        first = Window.partitionBy("at").orderBy(F.desc("positive_score"), "positive_id")
        found = _tiles(anchors, table, n_blocks, n_slabs, _POSITIVE, nearest).withColumn("place", F.row_number().over(first))
        found = found.where(F.col("place") <= positives)
        windows = found.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("windows"))
        asked = tmp.keep(anchors.join(windows, "at"), "anchors")

        def hardest(a: pa.Table, b: pa.Table) -> pa.Table:
            lists, out = SortedLists(_matrix(b["v"], width)), []
            vectors, ids, labels = _matrix(a["a_v"], width), b["id"].to_numpy(), b["label"].to_numpy()
            for i, (at, anchor_id, own, wanted) in enumerate(zip(*(a[f"a_{c}"].to_pylist() for c in ("at", "id", "label", "windows")))):
                bounds = [score_window(w["positive_score"], lowest, highest) for w in wanted]
                best, score, _ = lists.search(vectors[i], labels != own, ids, negatives, bounds)
                for w, rows_ in zip(wanted, best):
                    n = len(rows_)
                    out.append([np.full(n, at), np.full(n, anchor_id), np.full(n, w["place"]), np.full(n, w["positive_id"]),
                                np.full(n, w["positive_score"]), ids[rows_], score[rows_]])
            return _table(_NEGATIVE, out)

        order = Window.partitionBy("at", "place").orderBy(F.desc("negative_score"), "negative_id")
        ranked = (_tiles(asked, table, n_blocks, n_slabs, _NEGATIVE, hardest).withColumn("rank", F.row_number().over(order))
                  .where(F.col("rank") <= negatives))
        return written(ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")
