"""Substring dedup by relative Lempel-Ziv parsing.

Documents are parsed into factors: copies of text that occurs earlier (in a
document of smaller id, or earlier in the same document).  A reference block
is a group of documents read together; its index maps the hash of each
20-word window to the window's first start in the block.  A document is
factored greedily: a factor grows while the next window continues at the next
word of the same source, and ends at the first one that doesn't.  Factors of
at least 20 words are duplicate spans.

Every document meets every block through one exchange of the block indexes,
keyed by content, not through pairs of blocks:

1.  Anchors.  Each 20-word window names its smallest 8-word hash (winnowing), so
    equal windows name equal anchors; about one word in seven is an anchor.
    One aggregation finds the anchors that occur more than once.  They go into
    a bitmap of fixed size (``FILTER_BITS``), which may let too much through,
    never too little.
2.  Blocks.  A second scan keeps the windows with such an anchor.  In its block,
    every occurrence of a window but the first is a factor already; only the
    first goes into the exchange.  A passage that a third of all documents
    share therefore costs one row a block, not one a document.
3.  Exchange by anchor, sorted: each run of windows of one anchor is parsed
    against the earliest start of each window in any block.  A window matches
    only if its own hash and that of its anchor both do.
4.  Assembly.  Factor pieces are collected by document (bounded by its words),
    joined at factor boundaries, and the words they cover are removed.

Defined results: a null text has no words; texts under 20 words keep all;
ids are integers, a null id sorts before all others; two rows with the same id
are one document as far as order goes (only a smaller start is earlier), their
texts are cleaned each by itself; a very long text is one block, read whole; an empty table gives an
empty result; further columns may have any name."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import bitmap_of, hashed_words, in_bitmap, kernel, shingle_hashes, text_groups

WINDOW = 20
ANCHOR = 8
FILTER_BITS = 26
BLOCK_BYTES = 4 << 20
_NULL_ID = -(1 << 63)


class _Block:
    """Word hashes of a group of texts and the anchors of its windows."""

    def __init__(self, texts: list[str], window: int, anchor: int):
        self.words, self.lengths = hashed_words(texts)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        counts = np.maximum(self.lengths - window + 1, 0)
        total = int(counts.sum())
        #: each window's document and its start among the block's words
        self.doc = np.repeat(np.arange(len(texts)), counts)
        self.start = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + self.offsets[self.doc]
        if total:
            grams = shingle_hashes(self.words, anchor)
            low = np.lib.stride_tricks.sliding_window_view(grams, window - anchor + 1)
            self.anchor_at = self.start + low.argmin(axis=1)[self.start]
            self.anchor = grams[self.anchor_at]
        else:
            self.anchor_at, self.anchor = np.empty(0, np.int64), np.empty(0, np.uint64)


def _breaks(*same: np.ndarray) -> np.ndarray:
    """Starts of the runs in which no condition of ``same`` (for rows 1..) fails."""
    ok = np.logical_and.reduce(same)
    return np.flatnonzero(np.concatenate([[True], ~ok]))


def _first_of_each(doc: np.ndarray, at: np.ndarray, anchor: np.ndarray, window: np.ndarray) -> np.ndarray:
    """For each window, the index of the earliest equal one."""
    order = np.lexsort((at, doc, window, anchor))
    a, w = anchor[order], window[order]
    head = np.concatenate([[True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])]) if len(a) else np.empty(0, bool)
    first = np.empty(len(order), np.int64)
    first[order] = order[np.flatnonzero(head)[np.cumsum(head) - 1]] if len(a) else order
    return first


_PIECES = "anchor long, doc long, th long, start int, n int, ref_doc long, ref_start int, windows array<long>"
_PIECE_NAMES = ["anchor", "doc", "th", "start", "n", "ref_doc", "ref_start", "windows"]


def _pieces(anchor, doc, th, start, n, ref_doc=None, ref_start=None, windows=None) -> pa.RecordBatch:
    rows = len(doc)
    null = lambda t: pa.nulls(rows, t)
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor, pa.int64()), pa.array(doc, pa.int64()), pa.array(th, pa.int64()), pa.array(start.astype(np.int32)),
         pa.array(n.astype(np.int32)), null(pa.int64()) if ref_doc is None else pa.array(ref_doc, pa.int64()),
         null(pa.int32()) if ref_start is None else pa.array(ref_start.astype(np.int32)),
         null(pa.list_(pa.int64())) if windows is None else windows], _PIECE_NAMES)


def _factor_runs(doc, row, start, ref_doc, ref_start) -> tuple[np.ndarray, np.ndarray]:
    """First windows and numbers of windows of the greedy factors among matched windows in text order."""
    at = _breaks(row[1:] == row[:-1], start[1:] == start[:-1] + 1, ref_doc[1:] == ref_doc[:-1], ref_start[1:] == ref_start[:-1] + 1)
    return at, np.diff(np.append(at, len(doc)))


def duplicate_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Factor pieces (doc, th, start, n, ref_doc, ref_start): windows start ..
    start + n - 1 of the document (its id, and the hash of its text) occur
    earlier, from ref_start in ref_doc on."""
    spark = kernel(docs)
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc"), F.col(text_col).alias("text"),
                      F.xxhash64(F.col(text_col)).alias("th")).where(F.col("text").isNotNull())

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_groups(batches, "text", BLOCK_BYTES):
            block = _Block(b.column("text").to_pylist(), window, anchor)
            once = block.anchor[_breaks(block.anchor_at[1:] == block.anchor_at[:-1])] if len(block.anchor) else block.anchor
            h, n = np.unique(once, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    repeated = (src.select("text").mapInArrow(anchors, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
                   .where("n > 1"))
    shared = spark.sparkContext.broadcast(bitmap_of(repeated, "h", FILTER_BITS))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for b in text_groups(batches, "text", BLOCK_BYTES):
            block = _Block(b.column("text").to_pylist(), window, anchor)
            keep = np.flatnonzero(in_bitmap(bits, block.anchor, FILTER_BITS))
            if not len(keep):
                continue
            ids, th = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "th"))
            row, at = block.doc[keep], block.start[keep]
            pos, a = at - block.offsets[row], block.anchor[keep].view(np.int64)
            h = shingle_hashes(block.words, window, seed=1)[at].view(np.int64)
            doc = ids[row]
            first = _first_of_each(doc, pos, a, h)
            later = (doc != doc[first]) | (pos != pos[first])
            new = np.flatnonzero(~later)
            if len(new):
                aa = block.anchor_at[keep][new]
                cut = _breaks(row[new][1:] == row[new][:-1], pos[new][1:] == pos[new][:-1] + 1, aa[1:] == aa[:-1])
                ends = np.append(cut, len(new)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(h[new]))
                yield _pieces(a[new][cut], doc[new][cut], th[row[new][cut]], pos[new][cut], np.diff(ends), windows=lists)
            old = np.flatnonzero(later)
            if len(old):
                src_ = first[old]
                cut, n = _factor_runs(doc[old], row[old], pos[old], doc[src_], pos[src_])
                yield _pieces(a[old][cut], doc[old][cut], th[row[old][cut]], pos[old][cut], n, doc[src_][cut], pos[src_][cut])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by anchor; works on whole anchors, some at a time."""
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            done = b.filter(pc.is_null(b.column("windows")))
            if done.num_rows:
                yield _found(done)
            b = b.filter(pc.is_valid(b.column("windows")))
            if not b.num_rows:
                continue
            held.append(b)
            size += b.num_rows
            if size >= 50_000:
                table = pa.Table.from_batches(held).combine_chunks()
                last = table.column("anchor")[-1]
                split = int(pc.sum(pc.not_equal(table.column("anchor"), last)).as_py() or 0)
                if split:
                    yield from _match(table.slice(0, split))
                held = table.slice(split).to_batches()
                size = 0 if split else size  # a hot anchor waits for its end
        if held:
            yield from _match(pa.Table.from_batches(held).combine_chunks())

    rows = src.mapInArrow(index, _PIECES).repartition("anchor").sortWithinPartitions("anchor")
    return rows.mapInArrow(parse, "doc long, th long, start int, n int, ref_doc long, ref_start int")


def _found(b: pa.RecordBatch) -> pa.RecordBatch:
    return b.select(["doc", "th", "start", "n", "ref_doc", "ref_start"])


def _match(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Factors of windows that occur earlier in any block."""
    lists = table.column("windows").combine_chunks()
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    h = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(n)), n)
    pos = table.column("start").to_numpy()[row] + np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
    doc, a = table.column("doc").to_numpy()[row], table.column("anchor").to_numpy()[row]
    first = _first_of_each(doc, pos, a, h)
    old = np.flatnonzero((doc != doc[first]) | (pos != pos[first]))
    if not len(old):
        return
    src = first[old]
    cut, runs = _factor_runs(doc[old], row[old], pos[old], doc[src], pos[src])
    yield _found(_pieces(a[old][cut], doc[old][cut], table.column("th").to_numpy()[row[old][cut]], pos[old][cut], runs,
                         doc[src][cut], pos[src][cut]))


def _cover(words: list[bytes], pieces: list[dict], window: int) -> tuple[list[bytes], list[dict]]:
    """The words no factor covers, and the factors, joined where one continues another."""
    factors: list[dict] = []
    gone = np.zeros(len(words) + 1, np.int32)
    for p in sorted(pieces, key=lambda p: (p["start"], p["ref_doc"], p["ref_start"])):
        gone[p["start"]] += 1
        gone[min(len(words), p["start"] + p["n"] + window - 1)] -= 1
        last = factors[-1] if factors else None
        if last and (last["start"] + last["n"], last["ref_doc"], last["ref_start"] + last["n"]) == (p["start"], p["ref_doc"], p["ref_start"]):
            last["n"] += p["n"]
        else:
            factors.append(dict(p))
    keep = np.cumsum(gone[:-1]) == 0
    for f in factors:
        f["n_words"] = f.pop("n") + window - 1
    return [w for w, k in zip(words, keep.tolist()) if k], factors


def dedup_substrings(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept, factors) of every row of ``docs``:
    ``kept`` is the remaining words joined by one space, ``factors`` the
    duplicate spans (start, n_words, ref_doc, ref_start) in words."""
    spans = duplicate_spans(docs, window, anchor, id_col, text_col)
    spans = spans.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "n", "ref_doc", "ref_start")).alias("pieces"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.xxhash64(F.col(text_col)).alias("th"))
    both = texts.join(spans, ["doc", "th"], "left").select("doc_id", "text", "pieces")
    kind = both.schema["doc_id"].dataType.simpleString()
    factor = pa.list_(pa.struct([("start", pa.int32()), ("n_words", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_groups(batches, "text", BLOCK_BYTES):
            total, removed, kept, found = [], [], [], []
            for text, pieces in zip(b.column("text").to_pylist(), b.column("pieces").to_pylist()):
                words = text.encode().split()
                left, factors = _cover(words, pieces, window) if pieces else (words, [])
                total.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
                found.append(factors)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string()), pa.array(found, factor)],
                ["doc_id", "n_words", "n_removed", "kept", "factors"])

    return both.mapInArrow(clean, f"doc_id {kind}, n_words long, n_removed long, kept string, "
                                  "factors array<struct<start: int, n_words: int, ref_doc: long, ref_start: int>>")
