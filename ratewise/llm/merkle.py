"""Merkle manifest of a table of documents, by a butterfly exchange.

Every row is a leaf.  The leaves of a source, in order of doc_id, are the lowest
level of the source's tree; sixteen consecutive nodes have one parent.  The
sources' roots, in order of source, are the leaves of a tree of the same kind, whose
root stands for the table.

Positions.  Narrow rows (source, doc_id, digests) are range-partitioned in this
order; a table with one row for each source and partition gives the place at which
each partition's part of a source begins, so no source is sorted in one task.
Blocks.  An aligned run of ``16 ** LEVELS`` leaves of a source is one partition of
the exchange: one row, whose lowest levels are hashed in one task.
Butterfly.  In round r each block knows the node above it at level r.  The blocks
whose numbers agree in all hexadecimal digits but the r-th form a group of at most
sixteen: they swap these nodes, and every one of them hashes the parent for itself
and keeps its siblings.  The last node of a level may hold fewer blocks than
its siblings; its blocks then stand in, in turn, for those that it lacks, so that
every group is whole.  After the last round each block has its source's root and all
upper proof parts; nothing is sent down the tree.  The sources' roots go through the
same rounds, and a block reads its source's part by one join on the source's number.

Bounds: a group holds sixteen nodes, a block ``16 ** LEVELS`` leaves, the table of
offsets one row for each source and partition.  Only the largest number of leaves of a
source and the number of sources reach the driver.

Defined results: a null in any column is hashed as ``-``; empty and very long texts
are hashed whole; a null source is a source of its own, before the others; rows of
equal id in a source stand in order of their leaves' digests, a null id first;
repeated rows are leaves of their own; an empty table gives an empty result; further columns
of the input are left alone and may have any name."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import Scratch, ascii_lower, kernel, written
from ratewise.operators.ranking import global_row_number

FANOUT_BITS = 4
FANOUT = 1 << FANOUT_BITS
#: Levels that are hashed within one block.
LEVELS = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _h(s: str) -> str:
    return sha256(s.encode()).hexdigest()


# -- leaves and their positions ------------------------------------------------

def leaf_digest(row: dict[str, Column]) -> Column:
    """Lowercase hex sha256 of the fields in order: ``-`` or length, colon, value."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*(field(row[name]) for name in FIELDS)), 256)


def tampered(doc_id: Column) -> Column:
    """Rows of the tampering test: 5 divides the crc32 of the decimal id (never so for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaf_rows(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """(source, doc_id, leaf, bad): the digest of each row and, where ``changed`` holds and
    the text differs, that of the row with its text's A-Z lower-cased; both as 32 bytes."""
    row = {name: F.col(name) for name in FIELDS}
    bad = leaf_digest(row | {"text": ascii_lower(F.col("text"))})
    bad = F.when(changed, F.unhex(bad)) if changed is not None else F.lit(None).cast("binary")
    return docs.select("source", "doc_id", F.unhex(leaf_digest(row)).alias("leaf"), bad.alias("bad"))


def numbered(tmp: Scratch, leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves as (sid, total, pos, doc_id, leaf, bad) and the sources as (sid, source):
    number of the source from 0, its number of leaves, the leaf's place in it."""
    spark, order = leaves.sparkSession, ["source", "doc_id", "leaf", "bad"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = tmp.keep(leaves.repartitionByRange(n, *order).sortWithinPartitions(*order)
                             .withColumn("at", F.monotonically_increasing_id()), "ordered")
    ordered = ordered.withColumn("part", F.shiftright("at", 33))
    runs = ordered.groupBy("source", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    runs = tmp.keep(runs, "runs")
    sources = runs.groupBy("source").agg(F.sum("n").alias("total"))
    sources = tmp.keep(global_row_number(sources, [F.col("source").asc_nulls_first()], "sid").withColumn("sid", F.col("sid") - 1), "sources")
    # as many rows of a source as partitions, however large it is
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    starts = (starts.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
                    .select(F.col("source").alias("s"), F.col("part").alias("p"), "first", "start", "sid", "total"))
    placed = ordered.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    pos = F.col("at") - F.col("first") + F.col("start")
    return placed.select("sid", "total", pos.alias("pos"), "doc_id", "leaf", "bad"), sources


# -- within a block --------------------------------------------------------------

def block_levels(leaves: list[str], total: int, levels: int) -> list[list[str]]:
    """Nodes of a block, level by level, as far as the source's tree of ``total`` leaves goes up."""
    out, nodes_above = [leaves], total
    for _ in range(levels):
        if nodes_above <= 1:
            break
        low = out[-1]
        out.append([_h("".join(low[i:i + FANOUT])) for i in range(0, len(low), FANOUT)])
        nodes_above = -(-nodes_above // FANOUT)
    return out


def around(level: list[str], i: int) -> tuple[str, str]:
    """The siblings of node ``i``, those before and those after it."""
    run = i - i % FANOUT
    return "".join(level[run:i]), "".join(level[i + 1:run + FANOUT])


def fold_up(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings, level by level, lead to."""
    for before, after in path:
        leaf = _h(before + leaf + after)
    return leaf


# -- the butterfly ------------------------------------------------------------------

def _count_at(level: int) -> Column:
    return F.ceil(F.col("count") / F.lit(1 << (FANOUT_BITS * level)))


def rounds_for(most: int) -> int:
    """Rounds until one node is left of ``most``."""
    n = 0
    while most > 1:
        most, n = -(-most // FANOUT), n + 1
    return n


def butterfly(nodes: DataFrame, rounds: int) -> DataFrame:
    """(tree, count, j, hash, ups) after all rounds: ``hash`` is the tree's root for every
    node j of the ``count`` nodes that the tree began with, ``ups`` its siblings before
    and after it on each level."""
    state = nodes.withColumn("ups", F.array().cast("array<struct<before:string,after:string>>"))
    for r in range(rounds):
        width = 1 << (FANOUT_BITS * r)
        q, slot = F.shiftright("j", FANOUT_BITS * r), F.col("j").bitwiseAND(F.lit(width - 1))
        held = F.least(F.lit(width), F.col("count") - q * width)
        # a short node with older siblings lends its blocks to the places that it lacks
        stands = F.when(q.bitwiseAND(F.lit(FANOUT - 1)) > 0, F.sequence(slot, F.lit(width - 1).cast("long"), held)).otherwise(F.array(slot))
        sent = state.select("tree", "count", "j", "hash", "ups", q.alias("q"), slot.alias("own"), F.explode(stands).alias("slot"))
        real = F.col("own") == F.col("slot")
        entry = F.struct(F.col("q").bitwiseAND(F.lit(FANOUT - 1)).alias("digit"), "hash", "j", real.alias("real"), F.when(real, F.col("ups")).alias("ups"))
        met = (sent.groupBy("tree", "count", F.shiftright("q", FANOUT_BITS).alias("q"), "slot")
                   .agg(F.array_sort(F.collect_list(entry), lambda a, b: (a["digit"] - b["digit"]).cast("int")).alias("group")))
        parent = F.sha2(F.array_join(F.transform("group", lambda x: x["hash"]), ""), 256)
        parent = F.when(_count_at(r) > 1, parent).otherwise(F.element_at("group", 1)["hash"])
        each = met.select("tree", "count", parent.alias("hash"), "group", F.explode(F.filter("group", lambda x: x["real"])).alias("e"))

        def side(keep):
            return F.array_join(F.transform(F.filter("group", keep), lambda x: x["hash"]), "")
        step = F.struct(side(lambda x: x["digit"] < F.col("e.digit")).alias("before"), side(lambda x: x["digit"] > F.col("e.digit")).alias("after"))
        ups = F.when(_count_at(r) > 1, F.concat("e.ups", F.array(step))).otherwise(F.col("e.ups"))
        state = each.select("tree", "count", F.col("e.j").alias("j"), "hash", ups.alias("ups"))
    return state


# -- the manifest ----------------------------------------------------------------------

def manifest(docs: DataFrame, changed: Column | None = None, levels: int = LEVELS, proofs: bool = True) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, with
    ``proof``, the siblings before and after it level by level up to the root, if ``proofs``.
    ``proof_sha256`` hashes these siblings in order; ``folded_root`` is recomputed from them and
    the row's leaf, which is the tampered one where ``changed`` holds."""
    spark = kernel(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    block_bits = FANOUT_BITS * levels
    with Scratch(spark, "merkle") as tmp:
        # written first: the ranges are found from a sample, which would hash all texts once more
        leaves, sources = numbered(tmp, tmp.keep(leaf_rows(docs, changed), "leaves"))
        blocks = tmp.keep(leaves.groupBy("sid", "total", F.shiftright("pos", block_bits).alias("j"))
                                .agg(F.array_sort(F.collect_list(F.struct("pos", "doc_id", "leaf", "bad")),
                                                  lambda a, b: (a["pos"] - b["pos"]).cast("int")).alias("rows")), "blocks")

        def local_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = []
                for total, rows in zip(b.column("total").to_pylist(), b.column("rows")):
                    digests = rows.values.field("leaf").to_pylist() if rows.is_valid else []
                    found.append(block_levels([x.hex() for x in digests], total, levels)[-1][0])
                yield pa.RecordBatch.from_arrays([b.column("sid"), b.column("total"), b.column("j"), pa.array(found, pa.string())], ["sid", "total", "j", "hash"])

        roots = blocks.mapInArrow(local_roots, "sid long, total long, j long, hash string")
        most, n_sources = sources.agg(F.max("total"), F.count("*")).first()
        width = F.ceil(F.col("total") / F.lit(1 << block_bits))
        most_blocks = -(-(most or 0) // (1 << block_bits))
        inner = tmp.keep(butterfly(roots.select(F.col("sid").alias("tree"), width.alias("count"), "j", "hash"), rounds_for(most_blocks)), "inner")
        tops = inner.where("j = 0").select(F.lit(0).cast("long").alias("tree"), F.lit(n_sources).cast("long").alias("count"), F.col("tree").alias("j"), "hash")
        outer = butterfly(tops, rounds_for(n_sources)).select(F.col("j").alias("sid"), F.col("hash").alias("root"), F.col("ups").alias("outer_ups"))
        known = (blocks.join(inner.select(F.col("tree").alias("sid"), "j", F.col("hash").alias("subroot"), "ups"), ["sid", "j"])
                       .join(outer, "sid").select("total", "rows", "subroot", "root", "ups", "outer_ups"))

        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] + ["proof"] * proofs
        step = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))

        def one_block(b: pa.RecordBatch) -> pa.RecordBatch:
            rows, total = b.column("rows")[0].values, b.column("total")[0].as_py()
            root, subroot = b.column("root")[0].as_py(), b.column("subroot")[0].as_py()
            upper = [(u["before"], u["after"]) for u in b.column("ups")[0].as_py() + b.column("outer_ups")[0].as_py()]
            own = [x.hex() for x in rows.field("leaf").to_pylist()]
            tree = block_levels(own, total, levels)
            paths, digests, ends = [], [], []
            for i, bad in enumerate(rows.field("bad").to_pylist()):
                path = [around(level, i >> (FANOUT_BITS * h)) for h, level in enumerate(tree[:-1])] + upper
                digests.append(_h("".join(x + y for x, y in path)))
                ends.append(fold_up(own[i] if bad is None else bad.hex(), path))
                if proofs:
                    paths.append([{"before": x, "after": y} for x, y in path])
            n = len(own)
            return pa.RecordBatch.from_arrays(
                [rows.field("doc_id"), pa.array(own), pa.array([subroot] * n), pa.array([root] * n), pa.array(digests), pa.array(ends),
                 pa.array([x == root for x in ends])] + [pa.array(paths, step)] * proofs, names)

        def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for k in range(b.num_rows):
                    yield one_block(b.slice(k, 1))

        shape = (f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
                 + ", proof array<struct<before:string,after:string>>" * proofs)
        return written(known.mapInArrow(unfold, shape), "merkle-manifest")
