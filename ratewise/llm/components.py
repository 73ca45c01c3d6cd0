"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import Scratch


def components(links: DataFrame, tmp: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): every node that has a link, with the smallest node it reaches.

    Each step takes the smallest label among a node and its neighbours and then
    the label of that label (pointer jumping), so the number of steps grows
    with the logarithm of the longest chain.  Only the count of changed nodes
    reaches the driver; each step is written to ``tmp`` and read back (a checkpoint
    would carry the plan's constraints on, which grow with the steps).  A node with
    very many links meets them in an aggregation with map-side combine."""
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = tmp.keep(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links", release=False)
    labels = tmp.keep(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels", release=False)
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("label").alias("near"))
                     .withColumnRenamed("u", "node"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        step = tmp.keep(step.join(up, "label", "left").select("node", "old", F.least("label", "above").alias("label")), "labels", release=False)
        changed = step.where("old <> label").limit(1).count()
        labels = step.select("node", "label")
        if not changed:
            return labels


def merged(labels: DataFrame | None, links: DataFrame, tmp: Scratch) -> DataFrame:
    """(node, label) after further links (a, b).

    Only links between different labels matter: they are contracted to distinct pairs of
    labels, whose components are found by themselves, so what was linked before isn't walked again."""
    if labels is None:
        return components(links, tmp)
    at = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    to = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    ends = links.join(at, "a", "left").join(to, "b", "left").select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb"))
    ends = tmp.keep(ends, "link-labels", release=False)
    joined = components(ends.select("la", "lb").where("la <> lb").distinct(), tmp, "la", "lb")
    nodes = (labels.unionByName(ends.select(F.col("a").alias("node"), F.col("la").alias("label")))
                   .unionByName(ends.select(F.col("b").alias("node"), F.col("lb").alias("label"))).distinct())
    out = nodes.join(joined.select(F.col("node").alias("label"), F.col("label").alias("new")), "label", "left")
    return tmp.keep(out.select("node", F.coalesce("new", "label").alias("label")), "labels", release=False)
