"""Connected components of an undirected graph held in a table."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize, release


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in edges(a, b); component = smallest id reachable.

    The graph is contracted first: every b goes to its smallest a, and what is left are the edges
    between such ends. So a star of any size is one end, and the rounds run over few rows if the a's
    are few. Each round takes the smallest label among the neighbours and then follows labels once
    more (pointer jumping), so rounds grow with the logarithm of a group's width. Labels stay in
    tables; the driver sees whether any changed. Null ids are ignored; an empty table gives an empty
    table.
    """
    links = materialize(edges.where("a is not null and b is not null and a <> b").select("a", "b").distinct(), "links")
    heads = links.groupBy("b").agg(F.min("a").alias("head"))
    between = links.join(heads, "b").select(F.col("a").alias("u"), F.col("head").alias("v"))
    own = heads.join(links.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select(F.col("b").alias("u"), F.col("head").alias("v"))
    labels = _labels(between.union(own).where("u <> v").distinct())

    members = heads.select(F.col("b").alias("id"), "head")
    tops = links.select(F.col("a").alias("id")).distinct().join(members.select("id"), "id", "left_anti").select("id", F.col("id").alias("head"))
    placed = members.union(tops).join(labels.select(F.col("node").alias("head"), "label"), "head", "left").select("id", F.coalesce("label", "head").alias("part"))
    least = placed.groupBy("part").agg(F.min("id").alias("component"))
    return materialize(placed.join(least, "part").select("id", "component"), "components")


def _labels(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for the nodes of edges(u, v)."""
    both = materialize(edges.union(edges.select("v", "u")).distinct(), "edges")
    before = labels = materialize(
        both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("label")), "labels0"
    )
    for n in count(1):
        of = labels.select(F.col("node").alias("v"), F.col("label").alias("of_v"))
        near = both.join(of, "v").groupBy(F.col("u").alias("node")).agg(F.min("of_v").alias("m"))
        least = labels.join(near, "node", "left").select("node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = materialize(least.join(jump, "label", "left").select("node", F.least("label", "next").alias("label"), "was"), f"labels{n}")
        release(before)
        before, labels = after, after.select("node", "label")
        if not after.where("label <> was").take(1):
            release(both)
            return labels
