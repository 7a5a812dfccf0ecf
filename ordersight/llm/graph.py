"""Connected components of a link table by hooks to the smallest neighbour and label jumping, all as joins and aggregates."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    A round hooks every node to its smallest neighbour, follows these hooks to their ends by label jumping, and
    rewrites the links between the ends: a link is joined again only while its ends differ, and a star is one node
    after two rounds.  An end that is one still in the next round had its neighbours hooked to it, so two rounds
    leave at most half of the nodes.  A round's tables are written to the shared folder, and no task sees more than
    a split of the links.
    """
    open_links = _plain(links.select(F.col(a).alias("a"), F.col(b).alias("b")))
    labels = None
    while True:
        both = open_links.union(open_links.select("b", "a"))
        hooks = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
        ends = _followed(hooks)
        if labels is None:
            labels = ends
        else:
            labels = stage(labels.join(ends.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select(
                "node", F.coalesce("to", "label").alias("label")), "labels")
        named = lambda c: ends.select(F.col("node").alias(c), F.col("label").alias(f"{c}_end"))
        open_links = _plain(open_links.join(named("a"), "a").join(named("b"), "b").select(F.col("a_end").alias("a"), F.col("b_end").alias("b")))
        if open_links.isEmpty():
            return labels.withColumnRenamed("label", "component")


def _plain(links: DataFrame) -> DataFrame:
    """The links (a, b) between different nodes, once each, a < b."""
    return stage(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")


def _followed(hooks: DataFrame) -> DataFrame:
    """(node, label) with every label followed to the node that is its own label."""
    while True:
        jump = hooks.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = stage(hooks.join(jump, "label").select("node", F.col("far").alias("next"), (F.col("far") < F.col("label")).alias("moved")), "labels")
        hooks = new.select("node", F.col("next").alias("label"))
        if not new.agg(F.max("moved")).first()[0]:
            return hooks


def merged(known: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) of ``known`` after further links (a, b): only the links' components are walked."""
    if links.isEmpty():
        return known
    name = lambda c: known.select(F.col("node").alias(c), F.col("component").alias(f"{c}_of"))
    between = links.join(name("a"), "a", "left").join(name("b"), "b", "left").select(
        F.coalesce("a_of", "a").alias("a"), F.coalesce("b_of", "b").alias("b")).filter("a <> b").distinct()
    new = components(between)
    moved = known.join(new.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left").select(
        "node", F.coalesce("to", "component").alias("component"))
    return stage(moved.union(new.join(known, "node", "left_anti").select("node", "component")), "components")
