"""Connected components by alternating large-star and small-star, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import Scratch


def _smallest(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Per u the smallest of itself and its neighbours; written, so that a join with it may split a hot u."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return scratch.keep(smallest, name)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u."""
    out = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    ends = out.unionByName(down).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up > 1 or up = 1 and down = 1").isEmpty()


def components(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``links`` (a, b) with long ends to (node, root): each node that has a link, and the smallest it reaches.

    Large-star hangs every larger neighbour of a node on the smallest of its neighbourhood, small-star
    every smaller one and the node itself. Edges never grow in number; rounds grow with the
    logarithm of the nodes. They stop when all edges form stars, of which the driver learns
    yes or no. Links with null ends and from a node to itself are no links; no links give no rows.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = scratch.keep(edges.filter("u <> v").distinct(), f"{name}-0")
    n = 0
    while not _are_stars(edges):
        n += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = _smallest(both, scratch, f"{name}-large-{n}")
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.keep(large.distinct(), f"{name}-stars-{n}")
        smallest = _smallest(large, scratch, f"{name}-small-{n}")
        hung = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = scratch.keep(hung.unionByName(smallest.withColumnRenamed("m", "v").filter("u <> v")).distinct(), f"{name}-{n}")
        scratch.drop(f"{name}-{n - 1}", f"{name}-large-{n}", f"{name}-small-{n}", f"{name}-stars-{n}")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )


def joined_components(roots: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``roots`` with the components joined that ``links`` (a, b) connect; only roots take part in the search."""
    if links.isEmpty():
        return roots
    ends = [roots.select(F.col("node").alias(e), F.col("root").alias(f"root_{e}")) for e in "ab"]
    between = links.join(ends[0], "a", "left").join(ends[1], "b", "left")
    between = between.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    above = components(between, scratch, name).select(F.col("node").alias("under"), F.col("root").alias("above"))
    moved = roots.join(above, F.col("root") == F.col("under"), "left").select("node", F.coalesce("above", "root").alias("root"))
    fresh = above.join(roots.select(F.col("node").alias("under")), "under", "left_anti")
    moved = moved.unionByName(fresh.select(F.col("under").alias("node"), F.col("above").alias("root")))
    return scratch.keep(moved, f"{name}-joined")


def links_of_documents(rows: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) between the nodes of one document: ``rows`` has doc_id and digest, ``nodes`` digest and node.

    A document with several texts has a node for each, named by the smallest doc_id that has the text.
    """
    several = rows.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    several = several.filter("low <> high").select("doc_id")
    named = rows.join(several, "doc_id", "left_semi").select("doc_id", "digest").distinct()
    named = scratch.keep(named.join(nodes.select("digest", "node"), "digest").select("doc_id", "node"), "several")
    smallest = named.groupBy("doc_id").agg(F.min("node").alias("a"))
    return named.join(smallest, "doc_id").select("a", F.col("node").alias("b")).filter("a < b")
