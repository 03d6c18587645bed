"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hireflow.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``links`` (a, b); component is the least node reached.

    Alternates between hanging a node's larger neighbours and its smaller ones on the least
    neighbour until all links point to a least node. Each round is one aggregation, which combines
    before the shuffle, and one join with its written result, whose large groups can be split; the
    number of rounds grows with the logarithm of the size.
    """
    edges = written(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.join(written(least, "least"), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = written(
            large.join(written(least, "least"), "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), "m"), F.struct("u", "m"))).alias("x"))
            .select(F.col("x.u").alias("u"), F.col("x.m").alias("v"))
            .where("u <> v")
            .distinct(),
            "edges",
        )
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other, which hangs on none."""
    heads = edges.select(F.col("v").alias("u")).distinct()
    roles = edges.select("u").unionByName(heads).groupBy("u").count()
    return roles.where("count > 1").isEmpty()
