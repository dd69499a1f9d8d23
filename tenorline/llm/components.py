"""Connected components as repeated star contractions of an edge table."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, functions as F

from tenorline.llm.shared import gathered, written


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node has either one smaller neighbour, without smaller ones itself, or none."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return (ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
            .filter("below > 1 or (below = 1 and above = 1)").isEmpty())


def connected_components(edges: DataFrame, left: str, right: str, rows: int | None = None) -> DataFrame:
    """(node, component) for every node on an edge; a component is named by its smallest node.

    Large-star and small-star steps alternate: each node's larger neighbours, then its
    smaller ones, are tied to the smallest node it sees. Every step is a grouped minimum
    and a join, so a hub is combined before the shuffle, and the number of rounds grows
    with the logarithm of the longest chain. Each round is written to the shared folder.
    Edges that are loops or hold a null are left out; repeated edges count once. An empty
    edge table gives an empty result. ``rows``, the number of rows that the
    edges come from, lets small rounds be written in few files.
    """
    u, v = F.col(left), F.col(right)
    kept = written if rows is None else partial(gathered, rows=rows)
    now = kept(edges.filter(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
                  .distinct(), "edges")
    while not _only_stars(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(smallest, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(now.groupBy("u").agg(F.min("v").alias("v")))
                 .filter("u > v").distinct())
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(smallest, "u").filter("v > m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(smallest.withColumnRenamed("m", "v")).distinct())
        now = kept(small, "edges")
    stars = now.groupBy("u").agg(F.min("v").alias("component"))
    return kept(
        stars.select(F.col("u").alias("node"), "component")
        .unionByName(stars.select(F.col("component").alias("node"), "component")).distinct(),
        "components")
