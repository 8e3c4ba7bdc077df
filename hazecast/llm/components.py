"""Connected components of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazecast.session import stored

ROUNDS = 60  # every round at least halves the depth; far more than any real graph needs


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node it can reach.

    A node linked only to itself is its own root; links with a null end are ignored; no links,
    no rows. Each round is written to the shared folder, so a lost executor costs one round. The
    neighbours of a node are never gathered: minima are aggregated map-side, and the joins may
    be split where a node has many links.
    """
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    links = stored(links.where(both).select(high, low).distinct(), "links")
    edges = links.where("u <> v")
    before = _state(edges)
    for _ in range(ROUNDS):
        edges = stored(_small_star(_large_star(edges)), "stars")
        now = _state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    roots = links.select(F.col("v").alias("node")).union(links.select("u")).distinct()
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    moved = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of a node, and the node, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
