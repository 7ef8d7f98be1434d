"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsift.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(
        edges.select(F.col("v").alias("x"), F.col("u").alias("y"))
    )
    least = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
    return both.join(least, "x").where("y > x AND y <> m").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(moved).distinct()


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node that has a link; root is the smallest node it reaches.

    Every round is written to the shared work folder, so lineage stays short and a lost executor
    re-reads files. A node's links are never gathered: rounds only take minima (combined before
    the shuffle) and joins, whose large keys adaptive execution splits. Null ends and links of a
    node to itself are ignored.
    """
    edges = (
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    edges = materialize(edges, "links")
    before = _signature(edges)
    while before[0]:
        edges = materialize(_small_star(_large_star(edges)), "links")
        now = _signature(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
