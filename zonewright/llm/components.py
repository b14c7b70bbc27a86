"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = _both(edges)
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (
        both.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(low, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``node`` and ``label`` (smallest node of its component) of all linked nodes.

    Links and labels stay distributed; each round is written to the shared folder. The stars
    of a round move only minima, summed up on the map side, so a node with very many links
    needs no gathering. Rounds grow with the logarithm of the longest path.
    """
    edges = materialize(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "links"
    )
    state = None
    for _ in range(max_rounds):
        edges = materialize(_small_star(_large_star(edges).distinct()).distinct(), "stars")
        row = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    else:
        raise RuntimeError("components did not settle")
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
