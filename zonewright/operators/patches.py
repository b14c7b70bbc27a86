"""Connected patches of cells from their horizontal runs.

Runs are joined with the runs of the next row that overlap them, by row and column block, and the
groups so linked are labelled by star contraction: each round hangs the neighbours of a run on the
smallest of them, so even a winding patch needs a number of rounds that grows with the logarithm of
its runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonewright.functions.rows import unnest
from zonewright.session import written

#: Columns of a block; a run stands once in each block it touches.
BLOCK = 1 << 12


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round over (u, v), u > v: hangs neighbours on the smallest one.

    ``large`` looks at all neighbours of each node and moves the larger ones, else at the smaller ones and
    the node itself.
    """
    pairs = edges.select("u", "v")
    if large:
        pairs = pairs.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    moved = pairs.join(low, "u")
    if large:
        moved = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of the links (u, v); the label is the smallest node reachable."""
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = written(edges.filter("u <> v").distinct(), "links")
    before = None
    while True:
        edges = written(_stars(_stars(edges, True), False), "links")
        # the same set of edges after a round: every node hangs on the smallest of its group
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    hung = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return hung.unionByName(roots)


def patches(runs: DataFrame, by: list[str], res: float, block: int = BLOCK) -> DataFrame:
    """Runs -> one row per patch of cells that touch along a side.

    ``runs`` has ``by``, ``iy``, ``ix_first``, ``ix_last`` (see ``polygonize_runs``). A patch has the cell
    it begins with (lowest row, then column), its cells, area and bounds in cells.
    """
    kept = written(
        runs.select(F.monotonically_increasing_id().alias("_id"), *by, "iy", "ix_first", "ix_last"),
        "runs",
    )
    spread = unnest(
        kept,
        F.sequence(F.floor(F.col("ix_first") / block), F.floor(F.col("ix_last") / block)),
        "_block",
        kept.columns,
    )
    upper = spread.select(
        *by, (F.col("iy") - 1).alias("iy"), "_block", F.col("_id").alias("v"),
        F.col("ix_first").alias("_f"), F.col("ix_last").alias("_l"),
    )
    links = (
        spread.withColumnRenamed("_id", "u")
        .join(upper, [*by, "iy", "_block"])
        .filter("ix_first <= _l AND _f <= ix_last")
        .select("u", "v")
    )
    labels = connected(links).withColumnRenamed("node", "_id")
    size = F.col("ix_last") - F.col("ix_first") + 1
    first = F.min(F.struct("iy", "ix_first"))
    return (
        kept.join(labels, "_id", "left")
        .groupBy(*by, F.coalesce("label", "_id").alias("_patch"))
        .agg(
            first.alias("_at"),
            F.sum(size).alias("n_cells"),
            F.min("ix_first").alias("min_ix"),
            F.max("ix_last").alias("max_ix"),
            F.min("iy").alias("min_iy"),
            F.max("iy").alias("max_iy"),
        )
        .select(
            *by,
            F.col("_at.ix_first").alias("ix"),
            F.col("_at.iy").alias("iy"),
            "n_cells",
            (F.col("n_cells") * float(res) * float(res)).alias("area"),
            "min_ix",
            "max_ix",
            "min_iy",
            "max_iy",
        )
    )
