"""Map tiles by descent of a quadtree along outlines, and their thinning from below.

A tile that an outline crosses is split in four; one wholly inside is kept as it is and stands for
all tiles below it; one outside ends. So the work for a feature follows its outline, not its area.
A tile shows its own rows and the whole ones of the tiles above it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from zonewright.functions import geometry as g
from zonewright.functions.rows import unnest
from zonewright.session import written

#: Northern limit of the square world of Web Mercator.
LIMIT = math.degrees(math.atan(math.sinh(math.pi)))
_TILE = ["z", "tile_x", "tile_y"]


def _unit_square(geometry: str) -> str:
    """Lon/lat to Web Mercator positions in 0..1, rows counted from the north."""
    lat = f"radians(greatest(least(v.y, {LIMIT!r}D), -{LIMIT!r}D))"
    return g.map_vertices(
        geometry, "(v.x + 180D) / 360D", f"(1D - ln(tan({lat}) + 1D / cos({lat})) / {math.pi!r}D) / 2D"
    )


def quadtree(
    features: DataFrame, keys: list[str], zmax: int, geometry: str = "geometry"
) -> DataFrame:
    """(keys, z, tile_x, tile_y, whole): tiles an outline crosses, and the largest wholly inside.

    A crossed tile is listed at every zoom up to ``zmax``; an inside one once, where its parent is
    crossed. Edges are matched by their bounds, as in ``cover_cells``.
    """
    edges = features.select(*keys, F.expr(g.edges(_unit_square(f"`{geometry}`"))).alias("edges"))
    # the world is the one tile of zoom 0
    frontier = edges.filter(F.size("edges") > 0).select(
        *keys, F.lit(0).cast("bigint").alias("tile_x"), F.lit(0).cast("bigint").alias("tile_y"), "edges"
    )
    found = [frontier.select(*keys, F.lit(0).alias("z"), "tile_x", "tile_y", F.lit(False).alias("whole"))]
    for z in range(1, zmax + 1):
        side, slack = f"{2.0 ** -z!r}D", f"{2.0 ** -z * 1e-9!r}D"
        quarter = F.expr("array(0L, 1L)")
        rows = unnest(frontier, quarter, "_j", [*keys, "tile_x", "tile_y", "edges"])
        in_band = f"e.y2 >= cy * {side} - {slack} AND e.y1 <= (cy + 1) * {side} + {slack}"
        bands = rows.withColumn("cy", F.expr("2 * tile_y + _j")).select(
            *keys, "tile_x", "cy", F.expr(f"filter(edges, e -> {in_band})").alias("_band")
        )
        split = unnest(bands, quarter, "_i", [*keys, "tile_x", "cy", "_band"])
        ahead = f"filter(_band, e -> greatest(e.x1, e.x2) >= cx * {side} - {slack})"
        tiles = split.withColumn("cx", F.expr("2 * tile_x + _i")).select(
            *keys, "cx", "cy", F.expr(ahead).alias("edges")
        )
        crossed = F.expr(f"exists(edges, e -> least(e.x1, e.x2) <= (cx + 1) * {side} + {slack})")
        inside = F.expr(g.covers("edges", f"((cx + 0.5D) * {side})", f"((cy + 0.5D) * {side})"))
        # one table a level, so that no level is worked out again for the next
        level = written(
            tiles.withColumns({"_crossed": crossed, "_inside": inside})
            .filter("_crossed OR _inside")
            .select(
                *keys,
                F.col("cx").alias("tile_x"),
                F.col("cy").alias("tile_y"),
                F.when(F.col("_crossed"), F.col("edges")).alias("edges"),
            ),
            f"tiles-{z}",
        )
        found.append(
            level.select(*keys, F.lit(z).alias("z"), "tile_x", "tile_y", F.col("edges").isNull().alias("whole"))
        )
        frontier = level.filter(F.col("edges").isNotNull())
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def thin_tiles(tiles: DataFrame, key: str, rank: str, keep: int, zmax: int, salts: int = 16) -> DataFrame:
    """The ``keep`` highest ``rank`` of each tile, merged from below.

    ``tiles`` has ``z, tile_x, tile_y, whole, key, rank``. What leads a tile leads one of its four children or
    is whole there, so each tile ranks at most four lists and its own whole rows, never all its features.
    """
    rows = written(tiles.select(*_TILE, key, rank, "whole"), "tiles")
    order = [F.col(rank).desc_nulls_last(), F.col(key)]
    by_tile = Window.partitionBy(*_TILE).orderBy(*order)
    by_salt = Window.partitionBy(*_TILE, "__salt").orderBy(*order)

    def best(df: DataFrame) -> DataFrame:
        # a tile with very many whole rows is ranked in salted groups first
        salted = df.withColumn("__salt", F.pmod(F.xxhash64(key), F.lit(salts)))
        first = salted.withColumn("_r", F.row_number().over(by_salt)).filter(F.col("_r") <= keep)
        last = first.withColumn("_r", F.row_number().over(by_tile)).filter(F.col("_r") <= keep)
        return last.drop("_r", "__salt")

    kept = written(best(rows.filter(F.col("z") == zmax)), "kept")
    out = kept
    for z in range(zmax - 1, -1, -1):
        above = kept.select(
            F.lit(z).alias("z"),
            F.floor(F.col("tile_x") / 2).alias("tile_x"),
            F.floor(F.col("tile_y") / 2).alias("tile_y"),
            key,
            rank,
            F.lit(False).alias("whole"),
        )
        merged = above.distinct().unionByName(rows.filter((F.col("z") == z) & F.col("whole")))
        kept = written(best(merged), "kept")
        out = out.unionByName(kept)
    return out.select(*_TILE, key, rank, "whole")
