"""Rasters as tables: chunks, pixels, mosaics, other grids, runs, windows of a grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonewright.functions import geometry as g
from zonewright.functions.checks import require
from zonewright.functions.rows import unnest
from zonewright.operators.geometry import BOUNDS


def chunks_to_pixels(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Chunk rows -> pixel rows with cell centres.

    A chunk has ``x0, y0`` (its lower left corner), ``res``, ``width`` and row-major
    ``values`` from the bottom row up. Null cells are kept.
    """
    cells = chunks.select(
        *keys, "x0", "y0", "res", "width", F.posexplode_outer("values").alias("_pos", "value")
    ).filter(F.col("_pos").isNotNull())
    column, row = F.col("_pos") % F.col("width"), F.floor(F.col("_pos") / F.col("width"))
    return cells.select(
        *keys,
        (F.round(F.col("x0") / F.col("res")).cast("long") + column).alias("ix"),
        (F.round(F.col("y0") / F.col("res")).cast("long") + row).alias("iy"),
        (F.col("x0") + (column + 0.5) * F.col("res")).alias("x"),
        (F.col("y0") + (row + 0.5) * F.col("res")).alias("y"),
        "value",
    )


def pixels_to_chunks(
    pixels: DataFrame, size: int, res: float, keys: list[str], value: str = "value"
) -> DataFrame:
    """Pixel rows (one per cell; see ``mosaic``) -> chunks of a world grid.

    A group is one chunk, so it holds at most ``size * size`` cells. Cells
    without a pixel are null. A cell that comes twice fails the job.
    """
    cx, cy = F.floor(F.col("ix") / size), F.floor(F.col("iy") / size)
    position = (F.col("iy") - cy * size) * size + (F.col("ix") - cx * size)
    grouped = (
        pixels.select(
            *keys,
            cx.alias("chunk_x"),
            cy.alias("chunk_y"),
            position.cast("int").alias("_pos"),
            F.col(value).alias("_value"),
        )
        .groupBy(*keys, "chunk_x", "chunk_y")
        .agg(F.sort_array(F.collect_list(F.struct("_pos", "_value"))).alias("_cells"))
    )
    # each cell is followed by as many nulls as are missing up to the next one
    kind = pixels.schema[value].dataType.simpleString()
    nulls = f"array_repeat(cast(null as {kind}), %s)"
    following = f"concat(transform(slice(_cells, 2, size(_cells)), c -> c._pos), array({size * size}))"
    filled = (
        f"zip_with(_cells, {following}, (c, n) -> "
        f"concat(array(c._value), {nulls % 'n - c._pos - 1'}))"
    )
    dense = f"concat({nulls % 'get(_cells, 0)._pos'}, flatten({filled}))"
    once = F.expr("size(array_distinct(transform(_cells, c -> c._pos))) = size(_cells)")
    return grouped.select(
        *keys,
        "chunk_x",
        "chunk_y",
        (F.col("chunk_x") * size * float(res)).alias("x0"),
        (F.col("chunk_y") * size * float(res)).alias("y0"),
        F.lit(float(res)).alias("res"),
        F.lit(size).alias("width"),
        F.lit(size).alias("height"),
        require(F.expr(dense), once, "a cell of a chunk has two pixels").alias("values"),
    )


def mosaic(
    pixels: DataFrame, cell: list[str], order: str, value: str = "value"
) -> DataFrame:
    """Overlapping scenes -> one row per cell and time: the first valid value wins.

    An aggregate, so copies of a hot cell are reduced before the shuffle.
    """
    rest = [c for c in pixels.columns if c not in cell]
    first = F.min_by(F.struct(*rest), F.struct(F.col(value).isNull(), F.col(order)))
    return pixels.groupBy(*cell).agg(first.alias("_p")).select(*cell, "_p.*")


def regrid(pixels: DataFrame, source_res: float, target_res: float) -> DataFrame:
    """Nearest source cell for each cell of another grid, finer or coarser.

    Each source cell emits the target cells whose centre lies in it, so nothing
    is joined or shuffled.
    """
    ratio = source_res / target_res

    def span(index: str) -> Column:
        first = F.ceil(F.col(index) * ratio - 0.5)
        last = F.ceil((F.col(index) + 1) * ratio - 0.5) - 1
        return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    others = [c for c in pixels.columns if c not in ("ix", "iy", "x", "y")]
    columns = unnest(pixels, span("ix"), "_tx", [*others, "iy"])
    grid = unnest(columns, span("iy"), "_ty", [*others, "_tx"])
    return grid.select(
        *others,
        F.col("_tx").alias("ix"),
        F.col("_ty").alias("iy"),
        ((F.col("_tx") + 0.5) * target_res).alias("x"),
        ((F.col("_ty") + 0.5) * target_res).alias("y"),
    )


def filter_values(
    pixels: DataFrame, values: list[float | str] | None, value: str = "value"
) -> DataFrame:
    """Listed values stay, others become null; without a list all stay.

    Values are compared as numbers; text entries match text columns only.
    """
    if values is None:
        return pixels
    return pixels.withColumn(value, F.when(F.col(value).isin(*values), F.col(value)))


def crop_to_bounds(
    pixels: DataFrame,
    minx: float,
    miny: float,
    maxx: float,
    maxy: float,
    fill: float = 0.0,
    value: str = "value",
) -> DataFrame:
    """Cells whose centre lies in the box, bounds included; null cells become ``fill``."""
    inside = F.col("x").between(minx, maxx) & F.col("y").between(miny, maxy)
    return pixels.filter(inside).withColumn(value, F.coalesce(value, F.lit(fill)))


def index_bounds(
    chunks: DataFrame, left: float, bottom: float, res: float, n_lon: int, n_lat: int
) -> DataFrame:
    """Chunk bounds in coordinates -> index slices of a regular world grid.

    The grid's longitudes ascend from ``left``, its latitudes descend to
    ``bottom``. Slice ends are exclusive and reach one cell past the chunk.
    Chunk columns: first/last longitude and latitude ``lon_first, lon_last,
    lat_first, lat_last`` (latitude first is the northern one).
    """

    def below(value: str, origin: float, n: int) -> Column:
        return F.least(F.greatest(F.ceil((F.col(value) - origin) / res), F.lit(0)), F.lit(n))

    def up_to(value: str, origin: float, n: int) -> Column:
        steps = F.floor((F.col(value) - origin) / res) + 1
        return F.least(F.greatest(steps, F.lit(0)), F.lit(n))

    return chunks.withColumns(
        {
            "lat_start": F.lit(n_lat) - up_to("lat_first", bottom, n_lat),
            "lat_end": F.lit(n_lat) - below("lat_last", bottom, n_lat) + 1,
            "lon_start": below("lon_first", left, n_lon),
            "lon_end": up_to("lon_last", left, n_lon) + 1,
        }
    )


def width_guard(scenes: DataFrame, res: float, limit: int = 1_000_000) -> DataFrame:
    """One row with the width in cells of the scenes' common extent; too wide fails the job."""
    cells = F.round((F.max("maxx") - F.min("minx")) / res).cast("long")
    return scenes.agg(cells.alias("_w")).select(
        require(
            F.col("_w"),
            F.coalesce(F.col("_w"), F.lit(0)) < limit,
            F.concat(F.lit("the loaded grid spans the world: width "), F.col("_w").cast("string")),
        ).alias("width")
    )


def percent_of_extent(pixels: DataFrame, by: list[str], matching: Column) -> DataFrame:
    """Matching cells as a share of the rectangle that the cells span."""
    cells = (F.max("ix") - F.min("ix") + 1) * (F.max("iy") - F.min("iy") + 1)
    return pixels.groupBy(*by).agg(
        F.count_if(matching).alias("n_match"), cells.alias("n_extent")
    ).withColumn("percent", F.col("n_match") / F.col("n_extent") * 100)


def polygonize_runs(
    pixels: DataFrame,
    value: float,
    res: float,
    by: list[str],
    origin: tuple[float, float] = (0.0, 0.0),
    block: int = 1 << 16,
) -> DataFrame:
    """Cells of one value -> one rectangle per horizontal run.

    Gaps and islands on (``by``, row, column block). A block of ``block`` columns
    bounds the window group. Runs that touch a block border, at most two per block, are
    stitched by a second pass over them alone. Input has one row per cell; ``origin``
    is the lower left corner of cell (0, 0).
    """
    row = Window.partitionBy(*by, "iy", "_block").orderBy("ix")
    runs = (
        pixels.filter(F.col("value") == value)
        .select(*by, "iy", "ix", F.floor(F.col("ix") / block).alias("_block"))
        .withColumn("_island", F.col("ix") - F.row_number().over(row))
        .groupBy(*by, "iy", "_block", "_island")
        .agg(F.min("ix").alias("ix_first"), F.max("ix").alias("ix_last"))
        .drop("_block", "_island")
    )
    border = (F.pmod("ix_first", F.lit(block)) == 0) | (F.pmod(F.col("ix_last") + 1, F.lit(block)) == 0)
    along = Window.partitionBy(*by, "iy").orderBy("ix_first")
    begins = F.coalesce(F.lag("ix_last").over(along) + 1 < F.col("ix_first"), F.lit(True))
    stitched = (
        runs.filter(border)
        .withColumn("_begins", begins.cast("int"))
        .withColumn("_run", F.sum("_begins").over(along))
        .groupBy(*by, "iy", "_run")
        .agg(F.min("ix_first").alias("ix_first"), F.max("ix_last").alias("ix_last"))
        .drop("_run")
    )
    bounds = runs.filter(~border).unionByName(stitched).withColumns(
        {
            "minx": F.col("ix_first") * float(res) + origin[0],
            "miny": F.col("iy") * float(res) + origin[1],
            "maxx": (F.col("ix_last") + 1) * float(res) + origin[0],
            "maxy": (F.col("iy") + 1) * float(res) + origin[1],
        }
    )
    return bounds.withColumn("geometry", F.expr(g.rectangle(*BOUNDS)))
