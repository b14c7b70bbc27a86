"""Writing tables, spatial partitions, product documents, raster regions, map tiles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from zonewright.functions.checks import require_each, require_none
from zonewright.operators.geometry import with_bounds, with_centroid
from zonewright.session import stored


def path_exists(spark: SparkSession, url: str) -> bool:
    """Whether a file or folder exists, through the session's own file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(url)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def write_table(df: DataFrame, url: str, overwrite: bool = False) -> None:
    """Parquet; an existing target without ``overwrite`` is left as it is."""
    df.write.mode("overwrite" if overwrite else "ignore").parquet(url)


def grid_cell(df: DataFrame, x: str = "cx", y: str = "cy", chunks: int = 10) -> DataFrame:
    """Adds ``partition``: cell of a world grid of 2*chunks by chunks cells.

    Bins are closed on the right and the lowest edge belongs to the first bin. A point
    without coordinates, or outside the world, has no cell (null).
    """
    step = 180.0 / chunks

    def bin_of(value: Column, origin: float) -> Column:
        return F.greatest(F.ceil((value - origin) / step) - 1, F.lit(0)).cast("int")

    inside = F.col(x).between(-180.0, 180.0) & F.col(y).between(-90.0, 90.0)
    cell = F.concat_ws("_", bin_of(F.col(x), -180.0), bin_of(F.col(y), -90.0))
    return df.withColumn("partition", F.when(inside, cell))


def write_partitioned(df: DataFrame, url: str, overwrite: bool = False, chunks: int = 10) -> None:
    """One folder per grid cell of the centroids.

    With ``overwrite`` all old cells go first; else only cells that are not there
    yet are written. Rows are rebalanced by cell: small cells share a task, and a
    cell far above the advisory partition size is split over several. A geometry
    without a centroid in the world fails the job.
    """
    celled = require_each(
        grid_cell(with_centroid(df), chunks=chunks).drop("cx", "cy"),
        F.col("partition").isNotNull(),
        "a geometry has no centroid in the world",
    )
    spark = df.sparkSession
    mode = "overwrite"
    if not overwrite and path_exists(spark, url):
        present = spark.read.option("basePath", url).parquet(url).select("partition").distinct()
        celled = celled.join(present, "partition", "left_anti")
        mode = "append"
    celled.hint("rebalance", "partition").write.mode(mode).partitionBy("partition").parquet(url)


#: What tells documents apart; all three are null-safe.
DOCUMENT_KEY = ("productId", "geometryOutputId", "timePoint")


def write_product_json(
    outputs: DataFrame, root: str, indicator: str, overwrite: bool = False
) -> None:
    """One JSON document (line) per zone and time below ``indicator/time=.../``.

    Documents of earlier runs stay. One that is stored already is left as it is, or
    with ``overwrite`` replaced; then only the folders of the given times are written anew.
    One key twice in ``outputs`` fails the job before anything is written.
    """
    spark = outputs.sparkSession
    named = F.to_json(F.struct(*DOCUMENT_KEY)).alias("key")
    twice = outputs.groupBy(*DOCUMENT_KEY).count().filter("count > 1").select(named)
    outputs = require_none(outputs, twice, "documents given twice")
    url = f"{root.rstrip('/')}/{indicator}"
    timed = outputs.withColumn("time", F.col("timePoint"))
    mode = "append"
    if path_exists(spark, url):
        kept = spark.read.schema(timed.schema).json(url)

        def without(left: DataFrame, right: DataFrame) -> DataFrame:
            keys = right.select(*(F.col(c).alias(f"_{c}") for c in DOCUMENT_KEY))
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in DOCUMENT_KEY]
            return left.join(keys, same, "left_anti")

        if overwrite:
            times = timed.select(F.col("time").alias("_time")).distinct()
            touched = kept.join(times, F.col("time").eqNullSafe(F.col("_time")), "left_semi")
            timed = timed.unionByName(without(touched, timed))
            mode = "overwrite"
        else:
            timed = without(timed, kept)
    timed.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("time").json(url)


def write_region(
    pixels: DataFrame, root: str, chunk: int = 1000, cell: tuple[str, ...] = ("ix", "iy")
) -> None:
    """Replace one region of a stored raster; cells outside the region stay.

    The raster is partitioned by chunk columns. Stored cells of the touched
    chunks that the region does not cover are read back and written along.
    """
    spark = pixels.sparkSession
    placed = pixels.withColumns(
        {
            "chunk_x": F.floor(F.col("ix") / chunk).cast("int"),
            "chunk_y": F.floor(F.col("iy") / chunk).cast("int"),
        }
    )
    if path_exists(spark, root):
        touched = placed.select("chunk_x", "chunk_y").distinct()
        stored = spark.read.parquet(root).join(touched, ["chunk_x", "chunk_y"], "left_semi")
        rest = stored.join(placed.select(*cell), list(cell), "left_anti")
        placed = placed.unionByName(rest)
    (
        placed.hint("rebalance", "chunk_x", "chunk_y")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("chunk_x", "chunk_y")
        .parquet(root)
    )


def tile_pyramid(
    features: DataFrame,
    key: str,
    zmax: int = 10,
    keep_per_tile: int | None = None,
    rank: str = "area",
    salts: int = 64,
) -> DataFrame:
    """Map-display table: (z, tile_x, tile_y, key) for every tile a feature's bounds meet.

    Web Mercator tiles. With ``keep_per_tile`` dense tiles keep the highest
    ``rank`` only; tiles are thinned in salted groups first, so that no single tile gathers all
    features. What is among the first of a tile is among the first of a tile of the deepest zoom
    inside it too, so tiles of that zoom are thinned first, and only what they keep goes further up.
    """
    limit = math.degrees(math.atan(math.sinh(math.pi)))

    def column_of(lon: Column, n: Column) -> Column:
        return F.least(F.greatest(F.floor((lon + 180) / 360 * n), F.lit(0)), n - 1).cast("int")

    def row_of(lat: Column, n: Column) -> Column:
        angle = F.radians(F.greatest(F.least(lat, F.lit(limit)), F.lit(-limit)))
        share = (1 - F.log(F.tan(angle) + 1 / F.cos(angle)) / math.pi) / 2
        return F.least(F.greatest(F.floor(share * n), F.lit(0)), n - 1).cast("int")

    lowest = 0 if keep_per_tile is None else zmax
    n = F.pow(F.lit(2.0), F.col("z"))
    tiles = (
        with_bounds(features)
        .withColumn("_row", F.monotonically_increasing_id())
        .select(
            "_row", key, rank, "minx", "miny", "maxx", "maxy",
            F.explode(F.sequence(F.lit(lowest), F.lit(zmax))).alias("z"),
        )
        .withColumn(
            "tile_x", F.explode(F.sequence(column_of(F.col("minx"), n), column_of(F.col("maxx"), n)))
        )
        .withColumn(
            "tile_y", F.explode(F.sequence(row_of(F.col("maxy"), n), row_of(F.col("miny"), n)))
        )
        .select("z", "tile_x", "tile_y", "_row", key, rank)
    )
    if keep_per_tile is None:
        return tiles.drop("_row")
    tile = ["z", "tile_x", "tile_y"]
    order = [F.col(rank).desc_nulls_last(), F.col(key)]
    first = Window.partitionBy(*tile, "_salt").orderBy(*order)
    last = Window.partitionBy(*tile).orderBy(*order)

    def thinned(rows: DataFrame) -> DataFrame:
        return (
            rows.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)))
            .withColumn("_r", F.row_number().over(first))
            .filter(F.col("_r") <= keep_per_tile)
            .withColumn("_r", F.row_number().over(last))
            .filter(F.col("_r") <= keep_per_tile)
            .drop("_r", "_salt")
        )

    deepest = stored(thinned(tiles))
    if zmax == 0:
        return deepest.drop("_row")
    # by numbers, not keys: rows may be alike, and each counts once in a tile
    above = (
        deepest.withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(zmax - 1))))
        .withColumns({c: F.expr(f"shiftright({c}, {zmax} - z)") for c in ("tile_x", "tile_y")})
        .dropDuplicates([*tile, "_row"])
    )
    return deepest.unionByName(thinned(above)).drop("_row")
