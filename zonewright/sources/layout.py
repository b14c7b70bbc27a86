"""Point tables laid out along a space-filling curve, and reads that open only the cells they need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonewright.operators.geometry import zone_pieces
from zonewright.operators.indicators import PIECE, fill_zones
from zonewright.operators.joins import BROADCAST_BYTES, cell_of, cover_cells, spatial_join_points
from zonewright.session import stored, written

#: Cells of zones up to which their list is broadcast.
BROADCAST_CELLS = 1_000_000
#: Bits of each coordinate in the curve's key.
BITS = 16
# The steps that spread 16 bits to every other place.
_SPREAD = [(8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)]


def _spread(value: str) -> str:
    for shift, mask in _SPREAD:
        value = f"(({value} | shiftleft({value}, {shift})) & {mask}L)"
    return value


def _cell_name(x: Column, y: Column) -> Column:
    return F.concat(x.cast("string"), F.lit("_"), y.cast("string"))


def curve_key(x: str, y: str, low: float, high: float) -> str:
    """Z-order key of a position in a square, as SQL text; outside counts as the border."""
    top = (1 << BITS) - 1

    def step(value: str) -> str:
        share = f"({value} - {low!r}D) / {high - low!r}D * {top + 1}"
        return f"bigint(least(greatest(floor({share}), 0), {top}))"

    # bound to a variable, since every spreading step names its input twice
    both = f"named_struct('x', {step(x)}, 'y', {step(y)})"
    key = f"{_spread('k.x')} | shiftleft({_spread('k.y')}, 1)"
    return f"get(transform(array({both}), k -> {key}), 0)"


def write_by_curve(
    points: DataFrame,
    root: str,
    x: str = "lon",
    y: str = "lat",
    cell: float = 10.0,
    low: float = -180.0,
    high: float = 180.0,
    files: int | None = None,
) -> None:
    """Parquet partitioned by grid cell, in each file along a Z-order curve.

    Ranges of the curve, by sampled borders, go to one task each; a hot cell is spread over several
    files, and neighbours stand together, so the bounds of ``x`` and ``y`` in a file's row groups are
    narrow. A point without a position goes to the partition of null cells.
    """
    parts = files or int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = points.withColumn("cell", _cell_name(cell_of(F.col(x), cell), cell_of(F.col(y), cell)))
    position = F.expr(curve_key(f"`{x}`", f"`{y}`", low, high))
    placed = placed.withColumn("_curve", F.when(F.col("cell").isNotNull(), position))
    (
        placed.repartitionByRange(parts, "cell", "_curve")
        .sortWithinPartitions("cell", "_curve")
        .drop("_curve")
        .write.mode("overwrite")
        .partitionBy("cell")
        .parquet(root)
    )


def read_for_zones(
    spark: SparkSession, root: str, zones: DataFrame, cell: float = 10.0, schema: str | None = None
) -> DataFrame:
    """The rows of a laid-out table in cells that some zone touches.

    With a ``schema`` no footer is opened to find it.
    The list of cells is small and written; as the broadcast side of a semi join on the partition
    columns it makes Spark open only their folders.
    """
    table = (spark.read.schema(schema) if schema else spark.read).parquet(root)
    touched = cover_cells(zones.select("geometry"), [], cell)
    names = touched.select(_cell_name(F.col("cx"), F.col("cy")).alias("cell")).distinct()
    listed = written(names, "zone-cells")
    if listed.count() > BROADCAST_CELLS:
        return table.join(listed, "cell", "left_semi")
    # Spark prunes by a broadcast side that is filtered; all names begin with a sign or a digit
    return table.join(F.broadcast(listed.filter(F.col("cell") >= "-")), "cell", "left_semi")


def count_in_layout(
    spark: SparkSession,
    root: str,
    zones: DataFrame,
    point_key: list[str],
    layout_cell: float = 10.0,
    cell: float = 1.0,
    broadcast_bytes: int = BROADCAST_BYTES,
    schema: str | None = None,
) -> DataFrame:
    """Points per zone, 0 if none, as ``count_in_zones``; folders that no zone touches stay closed."""
    pieces = stored(zone_pieces(zones.select("zone_id", "geometry")))
    points = read_for_zones(spark, root, pieces, layout_cell, schema)
    hits = spatial_join_points(points, pieces, PIECE, point_key, cell=cell, broadcast_bytes=broadcast_bytes)
    counts = hits.groupBy("zone_id").agg(F.count("*").alias("n_points"))
    return fill_zones(zones.select("zone_id"), counts, ["zone_id"], "n_points")
