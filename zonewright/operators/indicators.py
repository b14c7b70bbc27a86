"""Indicators per zone: raster and vector areas, counts, percentages, means."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonewright.functions import geometry as g
from zonewright.functions.checks import require_each, require_none
from zonewright.operators.filters import parse_value_lists
from zonewright.operators.geometry import (
    BOUNDS,
    project_zones,
    with_area_m2,
    zone_pieces,
)
from zonewright.session import stored
from zonewright.operators.joins import (
    BROADCAST_BYTES,
    candidate_pairs,
    cell_of,
    cover_cells,
    join_on_cells,
    prune_partitions,
    spatial_join_points,
    spatial_join_polygons,
    stored_bytes,
    work_list,
)

# The indicator keys a product may ask for.
KNOWN_INDICATORS = [
    "sum-mangrove-area",
    "sum-seagrass-area",
    "sum-reef-area",
    "count-buildings",
    "sum-intertidal-area",
    "sum-saltmarsh-area",
    "percent-mangrove-area",
    "percent-intertidal-area",
    "percent-saltmarsh-area",
    "percent-seagrass-area",
]
# The patterns that tell the kinds apart.
SUM_AREA = r"^sum-.*-area$"
PERCENT_AREA = r"^percent-.*-area$"
COUNT = r"^count-.*$"

# The data formats that hold scenes of rasters, and vector features.
RASTER_FORMATS, VECTOR_FORMATS = ["stac-geoparquet"], ["geoparquet", "parquet"]

PIECE = ["zone_id", "part", "tile"]
RASTER_CELL_M = 200_000.0


def validate_indicators(
    spec: DataFrame, datetime: str | None = None, datetime_match: str | None = None
) -> tuple[DataFrame, str]:
    """The spec, failing on unknown keys, and the time that names the output."""
    if datetime is None and datetime_match is None:
        raise ValueError("either datetime or datetime_match must be given")
    known = spec.sparkSession.createDataFrame([(k,) for k in KNOWN_INDICATORS], "key string")
    unknown = spec.select("key").join(known, "key", "left_anti")
    return require_none(spec, unknown, "unknown indicators"), datetime or datetime_match


def classify_indicators(spec: DataFrame) -> DataFrame:
    """Adds ``kind`` and ``rank``; percentages rank after what they are built on."""
    kind = (
        F.when(F.col("key").rlike(SUM_AREA), "sum-area")
        .when(F.col("key").rlike(COUNT), "count")
        .when(F.col("key").rlike(PERCENT_AREA), "percent-area")
        .otherwise("other")
    )
    rank = F.when(F.col("key").contains("percent-"), 1).otherwise(0)
    return spec.withColumns({"kind": kind, "rank": rank})


def zonal_aggregate(
    pixels: DataFrame,
    pieces_m: DataFrame,
    keys: list[str],
    by: list[str],
    pixel_key: list[str],
    value: str | None = None,
    cell: float = RASTER_CELL_M,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Pixel count (and value total) per piece and ``by``.

    With cell rows small enough to broadcast this is one pass: a pixel is looked
    up by its cell, tested against the few edges kept there (or none, where the
    cell lies wholly inside), and counted map-side. Beyond that size, cells
    wholly inside take part as one pre-aggregated row per cell and ``by``, and
    only the pixels of cells crossed by an outline are shuffled.
    """
    cells = stored(cover_cells(pieces_m, keys, cell))
    read = dict.fromkeys([*pixel_key, *by, "x", "y", *([value] if value else [])])
    placed = pixels.select(*read).withColumns(
        {"cx": cell_of(F.col("x"), cell), "cy": cell_of(F.col("y"), cell)}
    )
    measures = [F.count("*").alias("n")]
    if value is not None:
        measures.append(F.sum(value).alias("total"))
    inside = F.expr(f"edges IS NULL OR {g.covers('edges', 'x', 'y')}")
    if stored_bytes(cells, "edges") <= broadcast_bytes:
        hits = join_on_cells(placed, cells, pixel_key, True).filter(inside)
        return hits.groupBy(*keys, *by).agg(*measures)
    whole = join_on_cells(
        placed.groupBy("cx", "cy", *by).agg(*measures),
        cells.filter(F.col("edges").isNull()).drop("edges"),
        ["cx", "cy", *by],
        False,
    )
    outlines = cells.filter(F.col("edges").isNotNull())
    near = placed.join(outlines.select("cx", "cy").distinct(), ["cx", "cy"], "left_semi")
    crossed = (
        join_on_cells(near, outlines, pixel_key, False)
        .filter(inside)
        .groupBy(*keys, *by)
        .agg(*measures)
    )
    names = [*keys, *by, "n"] + (["total"] if value is not None else [])
    return (
        whole.select(*names)
        .unionByName(crossed.select(*names))
        .groupBy(*keys, *by)
        .agg(*(F.sum(c).alias(c) for c in names[len(keys) + len(by) :]))
    )


def sum_area_raster(
    pixels: DataFrame,
    pieces_m: DataFrame,
    cell_area_m2: float,
    pixel_key: list[str],
    values: list[float] | None = None,
    by: list[str] | None = None,
    cell: float = RASTER_CELL_M,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Area of matching cells per zone: 2 decimals per piece, then summed."""
    by = by or []
    matching = F.col("value").isNotNull()
    if values is not None:
        matching = F.col("value").isin(*values)
    counts = zonal_aggregate(
        pixels.filter(matching), pieces_m, PIECE, by, pixel_key, None, cell, broadcast_bytes
    )
    return _sum_rounded(counts, F.col("n") * cell_area_m2, by)


def _sum_rounded(pieces: DataFrame, measure, by: list[str]) -> DataFrame:
    return (
        pieces.withColumn("_m", F.round(measure, 2))
        .groupBy("zone_id", *by)
        .agg(F.sum("_m").alias("area_m2"))
    )


def fill_zones(work: DataFrame, sums: DataFrame, on: list[str], value: str) -> DataFrame:
    """One row per work row; nothing found counts as zero."""
    zero = F.lit(0).cast(sums.schema[value].dataType)
    return work.join(sums, on, "left").withColumn(value, F.coalesce(value, zero))


def sum_area_vector(
    features: DataFrame,
    pieces: DataFrame,
    feature_key: list[str],
    dedupe: bool = False,
    cell: float = 1.0,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Whole area of the features meeting each piece, 2 decimals per piece, summed.

    A feature meeting several pieces counts once per piece; ``dedupe`` counts it
    once per zone.
    """
    measured = with_area_m2(features).select(*feature_key, "area_m2", "geometry")
    pairs = spatial_join_polygons(
        measured, pieces.select(*PIECE, "geometry"), feature_key, cell=cell,
        broadcast_bytes=broadcast_bytes, once=(feature_key, ["zone_id"]) if dedupe else None,
    )
    if dedupe:
        per_piece = pairs.groupBy("zone_id").agg(F.sum("area_m2").alias("_a"))
    else:
        per_piece = pairs.groupBy(*PIECE).agg(F.sum("area_m2").alias("_a"))
    return _sum_rounded(per_piece, F.col("_a"), [])


def sum_area_vector_clipped(
    rectangles: DataFrame,
    pieces_m: DataFrame,
    rectangle_key: list[str],
    by: list[str] | None = None,
    cell: float = RASTER_CELL_M,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Area of rectangles (metres) inside each zone by true intersection.

    Zones that no rectangle's bounds meet have no row; ``fill_zones`` gives them 0.
    """
    pairs = candidate_pairs(
        rectangles.drop(*BOUNDS), pieces_m.select(*PIECE, "geometry"), rectangle_key, cell=cell,
        broadcast_bytes=broadcast_bytes,
    )
    inside = F.expr(g.box_overlap_area("_z_geometry", *(f"_f.{c}" for c in BOUNDS)))
    return (
        pairs.select("zone_id", *(by or []), inside.alias("_a"))
        .groupBy("zone_id", *(by or []))
        .agg(F.sum("_a").alias("area_m2"))
    )


def count_in_zones(
    points: DataFrame,
    index: DataFrame,
    zones: DataFrame,
    partition_keys: list[str],
    point_key: list[str],
    cell: float = 1.0,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Points per zone, 0 if none; only the partitions named by the index are read.

    The index join keeps the partitions whose box meets some zone; on a
    partitioned table the semi join prunes directories.
    """
    pieces = stored(zone_pieces(zones.select("zone_id", "geometry")))
    wanted = stored(
        prune_partitions(index, pieces, partition_keys, PIECE).select(*partition_keys).distinct()
    )
    if stored_bytes(wanted) <= broadcast_bytes:
        wanted = F.broadcast(wanted)
    read = points.join(wanted, partition_keys, "left_semi")
    hits = spatial_join_points(
        read, pieces, PIECE, point_key, cell=cell, broadcast_bytes=broadcast_bytes
    )
    counts = hits.groupBy("zone_id").agg(F.count("*").alias("n_points"))
    return fill_zones(zones.select("zone_id"), counts, ["zone_id"], "n_points")


def zone_totals(pieces_m: DataFrame) -> DataFrame:
    """Total area per zone over its pieces, already in metres."""
    return (
        pieces_m.withColumn("_a", F.expr(g.area("geometry")))
        .groupBy("zone_id")
        .agg(F.sum("_a").alias("zone_m2"))
    )


def percent_area(sums: DataFrame, totals: DataFrame) -> DataFrame:
    """Share of the zone covered; no sum or an empty zone gives 0."""
    share = F.when(F.col("zone_m2") > 0, F.col("area_m2") / F.col("zone_m2") * 100)
    return totals.join(sums, "zone_id", "left").withColumn(
        "percent", F.coalesce(share, F.lit(0.0))
    )


def zonal_mean(
    pixels: DataFrame,
    pieces_m: DataFrame,
    pixel_key: list[str],
    by: list[str] | None = None,
    cell: float = RASTER_CELL_M,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Mean pixel value per zone; without ``by``, a zone without a pixel has a null mean."""
    by = by or []
    sums = zonal_aggregate(
        pixels.filter(F.col("value").isNotNull()), pieces_m, ["zone_id"], by, pixel_key, "value",
        cell, broadcast_bytes,
    )
    means = sums.select("zone_id", *by, (F.col("total") / F.col("n")).alias("mean_value"))
    return means if by else pieces_m.select("zone_id").distinct().join(means, "zone_id", "left")


def raster_vs_vector(raster: DataFrame, vector: DataFrame, on: list[str]) -> DataFrame:
    """Difference of the two area methods per zone; what one method lacks is 0."""
    left = raster.withColumnRenamed("area_m2", "raster_m2")
    right = vector.withColumnRenamed("area_m2", "vector_m2")
    both = left.join(right, on, "full").fillna(0.0, ["raster_m2", "vector_m2"])
    return both.withColumn("diff_m2", F.col("raster_m2") - F.col("vector_m2"))


def _with_data_kind(kinds: DataFrame, provenance: DataFrame) -> DataFrame:
    """Adds ``_data``: what the data set of each sum holds, by the format in its record."""
    kind = F.when(F.col("dataType").isin(RASTER_FORMATS), "raster").when(
        F.col("dataType").isin(VECTOR_FORMATS), "vector"
    )
    records = provenance.select(F.col("name").alias("_of"), kind.alias("_data"))
    joined = kinds.join(records, F.col("name") == F.col("_of"), "left").drop("_of")
    known = (F.col("kind") != "sum-area") | F.col("_data").isNotNull()
    return require_each(joined, known, F.concat(F.lit("no data format known for "), F.col("name")))


def _feature_areas(
    features: DataFrame,
    pieces: DataFrame,
    feature_key: list[str],
    dedupe: bool,
    cell: float,
    broadcast_bytes: int,
) -> DataFrame:
    """(zone_id, asset, area_m2): whole area of the features that meet the pieces of a zone."""
    measured = with_area_m2(features).select(*feature_key, "asset", "area_m2", "geometry")
    pairs = spatial_join_polygons(
        measured, pieces.select(*PIECE, "geometry"), feature_key, cell=cell, broadcast_bytes=broadcast_bytes,
        once=(["asset", *feature_key], ["zone_id"]) if dedupe else None,
    )
    if dedupe:
        per_piece = pairs.groupBy("zone_id", "asset").agg(F.sum("area_m2").alias("_a"))
    else:
        per_piece = pairs.groupBy(*PIECE, "asset").agg(F.sum("area_m2").alias("_a"))
    return _sum_rounded(per_piece, F.col("_a"), ["asset"])


def compute_indicators(
    zones: DataFrame,
    spec: DataFrame,
    years: list[int],
    pixels: DataFrame | None = None,
    cell_area_m2: float = 0.0,
    pixel_key: list[str] | None = None,
    points: DataFrame | None = None,
    point_key: list[str] | None = None,
    raster_cell: float = RASTER_CELL_M,
    point_cell: float = 1.0,
    broadcast_bytes: int = BROADCAST_BYTES,
    features: DataFrame | None = None,
    feature_key: list[str] | None = None,
    provenance: DataFrame | None = None,
    dedupe: bool = False,
) -> DataFrame:
    """All indicators of a run for all zones and years: (zone_id, year, indicators map).

    ``spec`` rows are (key, name, value); ``pixels`` has ``asset, yr, x, y, value`` and ``features``
    ``asset`` and ``geometry``. ``provenance`` rows (name, dataType) say of each data set of a sum whether
    it is a raster or holds vector features; a name without a row, or a format of neither kind, fails the
    job. Without it all are rasters. A sum over features is the whole area of those that meet a piece
    of the zone, whatever their time, once per piece or with ``dedupe`` once per zone.
    The pixels are counted once per piece, year, asset and value; the spec then
    joins those counts, so more indicators cost no further pass. The spec has
    at most one row per known key (a key given twice fails the job), which bounds its
    broadcast and the maps. Without pixels or points, what they would give is 0.
    """
    twice = spec.groupBy("key").count().filter("count > 1").select("key")
    spec = require_none(spec, twice, "indicators given twice")
    checked, _ = validate_indicators(spec, datetime_match=str(years[0]))
    kinds = parse_value_lists(classify_indicators(checked)).drop("value")
    if provenance is not None:
        kinds = _with_data_kind(kinds, provenance)
    else:
        kinds = kinds.withColumn("_data", F.lit("raster"))
    kinds = F.broadcast(kinds)
    pieces = stored(zone_pieces(zones.select("zone_id", "geometry")))
    pieces_m = project_zones(pieces)
    asked = kinds.agg(F.collect_list(F.struct("key", "kind")).alias("s")).scalar()
    base = work_list(zones, years).withColumn("_s", F.explode(asked)).select(
        "zone_id", "year", "_s.key", "_s.kind"
    )
    measured = None
    if pixels is not None:
        counts = zonal_aggregate(
            pixels.filter(F.col("value").isNotNull() & F.col("yr").isin(*years)),
            pieces_m, PIECE, ["yr", "asset", "value"], pixel_key, None, raster_cell, broadcast_bytes,
        )
        listed = F.col("numbers").isNull() | F.array_contains("numbers", F.col("value"))
        per_piece = (
            counts.join(
                kinds.filter("kind = 'sum-area' AND _data = 'raster'"), F.col("asset") == F.col("name")
            )
            .select(*PIECE, F.col("yr").alias("year"), "key", "n", listed.alias("_listed"))
            .filter("_listed")
            .groupBy(*PIECE, "year", "key")
            .agg(F.sum("n").alias("n"))
        )
        measured = (
            per_piece.withColumn("_m", F.round(F.col("n") * cell_area_m2, 2))
            .groupBy("zone_id", "year", "key")
            .agg(F.sum("_m").alias("measure"))
        )
    if features is not None:
        areas = _feature_areas(features, pieces, feature_key, dedupe, point_cell, broadcast_bytes)
        asked_of = kinds.filter("kind = 'sum-area' AND _data = 'vector'")
        summed = (
            areas.join(asked_of, F.col("asset") == F.col("name"))
            .select("zone_id", "key", "area_m2")
            .join(base.filter(F.col("kind") == "sum-area").drop("kind"), ["zone_id", "key"])
            .select("zone_id", "year", "key", F.col("area_m2").alias("measure"))
        )
        measured = summed if measured is None else measured.unionByName(summed)
    if points is not None:
        hits = spatial_join_points(
            points, pieces, PIECE, point_key, cell=point_cell, broadcast_bytes=broadcast_bytes
        )
        counted = (
            hits.groupBy("zone_id").agg(F.count("*").cast("double").alias("measure"))
            .join(base.filter(F.col("kind") == "count"), "zone_id")
            .select("zone_id", "year", "key", "measure")
        )
        measured = counted if measured is None else measured.unionByName(counted)
    if measured is None:
        measured = base.filter("false").select(
            "zone_id", "year", "key", F.lit(0.0).alias("measure")
        )
    rows = base.filter(F.col("kind").isin("sum-area", "count", "percent-area"))
    # a percentage reads the sum of the same name, if the run asks for that sum
    source = F.when(
        F.col("kind") == "percent-area",
        F.concat(F.lit("sum-"), F.regexp_replace("key", "^percent-", "")),
    ).otherwise(F.col("key"))
    valued = (
        rows.withColumn("_source", source)
        .join(
            measured.withColumnRenamed("key", "_source"), ["zone_id", "year", "_source"], "left"
        )
        .join(zone_totals(pieces_m), "zone_id", "left")
    )
    percent = F.when(F.col("zone_m2") > 0, F.col("measure") / F.col("zone_m2") * 100)
    value = F.coalesce(
        F.when(F.col("kind") == "percent-area", percent).otherwise(F.col("measure")), F.lit(0.0)
    )
    entries = F.sort_array(F.collect_list(F.struct("key", value.alias("value"))))
    return valued.groupBy("zone_id", "year").agg(F.map_from_entries(entries).alias("indicators"))
