"""Geometry columns: parts, bounds, projection, area, centroid, clipping, tiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonewright.functions import geometry as g
from zonewright.functions import projection as proj
from zonewright.functions.checks import require_each
from zonewright.functions.rows import unnest

BOUNDS = ("minx", "miny", "maxx", "maxy")

# Zones above this area are cut into tiles of this side.
MAX_PIECE_KM2 = 500_000
TILE_SIDE_M = 500_000

# A clipped piece below this share of the shape's own area is a bridge left by the clip.
_BRIDGE = 1e-12


def projected(geometry: str) -> str:
    return g.map_vertices(geometry, proj.forward_x("v.x"), proj.forward_y("v.y"))


def explode_parts(df: DataFrame, geometry: str = "geometry", part: str = "part") -> DataFrame:
    """Multipolygon -> one row per polygon, numbered in ``part``. Null geometries stay."""
    others = [c for c in df.columns if c not in (geometry, part)]
    parts = df.select(*others, F.posexplode_outer(geometry).alias(part, "_polygon"))
    return parts.select(
        *others,
        part,
        F.when(F.col("_polygon").isNotNull(), F.array("_polygon")).alias(geometry),
    )


def with_bounds(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Plain min/max columns, so that Parquet statistics and bbox predicates apply."""
    x, y = g.xs(f"`{geometry}`"), g.ys(f"`{geometry}`")
    values = (f"array_min({x})", f"array_min({y})", f"array_max({x})", f"array_max({y})")
    return df.withColumns({name: F.expr(v) for name, v in zip(BOUNDS, values)})


def project_zones(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Lon/lat degrees -> EPSG:6933 metres, vertex by vertex."""
    return df.withColumn(geometry, F.expr(projected(f"`{geometry}`")))


def unproject_zones(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """EPSG:6933 metres -> lon/lat degrees."""
    degrees = g.map_vertices(f"`{geometry}`", proj.inverse_x("v.x"), proj.inverse_y("v.y"))
    return df.withColumn(geometry, F.expr(degrees))


def with_area_m2(df: DataFrame, geometry: str = "geometry", name: str = "area_m2") -> DataFrame:
    """Equal-area square metres of a lon/lat geometry, holes subtracted."""
    return df.withColumn(name, F.expr(g.area(projected(f"`{geometry}`"))))


def with_centroid(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Centroid in the geometry's own units as ``cx``, ``cy``."""
    return (
        df.withColumn("_centre", F.expr(g.centroid(f"`{geometry}`")))
        .withColumns({"cx": F.col("_centre.x"), "cy": F.col("_centre.y")})
        .drop("_centre")
    )


def bounds_to_polygons(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    return df.withColumn(geometry, F.expr(g.rectangle(*BOUNDS)))


def _keep_pieces(df: DataFrame, geometry: str, value: str, sliver: str) -> DataFrame:
    """Set the geometry and drop empty results, building the value once."""
    others = [c for c in df.columns if c != geometry]
    large = f"if(size(piece) > 0, {g.area('piece')} > {sliver}, false)"
    return unnest(df, F.expr(f"filter(array({value}), piece -> {large})"), geometry, others)


def clip_to_boxes(
    df: DataFrame,
    boxes: DataFrame,
    on: str | list[str],
    geometry: str = "geometry",
) -> DataFrame:
    """Intersection of each geometry with the boxes sharing its ``on`` key.

    ``boxes`` has the key and minx..maxy. Rows left without area are dropped.
    """
    keys = [on] if isinstance(on, str) else on
    extra = [c for c in boxes.columns if c not in (*keys, *BOUNDS)]
    packed = boxes.select(*keys, *extra, F.struct(*BOUNDS).alias("_b"))
    joined = df.drop(*BOUNDS, *extra).join(packed, keys)
    cut = g.clip(f"`{geometry}`", *(f"_b.{c}" for c in BOUNDS))
    sliver = f"{g.area(f'`{geometry}`')} * {_BRIDGE}D"
    kept = _keep_pieces(joined, geometry, cut, sliver)
    return kept.select("*", *(F.col(f"_b.{c}").alias(c) for c in BOUNDS)).drop("_b")


def tile_zones(
    df: DataFrame,
    geometry: str = "geometry",
    max_km2: float = MAX_PIECE_KM2,
    side_m: float = TILE_SIDE_M,
) -> DataFrame:
    """Cut each row larger than ``max_km2`` into tiles of ``side_m`` metres.

    Tiles are laid from the lower left corner of the projected bounds, the last
    ones trimmed; a tile without a share of the geometry is dropped. The
    projection is cylindrical, so a tile is a box in lon/lat too and the clip
    happens there. Adds ``tile``, numbered column by column.
    """
    shape = f"`{geometry}`"
    others = [c for c in df.columns if c not in (geometry, "tile")]
    large = f"{g.area(projected(shape))} / 1e6D > {float(max_km2)!r}D"
    measured = df.select(
        *others, geometry, F.expr(g.bounds(shape)).alias("_m"), F.expr(large).alias("_large")
    )
    metres = g.record(
        x0=proj.forward_x("_m.minx"),
        y0=proj.forward_y("_m.miny"),
        x1=proj.forward_x("_m.maxx"),
        y1=proj.forward_y("_m.maxy"),
    )
    steps = g.bind(
        metres,
        "k",
        g.record(
            x0="k.x0",
            y0="k.y0",
            nx=f"if(_large, int(floor((k.x1 - k.x0) / {float(side_m)!r}D)), 0)",
            ny=f"if(_large, int(floor((k.y1 - k.y0) / {float(side_m)!r}D)), 0)",
        ),
    )
    planned = measured.withColumn("_t", F.expr(steps))
    columns = unnest(planned, F.expr("sequence(0, _t.nx)"), "_i", planned.columns)
    tiled = unnest(columns, F.expr("sequence(0, _t.ny)"), "_j", columns.columns)

    def line(index: str, origin: str, inverse) -> str:
        return inverse(f"({origin} + ({index}) * {float(side_m)!r}D)")

    # the outermost tiles keep the zone's own bounds, free of projection rounding
    cut = g.clip(
        shape,
        f"if(_i = 0, _m.minx, {line('_i', '_t.x0', proj.inverse_x)})",
        f"if(_j = 0, _m.miny, {line('_j', '_t.y0', proj.inverse_y)})",
        f"if(_i = _t.nx, _m.maxx, {line('_i + 1', '_t.x0', proj.inverse_x)})",
        f"if(_j = _t.ny, _m.maxy, {line('_j + 1', '_t.y0', proj.inverse_y)})",
    )
    kept = _keep_pieces(
        tiled.withColumn("tile", F.expr("if(_large, _i * (_t.ny + 1) + _j, 0)")),
        geometry,
        f"if(_large, {cut}, {shape})",
        f"if(_large, {g.area(shape)} * {_BRIDGE}D, -1D)",
    )
    return kept.select(*others, "tile", geometry)


def zone_pieces(
    zones: DataFrame,
    geometry: str = "geometry",
    max_km2: float = MAX_PIECE_KM2,
    side_m: float = TILE_SIDE_M,
) -> DataFrame:
    """The pieces that indicators are summed over: parts, the large ones tiled.

    Parts are spread over the cluster before the clip: zone files are few and
    their outlines of very unlike length.
    """
    parts = explode_parts(zones.filter(F.col(geometry).isNotNull()), geometry)
    keys = [F.col(c) for c in parts.columns if c != geometry]
    tasks = int(zones.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = parts.repartition(tasks, *keys)
    return tile_zones(spread, geometry, max_km2, side_m)


def split_antimeridian(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Cut rows crossing 180 degrees in two, so that no bounds span the world.

    A part wider than 180 degrees is read as crossing: its western vertices are
    moved by 360 first. Coordinates beyond 180 are accepted too. Adds ``side``:
    0 for what lies up to 180, 1 for what was moved back by 360.
    """
    shape = f"`{geometry}`"
    x = g.xs(shape)
    moved = g.map_vertices(shape, "if(v.x < 0, v.x + 360, v.x)", "v.y")
    unwrapped = f"if(array_max({x}) - array_min({x}) > 180, {moved}, {shape})"

    def half(side: int) -> str:
        low = -180 + 360 * side
        cut = g.clip("whole", f"{low}D", "-90D", f"{low + 360}D", "90D")
        return g.record(side=str(side), shape=g.map_vertices(cut, f"v.x - {360 * side}D", "v.y"))

    large = (
        f"if(size(h.shape) > 0, {g.area('h.shape')} > {g.area('whole')} * {_BRIDGE}D, false)"
    )
    halves = g.bind(
        unwrapped,
        "whole",
        f"if(array_max({g.xs('whole')}) > 180, filter(array({half(0)}, {half(1)}), h -> {large}),"
        f" array({g.record(side='0', shape='whole')}))",
    )
    others = [c for c in df.columns if c not in (geometry, "side")]
    kept = F.expr(f"filter({halves}, h -> size(h.shape) > 0)")
    return unnest(df, kept, "_h", others).select(
        *others, F.col("_h.side").alias("side"), F.col("_h.shape").alias(geometry)
    )


def geometry_checks(
    df: DataFrame, geometry: str = "geometry", kind: str | None = None
) -> DataFrame:
    """Rows with a geometry; a kind column other than (multi)polygon fails the job."""
    shaped = df.filter(F.col(geometry).isNotNull())
    if kind is None:
        return shaped
    # The accepted geometry kinds.
    known = F.col(kind).isin("Polygon", "MultiPolygon")
    message = F.concat(F.lit("only Polygon and MultiPolygon are supported, not "), F.col(kind))
    return require_each(shaped, known, message)


def geometry_counts(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One row: rows with and without a geometry."""
    missing = F.col(geometry).isNull()
    return df.agg(
        F.count_if(~missing).alias("n_kept"), F.count_if(missing).alias("n_skipped")
    )
