"""Spatial joins as equi joins on grid cells, and the plain joins of a run.

A polygon side is exploded to the cells it touches and the other side gets the
cell it lies in, so the join is a hash or sort-merge join and never a nested
loop. A cell row of a polygon carries only the edges that can decide a point in
that cell, and none when the cell lies wholly inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from zonewright.functions import geometry as g
from zonewright.functions.rows import unnest
from zonewright.operators import kernels, windows
from zonewright.operators.geometry import BOUNDS
from zonewright.session import stored

# The polygon side is broadcast only up to this many bytes, measured beforehand.
BROADCAST_BYTES = 64 << 20
# A cell holding more than 1/HOT_SHARE of the rows is split; so at most HOT_SHARE cells are.
HOT_SHARE = 1000
# Polygons that share a cell, on average, up to which points are joined to each and tested row by row.
SPARSE = 8
_EDGE_BYTES, _ROW_BYTES = 64, 128


def cell_of(coordinate: Column, size: float) -> Column:
    """Number of the cell a coordinate lies in; null where there is none (NaN, infinite, too far out)."""
    finite = (coordinate > float("-inf")) & (coordinate < float("inf"))
    return F.when(finite, F.floor(coordinate / F.lit(float(size))).try_cast("int"))


def stored_bytes(
    rows: DataFrame, edges: str | None = None, attributes: list[str] | None = None
) -> int:
    """Size of stored polygon rows, from their number, edge lists and attributes as text."""
    measures = [F.count("*").alias("n")]
    if attributes:
        text = F.octet_length(F.to_json(F.struct(*attributes)))
        measures.append(F.sum(text).alias("attributes"))
    if edges is not None:
        measures.append(F.sum(F.coalesce(F.size(edges), F.lit(0))).alias("edges"))
    found = rows.agg(*measures).first()
    listed = (found["edges"] or 0 if edges is not None else 0) * _EDGE_BYTES
    return found["n"] * _ROW_BYTES + listed + (found["attributes"] or 0 if attributes else 0)


def cover_cells(
    pieces: DataFrame, keys: list[str], size: float, geometry: str = "geometry"
) -> DataFrame:
    """(keys, cx, cy, edges): the cells each polygon touches.

    ``edges`` is null where the whole cell is inside; else it holds the edges
    whose y range meets the cell and that do not end left of it, enough to decide
    any point of the cell by a ray to the right.
    """
    shape, step, slack = f"`{geometry}`", f"{float(size)!r}D", f"{size * 1e-9!r}D"
    x, y = g.xs(shape), g.ys(shape)

    def index(value: str) -> str:
        return f"int(floor({value} / {step}))"

    bounded = pieces.select(
        *keys,
        F.expr(g.edges(shape)).alias("_edges"),
        F.expr(f"sequence({index(f'array_min({x})')}, {index(f'array_max({x})')})").alias("_columns"),
        F.expr(f"explode_outer(sequence({index(f'array_min({y})')}, {index(f'array_max({y})')}))").alias("cy"),
    )
    in_band = f"e.y2 >= cy * {step} - {slack} AND e.y1 <= (cy + 1) * {step} + {slack}"
    bands = bounded.select(*keys, "cy", "_columns", F.expr(f"filter(_edges, e -> {in_band})").alias("_band"))
    ahead = g.record(
        cx="cx", edges=f"filter(_band, e -> greatest(e.x1, e.x2) >= cx * {step} - {slack})"
    )
    crossed = f"exists(c.edges, e -> least(e.x1, e.x2) <= (c.cx + 1) * {step} + {slack})"
    marked = g.record(cx="c.cx", edges="c.edges", crossed=crossed)
    centre = g.covers("c.edges", f"((c.cx + 0.5D) * {step})", f"((cy + 0.5D) * {step})")
    touched = (
        f"filter(transform(transform(_columns, cx -> {ahead}), c -> {marked}),"
        f" c -> c.crossed OR {centre})"
    )
    return unnest(bands, F.expr(touched), "_c", [*keys, "cy"]).select(
        *keys,
        F.col("_c.cx").alias("cx"),
        "cy",
        F.when(F.col("_c.crossed"), F.col("_c.edges")).alias("edges"),
    )


def join_on_cells(
    rows: DataFrame,
    cells: DataFrame,
    row_key: list[str],
    small: bool,
    on: tuple[str, ...] = ("cx", "cy"),
) -> DataFrame:
    """Equi join of ``rows`` (the large side) with ``cells`` on the cell.

    With a cell side of checked small size it is broadcast and ``rows`` is not
    shuffled. Otherwise both sides are shuffled, and the rows of hot cells are
    spread over several salts by a hash of their key, against a copy of the
    cell's polygons per salt. The hot list comes from one counting pass over the
    cell columns; it has at most HOT_SHARE rows.
    """
    on = list(on)
    if small:
        return rows.join(F.broadcast(cells), on)
    hot = _hot_cells(rows, on)
    if hot.isEmpty():
        return rows.join(cells.hint("shuffle_merge"), on)
    salted_rows, salted_cells = _salted(rows, cells, row_key, on, hot)
    return salted_rows.join(salted_cells.hint("shuffle_merge"), [*on, "__salt"]).drop("__salt")


def _hot_cells(rows: DataFrame, on: list[str]) -> DataFrame:
    """Cells with more than their share of the rows, and the salts these are spread over."""
    per_cell = rows.groupBy(*on).agg(F.count("*").alias("_n"))
    everything = per_cell.agg(F.sum("_n").alias("n"))
    share = F.col("_n") * HOT_SHARE / F.coalesce(everything.scalar(), F.lit(1))
    return stored(
        per_cell.withColumn("_share", share)
        .filter(F.col("_share") > 1)
        .select(*on, F.ceil("_share").cast("int").alias("__salts"))
    )


def _salted(
    rows: DataFrame, cells: DataFrame, row_key: list[str], on: list[str], hot: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``__salt``: one for a row, each of its cell's for a cell row."""
    salted_rows = rows.join(F.broadcast(hot), on, "left").withColumn(
        "__salt",
        F.coalesce(F.pmod(F.xxhash64(*row_key), F.col("__salts")).cast("int"), F.lit(0)),
    )
    salts = F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)
    salted_cells = cells.join(F.broadcast(hot), on, "left").withColumn("__salt", F.explode(salts))
    return salted_rows.drop("__salts"), salted_cells.drop("__salts")


def _sparse(cells: DataFrame, on: list[str]) -> bool:
    """Whether a row shares its cell with few others on average, so that a join multiplies little."""
    per_cell = cells.groupBy(*on).agg(F.count("*").cast("double").alias("n"))
    shared = F.sum(F.col("n") * F.col("n")) / F.sum("n")
    return (per_cell.agg(shared.alias("n")).first()["n"] or 0) <= SPARSE


def _side_by_side(rows: DataFrame, shapes: DataFrame) -> StructType:
    """The columns of both sides; any may be null, as far as the schema goes."""
    return StructType([StructField(f.name, f.dataType) for f in (*rows.schema, *shapes.schema)])


def spatial_join_points(
    points: DataFrame,
    zones: DataFrame,
    zone_keys: list[str],
    point_key: list[str],
    x: str = "lon",
    y: str = "lat",
    geometry: str = "geometry",
    cell: float = 1.0,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All (point, zone) pairs where the zone covers the point, boundary included.

    The cell rows of the zones are stored first; their measured size decides
    between a broadcast and a salted shuffle. Points without a finite position match nothing.
    All columns of both sides come through (names that begin with two underscores are the join's).
    """
    # names of the join's own, so that every column of the caller comes through
    own = {"cx": "__cx", "cy": "__cy", "edges": "__edges"}
    cells = stored(cover_cells(zones, zone_keys, cell, geometry).withColumnsRenamed(own))
    small = stored_bytes(cells, "__edges") <= broadcast_bytes
    placed = points.withColumns(
        {"__cx": cell_of(F.col(x), cell), "__cy": cell_of(F.col(y), cell)}
    ).filter(F.col("__cx").isNotNull() & F.col("__cy").isNotNull())
    on = ["__cx", "__cy"]
    if not zone_keys or set(points.columns) & set(zone_keys) or (small and _sparse(cells, on)):
        inside = F.expr(f"__edges IS NULL OR {g.covers('__edges', f'`{x}`', f'`{y}`')}")
        joined = join_on_cells(placed, cells, point_key, small, ("__cx", "__cy"))
        return joined.filter(inside).drop(*own.values())
    rows, shapes = _salted(placed, cells, point_key, on, _hot_cells(placed, on))
    return kernels.tested(
        rows.select(
            *on, "__salt",
            F.struct(*(F.col(f"`{c}`") for c in points.columns)).alias("__p"),
            F.col(f"`{x}`").cast("double").alias("__x"), F.col(f"`{y}`").cast("double").alias("__y"),
        ),
        shapes.select(
            *on, "__salt", F.struct(*zone_keys).alias("__z"),
            F.expr(kernels.flat_edges("__edges")).alias("__edges"),
        ),
        [*on, "__salt"], kernels.PointTest, _side_by_side(points, cells.select(*zone_keys)),
    )


def _bbox_cells(df: DataFrame, size: float, geometry: str, tag: str) -> DataFrame:
    """One row per cell of each geometry's bounds, which go to a struct named ``tag``."""
    return _cells_of_bounds(df.withColumn(tag, F.expr(g.bounds(f"`{geometry}`"))), size, tag)


def _cells_of_bounds(boxed: DataFrame, size: float, tag: str) -> DataFrame:
    def span(low: str, high: str) -> Column:
        return F.sequence(cell_of(F.col(f"{tag}.{low}"), size), cell_of(F.col(f"{tag}.{high}"), size))

    columns = unnest(boxed, span("minx", "maxx"), "cx", boxed.columns)
    return unnest(columns, span("miny", "maxy"), "cy", columns.columns)


def _home(cell: float) -> Column:
    """Bounds ``_f`` and ``_z`` meet, and this cell holds the lower left corner of the common box."""
    meets = (
        (F.col("_f.minx") <= F.col("_z.maxx"))
        & (F.col("_z.minx") <= F.col("_f.maxx"))
        & (F.col("_f.miny") <= F.col("_z.maxy"))
        & (F.col("_z.miny") <= F.col("_f.maxy"))
    )
    home = (cell_of(F.greatest(F.col("_f.minx"), F.col("_z.minx")), cell) == F.col("cx")) & (
        cell_of(F.greatest(F.col("_f.miny"), F.col("_z.miny")), cell) == F.col("cy")
    )
    return meets & home


def candidate_pairs(
    features: DataFrame,
    zones: DataFrame,
    feature_key: list[str],
    geometry: str = "geometry",
    cell: float = 1.0,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Each (feature, zone) pair with meeting bounds, exactly once.

    Both sides are exploded to the cells of their bounds, the zones with nothing
    but a row number, given once in the stored table. A pair is kept only in the
    cell holding the lower left corner of the common box, so no distinct is needed.
    The zone's geometry and attributes are then attached by that number, so they may
    be null or alike and are never copied per cell. Keeps ``_f`` (bounds),
    ``_f_geometry``, ``_z_geometry`` and ``_z_edges``.
    """
    keys = [c for c in zones.columns if c != geometry]
    shapes = stored(
        zones.select(
            F.monotonically_increasing_id().alias("_zone"),
            *keys,
            F.col(geometry).alias("_z_geometry"),
            F.expr(g.edges(f"`{geometry}`")).alias("_z_edges"),
        )
    )
    shapes_small = 2 * stored_bytes(shapes, "_z_edges", keys) <= broadcast_bytes
    right = stored(
        _bbox_cells(shapes.select("_zone", "_z_geometry"), cell, "_z_geometry", "_z").drop(
            "_z_geometry"
        )
    )
    left = _bbox_cells(features.withColumnRenamed(geometry, "_f_geometry"), cell, "_f_geometry", "_f")
    pairs = join_on_cells(left, right, feature_key, stored_bytes(right) <= broadcast_bytes)
    found = pairs.filter(_home(cell)).drop("cx", "cy", "_z")
    return join_on_cells(found, shapes, feature_key, shapes_small, ("_zone",)).drop("_zone")


def spatial_join_polygons(
    features: DataFrame,
    zones: DataFrame,
    feature_key: list[str],
    geometry: str = "geometry",
    cell: float = 1.0,
    broadcast_bytes: int = BROADCAST_BYTES,
    once: tuple[list[str], list[str]] | None = None,
) -> DataFrame:
    """All (feature, zone) pairs that share a point, each once, without geometries.

    Features move once, to a square of a grid, and zones once for each window they meet
    (``operators/windows.py``); pairs come out where they are found and are not shuffled.
    ``once`` names columns of the features and of the zones: of the pairs alike in these, one comes out.
    Sides that share a column name are joined cell by cell, where ``broadcast_bytes`` counts.
    """
    attributes = [c for c in features.columns if c != geometry]
    keys = [c for c in zones.columns if c != geometry]
    if not attributes or not keys or set(attributes) & set(keys):
        pairs = candidate_pairs(features, zones, feature_key, geometry, cell, broadcast_bytes)
        edged = pairs.withColumn("_f_edges", F.expr(g.edges("_f_geometry")))
        hit = g.intersects("_f_geometry", "_f_edges", "_z_geometry", "_z_edges")
        found = edged.filter(F.expr(hit)).drop("_f", "_f_geometry", "_z_geometry", "_f_edges", "_z_edges")
        return found.dropDuplicates([*once[0], *once[1]]) if once is not None else found
    return windows.meeting(
        features, zones, feature_key, geometry, cell,
        _side_by_side(features.select(*attributes), zones.select(*keys)), once,
    )


def prune_partitions(
    index: DataFrame,
    zones: DataFrame,
    index_keys: list[str],
    zone_keys: list[str],
    cell: float = 10.0,
) -> DataFrame:
    """(zone, partition) pairs where the partition's box meets the zone's geometry."""
    boxes = index.select(*index_keys, F.expr(g.rectangle(*BOUNDS)).alias("geometry"))
    pairs = spatial_join_polygons(
        boxes, zones.select(*zone_keys, "geometry"), index_keys, cell=cell
    )
    return pairs.select(*zone_keys, *index_keys)


def pixels_in_zones(
    pixels: DataFrame,
    pieces_m: DataFrame,
    zone_keys: list[str],
    pixel_key: list[str],
    cell: float = 200_000.0,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Raster x zones: pixels whose centre lies in a piece, all in EPSG:6933 metres."""
    return spatial_join_points(
        pixels, pieces_m, zone_keys, pixel_key, "x", "y", "geometry", cell, broadcast_bytes
    )


def work_list(
    zones: DataFrame,
    years: list[str],
    exclude: DataFrame | None = None,
    zone_id: str = "zone_id",
) -> DataFrame:
    """years x zone ids, less the excluded ids. The years are a short parameter."""
    ids = zones.select(zone_id)
    if exclude is not None:
        ids = ids.join(exclude.select(zone_id).distinct(), zone_id, "left_anti")
    return ids.select(F.explode(F.array(*(F.lit(y) for y in years))).alias("year"), zone_id)


def pending(
    work: DataFrame, done: DataFrame, on: list[str], overwrite: bool = False
) -> DataFrame:
    """Work without an existing output; everything when ``overwrite``."""
    if overwrite:
        return work
    return work.join(done.select(*on), on, "left_anti")


def attach_values(
    zones: DataFrame,
    values: DataFrame,
    zone_id: str = "zone_id",
    value: str = "value",
    unit: str = "km²",
    k: int | None = None,
) -> DataFrame:
    """Zones with their latest values and a text label; zones without one stay.

    ``values`` has ``year``; the report is the latest year, highest first.
    """
    latest = values.filter(F.col("year") == values.agg(F.max("year")).scalar())
    labelled = latest.withColumn(
        "value_label", F.concat(F.format_number(F.col(value), 2), F.lit(f" {unit}"))
    )
    joined = zones.join(labelled, zone_id, "left").orderBy(
        F.col(value).desc_nulls_last(), F.col(zone_id)
    )
    return joined.limit(k) if k else joined


def lineage(
    products: DataFrame,
    datasets: DataFrame,
    zone_sets: DataFrame,
    runs: DataFrame,
    dataset_name: str | None = None,
    zone_set_name: str | None = None,
) -> DataFrame:
    """Each product with its data set, zone set and the main run of all three.

    Inputs: products(id, name, dataset_id, zone_set_id, main_run_id), datasets and
    zone_sets(id, name, main_run_id), runs(id, data_url, data_size).
    """

    def with_run(df: DataFrame, tag: str) -> DataFrame:
        run = runs.select(
            F.col("id").alias("main_run_id"),
            F.col("data_url").alias(f"{tag}_data_url"),
            F.col("data_size").alias(f"{tag}_data_size"),
        )
        return df.join(run, "main_run_id").drop("main_run_id")

    def named(df: DataFrame, tag: str, name: str | None) -> DataFrame:
        chosen = df if name is None else df.filter(F.col("name") == name)
        return with_run(chosen, tag).withColumnsRenamed(
            {"id": f"{tag}_id", "name": f"{tag}_name"}
        )

    return (
        named(products, "product", None)
        .join(named(datasets, "dataset", dataset_name), "dataset_id")
        .join(named(zone_sets, "zone_set", zone_set_name), "zone_set_id")
    )
