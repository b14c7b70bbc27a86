"""Queries of the geometry operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.functions import geometry as g
from zonewright.operators import geometry as ops
from zonewright.operators.joins import spatial_join_points, spatial_join_polygons
from zonewright.operators.raster import mosaic, polygonize_runs
from zonewright.plans import inputs
from zonewright.plans.inputs import tables_sql
from zonewright.plans.registry import query


def zone_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.explode_parts(inputs.zones(spark, sf_dir)).select("zone_id", "part", "geometry")


def spread_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone parts over as many tasks as the shuffle has; zone files are few."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = inputs.zones(spark, sf_dir).repartition(tasks, "zone_id")
    return ops.explode_parts(spread).select("zone_id", "part", "geometry")


def overlap_sql(edges: str, x1: str, y1: str, x2: str, y2: str, box: str) -> str:
    """Signed area between an edge and the left side of a box, as SQL over ``edges`` and ``box``."""
    e, b = edges, box
    low = f"GREATEST(LEAST({e}.{y1},{e}.{y2}),{b}.miny)"
    high = f"LEAST(GREATEST({e}.{y1},{e}.{y2}),{b}.maxy)"
    slope = f"({e}.{x2}-{e}.{x1})/({e}.{y2}-{e}.{y1})"
    p = f"({e}.{x1}+({low}-{e}.{y1})*{slope})"
    q = f"({e}.{x1}+({high}-{e}.{y1})*{slope})"

    def primitive(x: str) -> str:
        w = f"({b}.maxx-{b}.minx)"
        return (
            f"(CASE WHEN {x}<={b}.minx THEN 0e0 WHEN {x}>={b}.maxx THEN {w}*({x}-{b}.minx)-{w}*{w}/2e0 "
            f"ELSE ({x}-{b}.minx)*({x}-{b}.minx)/2e0 END)"
        )

    mean = (
        f"CASE WHEN ABS({p}-{q})<1e-9*GREATEST(ABS({p}),1e0) THEN GREATEST(LEAST({p},{b}.maxx),{b}.minx)-{b}.minx "
        f"ELSE ({primitive(q)}-{primitive(p)})/({q}-{p}) END"
    )
    return (
        f"CASE WHEN {e}.{y1}<>{e}.{y2} AND {high}>{low} "
        f"THEN SIGN({e}.{y2}-{e}.{y1})*({high}-{low})*({mean}) ELSE 0e0 END"
    )


@query(
    "explode_parts",
    tables_sql("zone_vertices")
    + """SELECT zone_id, part, COUNT(DISTINCT ring) AS n_rings, COUNT(*) AS n_vertices
    FROM zone_vertices GROUP BY 1,2""",
)
def explode_parts(spark, sf_dir):
    return zone_parts(spark, sf_dir).select(
        "zone_id",
        "part",
        F.size(F.flatten("geometry")).alias("n_rings"),
        F.size(F.expr(g.xs("geometry"))).alias("n_vertices"),
    )


@query(
    "with_bounds",
    tables_sql("zone_vertices")
    + """SELECT zone_id, ROUND(MIN(lon),6) AS minx, ROUND(MIN(lat),6) AS miny, ROUND(MAX(lon),6) AS maxx,
    ROUND(MAX(lat),6) AS maxy FROM zone_vertices GROUP BY 1""",
)
def with_bounds(spark, sf_dir):
    return ops.with_bounds(inputs.zones(spark, sf_dir)).select(
        "zone_id", *(F.round(c, 6).alias(c) for c in ops.BOUNDS)
    )


def _vertex_rows(zones: DataFrame, decimals: int, x: str, y: str) -> DataFrame:
    return (
        zones.select("zone_id", F.posexplode_outer("geometry").alias("part", "rings"))
        .select("zone_id", "part", F.posexplode_outer("rings").alias("ring", "vertices"))
        .select("zone_id", "part", "ring", F.posexplode_outer("vertices").alias("seq", "v"))
        .select(
            "zone_id", "part", "ring", "seq",
            F.round("v.x", decimals).alias(x), F.round("v.y", decimals).alias(y),
        )
    )


@query(
    "project_zones",
    tables_sql("zone_m")
    + "SELECT zone_id, part, ring, seq, ROUND(x,3) AS x, ROUND(y,3) AS y FROM zone_m",
)
def project_zones(spark, sf_dir):
    return _vertex_rows(ops.project_zones(inputs.zones(spark, sf_dir)), 3, "x", "y")


@query(
    "unproject_zones",
    tables_sql("zone_vertices")
    + "SELECT zone_id, part, ring, seq, ROUND(lon,6) AS lon, ROUND(lat,6) AS lat FROM zone_vertices",
)
def unproject_zones(spark, sf_dir):
    metres = ops.project_zones(inputs.zones(spark, sf_dir))
    return _vertex_rows(ops.unproject_zones(metres), 6, "lon", "lat")


@query(
    "with_area_m2",
    tables_sql("part_area")
    + "SELECT zone_id, part, ROUND(area_m2/1e6,3) AS area_km2 FROM part_area",
)
def with_area_m2(spark, sf_dir):
    return ops.with_area_m2(zone_parts(spark, sf_dir)).select(
        "zone_id", "part", F.round(F.col("area_m2") / 1e6, 3).alias("area_km2")
    )


@query(
    "with_centroid",
    tables_sql("zone_edges")
    + """SELECT zone_id, part, ROUND(SUM(k*mx)/(3e0*SUM(k*a)),6) AS cx, ROUND(SUM(k*my)/(3e0*SUM(k*a)),6) AS cy FROM (
    SELECT zone_id, part, ring, a, mx, my, SIGN(a)*CASE WHEN ring=0 THEN 1e0 ELSE -1e0 END AS k FROM (
    SELECT zone_id, part, ring, SUM(lon1*lat2-lon2*lat1) AS a, SUM((lon1*lat2-lon2*lat1)*(lon1+lon2)) AS mx,
    SUM((lon1*lat2-lon2*lat1)*(lat1+lat2)) AS my FROM zone_edges GROUP BY 1,2,3)) GROUP BY 1,2""",
)
def with_centroid(spark, sf_dir):
    return ops.with_centroid(zone_parts(spark, sf_dir)).select(
        "zone_id", "part", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy")
    )


@query(
    "bounds_to_polygons",
    tables_sql("zone_vertices")
    + """SELECT zone_id, ROUND((MAX(lon)-MIN(lon))*(MAX(lat)-MIN(lat)),6) AS area_deg2, 5 AS n_vertices
    FROM zone_vertices GROUP BY 1""",
)
def bounds_to_polygons(spark, sf_dir):
    boxes = ops.bounds_to_polygons(ops.with_bounds(inputs.zones(spark, sf_dir)))
    return boxes.select(
        "zone_id",
        F.round(F.expr(g.area("geometry")), 6).alias("area_deg2"),
        F.size(F.expr(g.xs("geometry"))).alias("n_vertices"),
    )


@query(
    "clip_to_boxes",
    tables_sql("zone_edges")
    + f""", bounds AS (SELECT zone_id, MIN(lon) AS x0, MIN(lat) AS y0, MAX(lon) AS x1, MAX(lat) AS y1
    FROM zone_vertices GROUP BY 1),
    cuts AS (SELECT *, x0+(x1-x0)*0.37e0 AS xm, y0+(y1-y0)*0.37e0 AS ym FROM bounds),
    boxes AS (SELECT zone_id, 0 AS box, x0 AS minx, y0 AS miny, xm AS maxx, ym AS maxy FROM cuts
     UNION ALL SELECT zone_id, 1, xm, y0, x1, ym FROM cuts UNION ALL SELECT zone_id, 2, x0, ym, xm, y1 FROM cuts
     UNION ALL SELECT zone_id, 3, xm, ym, x1, y1 FROM cuts),
    rings AS (SELECT e.zone_id, e.part, e.ring, b.box,
     ABS(SUM({overlap_sql("e", "lon1", "lat1", "lon2", "lat2", "b")})) AS ar
     FROM zone_edges e JOIN boxes b ON b.zone_id=e.zone_id GROUP BY 1,2,3,4)
    SELECT zone_id, part, box, ROUND(SUM(CASE WHEN ring=0 THEN ar ELSE -ar END),6) AS area_deg2
    FROM rings GROUP BY 1,2,3 HAVING SUM(CASE WHEN ring=0 THEN ar ELSE -ar END)>1e-9""",
)
def clip_to_boxes(spark, sf_dir):
    whole = ops.with_bounds(inputs.zones(spark, sf_dir)).select("zone_id", *ops.BOUNDS)
    cut = whole.withColumns(
        {
            "xm": F.col("minx") + (F.col("maxx") - F.col("minx")) * 0.37,
            "ym": F.col("miny") + (F.col("maxy") - F.col("miny")) * 0.37,
        }
    )
    corners = [
        ("minx", "miny", "xm", "ym"), ("xm", "miny", "maxx", "ym"),
        ("minx", "ym", "xm", "maxy"), ("xm", "ym", "maxx", "maxy"),
    ]
    quarters = F.array(
        *(
            F.struct(F.lit(i).alias("box"), *(F.col(c).alias(n) for c, n in zip(four, ops.BOUNDS)))
            for i, four in enumerate(corners)
        )
    )
    boxes = cut.select("zone_id", F.inline(quarters))
    clipped = ops.clip_to_boxes(zone_parts(spark, sf_dir), boxes, "zone_id")
    return clipped.select(
        "zone_id", "part", "box", F.round(F.expr(g.area("geometry")), 6).alias("area_deg2")
    )


@query(
    "tile_zones",
    tables_sql("zone_edges", "part_area")
    + f""", sized AS (SELECT p.zone_id, p.part, p.area_m2, MIN(v.x) AS x0, MIN(v.y) AS y0, MAX(v.x) AS x1, MAX(v.y) AS y1
     FROM part_area p JOIN zone_m v ON v.zone_id=p.zone_id AND v.part=p.part GROUP BY 1,2,3),
    large AS (SELECT *, CAST(FLOOR((x1-x0)/5e5) AS INT) AS nx, CAST(FLOOR((y1-y0)/5e5) AS INT) AS ny
     FROM sized WHERE area_m2/1e6>500000),
    columns_of AS (SELECT *, UNNEST(generate_series(0,nx)) AS i FROM large),
    tiles AS (SELECT *, UNNEST(generate_series(0,ny)) AS j FROM columns_of),
    boxes AS (SELECT zone_id, part, i, j, x0+i*5e5 AS minx, y0+j*5e5 AS miny, LEAST(x0+(i+1)*5e5,x1) AS maxx,
     LEAST(y0+(j+1)*5e5,y1) AS maxy FROM tiles),
    rings AS (SELECT e.zone_id, e.part, e.ring, b.i, b.j,
     ABS(SUM({overlap_sql("e", "x1", "y1", "x2", "y2", "b")})) AS ar
     FROM zone_edges e JOIN boxes b ON b.zone_id=e.zone_id AND b.part=e.part GROUP BY 1,2,3,4,5),
    pieces AS (SELECT zone_id, part, i, j FROM rings GROUP BY 1,2,3,4 HAVING SUM(CASE WHEN ring=0 THEN ar ELSE -ar END)>1e0),
    counts AS (SELECT zone_id, part, COUNT(*) AS n FROM pieces GROUP BY 1,2)
    SELECT p.zone_id, p.part, COALESCE(c.n,1) AS n_tiles, ROUND(p.area_m2/1e6,3) AS area_km2
    FROM part_area p LEFT JOIN counts c ON c.zone_id=p.zone_id AND c.part=p.part""",
)
def tile_zones(spark, sf_dir):
    pieces = ops.with_area_m2(ops.tile_zones(zone_parts(spark, sf_dir)))
    return pieces.groupBy("zone_id", "part").agg(
        F.count("*").alias("n_tiles"), F.round(F.sum("area_m2") / 1e6, 3).alias("area_km2")
    )


@query(
    "contains",
    tables_sql("point_hits")
    + """SELECT h.zone_id, h.part, p.class, COUNT(*) AS n_points FROM point_hits h
    JOIN points p ON p.point_id=h.point_id GROUP BY 1,2,3""",
)
def contains(spark, sf_dir):
    hits = spatial_join_points(
        inputs.points(spark, sf_dir), zone_parts(spark, sf_dir), ["zone_id", "part"], ["point_id"]
    )
    return hits.groupBy("zone_id", "part", "class").agg(F.count("*").alias("n_points"))


@query(
    "intersects",
    tables_sql("feature_hits")
    + "SELECT zone_id, part, COUNT(*) AS n_features FROM feature_hits GROUP BY 1,2",
)
def intersects(spark, sf_dir):
    pairs = spatial_join_polygons(
        inputs.features(spark, sf_dir), spread_parts(spark, sf_dir), ["feature_id"]
    )
    return pairs.groupBy("zone_id", "part").agg(F.count("*").alias("n_features"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = mosaic(inputs.pixels(spark, sf_dir), ["ix", "iy", "yr"], "pixel_id")
    corner = -100.0 * inputs.PIXEL_M
    return polygonize_runs(cells, 1.0, inputs.PIXEL_M, ["yr"], (corner, corner))


RUNS_SQL = """runs AS (SELECT yr, iy, MIN(ix) AS ix_first, MAX(ix) AS ix_last FROM (
    SELECT yr, iy, ix, ix-ROW_NUMBER() OVER (PARTITION BY yr, iy ORDER BY ix) AS island FROM mosaic WHERE value=1)
    GROUP BY yr, iy, island)"""


@query(
    "polygonize_runs",
    tables_sql("mosaic")
    + f""", {RUNS_SQL} SELECT yr, iy, ix_first, ix_last, (ix_last-ix_first+1)*2.5e9 AS area_m2 FROM runs""",
)
def polygonize_runs_query(spark, sf_dir):
    return runs(spark, sf_dir).select(
        "yr", "iy", "ix_first", "ix_last", F.expr(g.area("geometry")).alias("area_m2")
    )


@query(
    "geometry_checks",
    """SELECT COUNT(*) FILTER (WHERE s_acctbal>=0) AS n_kept, COUNT(*) FILTER (WHERE s_acctbal<0) AS n_skipped,
    COUNT(*) FILTER (WHERE s_acctbal>=0) AS n_checked FROM supplier""",
)
def geometry_checks(spark, sf_dir):
    holey = inputs.zones(spark, sf_dir).withColumns(
        {
            "geometry": F.when(F.col("balance") >= 0, F.col("geometry")),
            "kind": F.lit("MultiPolygon"),
        }
    )
    checked = ops.geometry_checks(holey, kind="kind").agg(F.count("kind").alias("n")).scalar()
    return ops.geometry_counts(holey).withColumn("n_checked", checked)


@query(
    "split_antimeridian",
    tables_sql("zone_edges")
    + """, rings AS (SELECT zone_id, part, ring, ABS(SUM(lon1*lat2-lon2*lat1))/2e0 AS ar,
     MIN(lon1)+150e0 AS x0, MAX(lon1)+150e0 AS x1 FROM zone_edges GROUP BY 1,2,3)
    SELECT zone_id, part, CASE WHEN MIN(x0)<180e0 AND MAX(x1)>180e0 THEN 2 ELSE 1 END AS n_sides,
    ROUND(SUM(CASE WHEN ring=0 THEN ar ELSE -ar END),6) AS area_deg2 FROM rings GROUP BY 1,2""",
)
def split_antimeridian(spark, sf_dir):
    wrapped = g.map_vertices("geometry", "v.x + 150 - if(v.x + 150 > 180, 360, 0)", "v.y")
    moved = zone_parts(spark, sf_dir).withColumn("geometry", F.expr(wrapped))
    sides = ops.split_antimeridian(moved).withColumn("_a", F.expr(g.area("geometry")))
    return sides.groupBy("zone_id", "part").agg(
        F.count("*").alias("n_sides"), F.round(F.sum("_a"), 6).alias("area_deg2")
    )
