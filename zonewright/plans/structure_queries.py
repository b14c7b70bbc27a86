"""Queries of patches, merged chunks and laid-out points, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewright.functions import geometry as g
from zonewright.operators import chunk_mosaic, patches, quadtree, raster
from zonewright.plans import inputs
from zonewright.plans.indicator_queries import zone_parts
from zonewright.plans.inputs import PIXEL_M, tables_sql
from zonewright.plans.raster_queries import cells
from zonewright.plans.registry import query
from zonewright.session import scratch_path
from zonewright.sources import geojson, layout


@query(
    "patches",
    tables_sql("mosaic").replace("WITH ", "WITH RECURSIVE ", 1)
    + """, c AS (SELECT yr, ix, iy FROM mosaic WHERE value>=2),
    reach AS (SELECT yr, ix AS sx, iy AS sy, ix, iy FROM c
     UNION SELECT r.yr, r.sx, r.sy, c.ix, c.iy FROM reach r JOIN c ON c.yr=r.yr
      AND ((c.iy=r.iy AND ABS(c.ix-r.ix)=1) OR (c.ix=r.ix AND ABS(c.iy-r.iy)=1))),
    owner AS (SELECT yr, sx, sy, MIN(iy*1000+ix) AS patch FROM reach GROUP BY 1,2,3)
    SELECT yr, CAST(patch%1000 AS BIGINT) AS ix, CAST(patch//1000 AS BIGINT) AS iy, COUNT(*) AS n_cells, COUNT(*)*2.5e9 AS area,
     MIN(sx) AS min_ix, MAX(sx) AS max_ix, MIN(sy) AS min_iy, MAX(sy) AS max_iy FROM owner GROUP BY yr, patch""",
)
def patch_query(spark, sf_dir):
    covered = cells(spark, sf_dir).withColumn("value", (F.col("value") >= 2).cast("double"))
    runs = raster.polygonize_runs(covered, 1.0, PIXEL_M, ["yr"])
    return patches.patches(runs, ["yr"], PIXEL_M)


@query(
    "mosaic_chunks",
    tables_sql("pixels")
    + """, s AS (SELECT ix, iy, yr, pixel_id%3 AS scene, CASE WHEN value<5 THEN value END AS value FROM pixels
     QUALIFY ROW_NUMBER() OVER (PARTITION BY ix, iy, yr, pixel_id%3 ORDER BY pixel_id)=1)
    SELECT ix, iy, yr, ARG_MIN(value, scene) AS value FROM s WHERE value IS NOT NULL GROUP BY 1,2,3""",
)
def mosaic_chunks(spark, sf_dir):
    # three scenes a year, each with gaps: some cells have a pixel without a valid value
    scenes = inputs.pixels(spark, sf_dir).withColumn("scene", F.col("pixel_id") % 3)
    once = raster.mosaic(scenes, ["ix", "iy", "yr", "scene"], "pixel_id")
    gaps = once.withColumn("value", F.when(F.col("value") < 5, F.col("value")))
    chunks = raster.pixels_to_chunks(gaps, 20, PIXEL_M, ["yr", "scene"])
    merged = chunk_mosaic.mosaic_chunks(chunks, ["yr"], ["scene"])
    placed = merged.select(
        "yr",
        (F.col("chunk_x") * 20.0 * PIXEL_M).alias("x0"),
        (F.col("chunk_y") * 20.0 * PIXEL_M).alias("y0"),
        F.lit(float(PIXEL_M)).alias("res"),
        F.lit(20).alias("width"),
        "values",
    )
    return raster.chunks_to_pixels(placed, ["yr"]).filter("value IS NOT NULL").select("ix", "iy", "yr", "value")


@query(
    "count_in_layout",
    tables_sql("point_hits")
    + """SELECT s_suppkey AS zone_id, COUNT(h.point_id) AS n_points FROM supplier
    LEFT JOIN point_hits h ON h.zone_id=s_suppkey GROUP BY 1""",
)
def count_in_layout(spark, sf_dir):
    root = scratch_path(spark, "point-layout")
    layout.write_by_curve(inputs.points(spark, sf_dir), root)
    return layout.count_in_layout(spark, root, inputs.zones(spark, sf_dir), ["point_id"])


@query(
    "read_geojson_split",
    tables_sql("feature_base")
    + "SELECT feature_id, class, 5 AS n_vertices, ROUND(2e0*half*half,6) AS area_deg2 FROM feature_base",
)
def read_geojson_split(spark, sf_dir):
    """One file with all features, read in ranges of 64 KB."""
    root = scratch_path(spark, "geojson")
    coordinates = F.transform(
        F.get("geometry", F.lit(0)),
        lambda ring: F.transform(ring, lambda v: F.array(v["x"], v["y"])),
    )
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct("feature_id", "class", F.lit('a "}]" \\').alias("odd")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"),
    )
    rows = inputs.features(spark, sf_dir).select(F.lit(1).alias("o"), F.concat(F.to_json(feature), F.lit(",")).alias("value"))
    head = '{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"CRS84"}},"features":['
    ends = spark.createDataFrame([(0, head), (2, '{"type":"other"}]}')], "o int, value string")
    rows.unionByName(ends).coalesce(1).sortWithinPartitions("o").select("value").write.text(root)
    read = geojson.read_geojson_split(spark, root, "feature_id bigint, class string", split_bytes=1 << 16)
    return read.select(
        "feature_id",
        "class",
        F.size(F.expr(g.xs("geometry"))).alias("n_vertices"),
        F.round(F.expr(g.area("geometry")), 6).alias("area_deg2"),
    )


_TILES_SQL = """v AS (SELECT zone_id, part, (lon1+180e0)/360e0 AS x1, (1e0-LN(TAN(RADIANS(lat1))+1e0/COS(RADIANS(lat1)))/PI())/2e0 AS y1,
     (lon2+180e0)/360e0 AS x2, (1e0-LN(TAN(RADIANS(lat2))+1e0/COS(RADIANS(lat2)))/PI())/2e0 AS y2 FROM zone_edges),
    b AS (SELECT zone_id, part, MIN(x1) AS minx, MAX(x1) AS maxx, MIN(y1) AS miny, MAX(y1) AS maxy FROM v GROUP BY 1,2),
    c AS (SELECT zone_id, part, z, tile_x, UNNEST(generate_series(CAST(FLOOR(miny*2**z-1e-9) AS BIGINT), CAST(FLOOR(maxy*2**z+1e-9) AS BIGINT))) AS tile_y FROM
     (SELECT *, UNNEST(generate_series(CAST(FLOOR(minx*2**z-1e-9) AS BIGINT), CAST(FLOOR(maxx*2**z+1e-9) AS BIGINT))) AS tile_x FROM
      b CROSS JOIN (SELECT CAST(UNNEST(generate_series(0,7)) AS INT) AS z))),
    d AS (SELECT c.zone_id, c.part, z, tile_x, tile_y,
     COUNT(*) FILTER (LEAST(x1,x2)*2**z<=tile_x+1+1e-9 AND GREATEST(x1,x2)*2**z>=tile_x-1e-9
      AND LEAST(y1,y2)*2**z<=tile_y+1+1e-9 AND GREATEST(y1,y2)*2**z>=tile_y-1e-9)>0 AS met,
     COUNT(*) FILTER ((y1*2**z>tile_y+0.5e0)<>(y2*2**z>tile_y+0.5e0)
      AND (tile_x+0.5e0)<((x2-x1)*((tile_y+0.5e0)/2**z-y1)/(y2-y1)+x1)*2**z)%2=1 AS within
     FROM c JOIN v ON v.zone_id=c.zone_id AND v.part=c.part GROUP BY ALL),
    t AS (SELECT d.*, NOT d.met AS whole FROM d LEFT JOIN d p ON p.zone_id=d.zone_id AND p.part=d.part AND p.z=d.z-1
      AND p.tile_x=d.tile_x//2 AND p.tile_y=d.tile_y//2 WHERE d.met OR (d.within AND p.met))"""


@query(
    "quadtree",
    tables_sql("zone_edges") + f", {_TILES_SQL} SELECT zone_id, part, z, tile_x, tile_y, whole FROM t",
)
def quadtree_query(spark, sf_dir):
    return quadtree.quadtree(zone_parts(spark, sf_dir), ["zone_id", "part"], 7)


@query(
    "thin_tiles",
    tables_sql("zone_edges")
    + f""", {_TILES_SQL}, n AS (SELECT z, tile_x, tile_y, zone_id*2+part AS piece, s_acctbal AS rank FROM t JOIN supplier ON s_suppkey=zone_id)
    SELECT * FROM n QUALIFY ROW_NUMBER() OVER (PARTITION BY z, tile_x, tile_y ORDER BY rank DESC, piece)<=3""",
)
def thin_tiles(spark, sf_dir):
    tiles = quadtree.quadtree(zone_parts(spark, sf_dir), ["zone_id", "part"], 7)
    balance = inputs.zones(spark, sf_dir).select("zone_id", F.col("balance").alias("rank"))
    ranked = tiles.join(balance, "zone_id").withColumn("piece", F.col("zone_id") * 2 + F.col("part"))
    return quadtree.thin_tiles(ranked, "piece", "rank", 3, 7).drop("whole")
