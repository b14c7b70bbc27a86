"""Queries of the sources and sinks: written to a scratch folder, read back whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.functions import geometry as g
from zonewright.functions.wkb import to_wkb
from zonewright.operators import provenance
from zonewright.operators.geometry import project_zones, with_centroid
from zonewright.operators.raster import mosaic
from zonewright.plans import inputs
from zonewright.plans.geometry_queries import zone_parts
from zonewright.plans.indicator_queries import PARTITIONED_SQL, partitioned_points
from zonewright.plans.inputs import tables_sql
from zonewright.plans.registry import query
from zonewright.session import scratch_path
from zonewright.sources import files, scenes, sinks, tables

PARTITION_KEYS = ["country_code", "s2_code"]


def point_files(spark: SparkSession, sf_dir: str) -> str:
    """Points written as one Parquet file per 10-degree cell; the folder."""
    root = scratch_path(spark, "points")
    points = partitioned_points(spark, sf_dir).drop("ts")
    points.repartition(*PARTITION_KEYS).write.partitionBy(*PARTITION_KEYS).parquet(root)
    return root


def listed_partitions(listing: DataFrame) -> DataFrame:
    pattern = r"country_code=([^/]+)/s2_code=([^/]+)/"
    return listing.withColumns(
        {
            "country_code": F.regexp_extract("path", pattern, 1),
            "s2_code": F.regexp_extract("path", pattern, 2),
        }
    )


@query(
    "read_table",
    tables_sql("points") + "SELECT point_id, class, ROUND(lon,6) AS lon, ROUND(lat,6) AS lat FROM points",
)
def read_table(spark, sf_dir):
    url = scratch_path(spark, "points")
    inputs.points(spark, sf_dir).drop("ts").write.parquet(url)
    return tables.read_table(spark, url).select(
        "point_id", "class", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat")
    )


@query(
    "read_binary_geometry",
    tables_sql("zone_edges")
    + """, rings AS (SELECT zone_id, part, ring, ABS(SUM(lon1*lat2-lon2*lat1))/2e0 AS ar, COUNT(*)+1 AS n FROM zone_edges GROUP BY 1,2,3)
    SELECT zone_id, CAST(SUM(n) AS INT) AS n_vertices, ROUND(SUM(CASE WHEN ring=0 THEN ar ELSE -ar END),6) AS area_deg2 FROM rings GROUP BY 1""",
)
def read_binary_geometry(spark, sf_dir):
    """Zones stored with a binary geometry column, read back as polygons."""
    root = scratch_path(spark, "zones")
    zones = inputs.zones(spark, sf_dir).select("zone_id", "geometry")
    zones.withColumn("geometry", to_wkb(F.col("geometry"))).write.parquet(root)
    return tables.read_table(spark, root).select(
        "zone_id",
        F.size(F.expr(g.xs("geometry"))).alias("n_vertices"),
        F.round(F.expr(g.area("geometry")), 6).alias("area_deg2"),
    )


@query(
    "read_projected_geometry",
    tables_sql("zone_vertices")
    + """SELECT zone_id, CAST(COUNT(*) AS INT) AS n_vertices, ROUND(MIN(lon),5) AS west, ROUND(MAX(lat),5) AS north
    FROM zone_vertices GROUP BY 1""",
)
def read_projected_geometry(spark, sf_dir):
    """Zones stored in metres of EPSG:6933, or every third in degrees, all read back in degrees."""
    root = scratch_path(spark, "projected")
    degrees = inputs.zones(spark, sf_dir).select("zone_id", "geometry")
    third = F.col("zone_id") % 3 == 0
    metres = project_zones(degrees.filter(~third))
    both = metres.withColumn("geometry", to_wkb(F.col("geometry"), 6933)).unionByName(
        degrees.filter(third).withColumn("geometry", to_wkb(F.col("geometry")))
    )
    both.write.parquet(root)
    return tables.read_table(spark, root).select(
        "zone_id",
        F.size(F.expr(g.xs("geometry"))).alias("n_vertices"),
        F.round(F.array_min(F.expr(g.xs("geometry"))), 5).alias("west"),
        F.round(F.array_max(F.expr(g.ys("geometry"))), 5).alias("north"),
    )


@query(
    "list_files",
    tables_sql("points") + f", {PARTITIONED_SQL} SELECT DISTINCT country_code, s2_code FROM partitioned",
)
def list_files(spark, sf_dir):
    listing = files.list_files(spark, point_files(spark, sf_dir), r"\.parquet$")
    return listed_partitions(listing).filter(F.col("size") > 0).select(*PARTITION_KEYS)


@query(
    "file_info",
    tables_sql("points")
    + f", {PARTITIONED_SQL} SELECT country_code, s2_code, 40 AS tag_length FROM partition_index",
)
def file_info(spark, sf_dir):
    info = provenance.file_info(spark, point_files(spark, sf_dir))
    return listed_partitions(info).select(*PARTITION_KEYS, F.length("tag").alias("tag_length"))


def scene_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene items as documents: id, collection, bbox, geometry, properties, assets."""
    box = [F.col(c) for c in ("minx", "miny", "maxx", "maxy")]
    x0, y0, x1, y1 = box
    ring = F.array(F.array(x0, y0), F.array(x1, y0), F.array(x1, y1), F.array(x0, y1), F.array(x0, y0))
    return inputs.scenes(spark, sf_dir).select(
        F.col("scene_id").alias("id"),
        "collection",
        F.array(*box).alias("bbox"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
        F.struct(
            F.date_format("start_datetime", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("start_datetime"),
            F.date_format("end_datetime", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("end_datetime"),
        ).alias("properties"),
        "assets",
    )


@query(
    "read_scene_items",
    tables_sql("scenes")
    + """SELECT scene_id AS id, collection, minx, miny, maxx, maxy, yr||'-01-01T00:00:00Z' AS start_datetime,
    's3://scenes/'||bx AS href, (maxx-minx)*(maxy-miny) AS area FROM scenes""",
)
def read_scene_items(spark, sf_dir):
    root = scratch_path(spark, "scenes")
    scene_documents(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value")).write.text(root)
    items = scenes.index_scenes(scenes.read_scene_items(spark, root, "*.txt", lines=True))
    shape = tables.polygons_from_geojson(F.col("geometry.type"), F.col("geometry.coordinates"))
    return items.withColumn("shape", shape).select(
        "id", "collection", "minx", "miny", "maxx", "maxy",
        F.col("properties.start_datetime").alias("start_datetime"),
        F.col("assets")["asset"]["href"].alias("href"),
        F.expr(g.area("shape")).alias("area"),
    )


@query(
    "index_scenes",
    tables_sql("scenes")
    + """SELECT scene_id AS id, 'mangrove' AS asset, 's3://scenes/'||bx AS href, minx, miny, maxx, maxy FROM scenes
    WHERE collection='even'""",
)
def index_scenes(spark, sf_dir):
    items = scene_documents(spark, sf_dir).withColumn("url", F.concat(F.lit("s3://items/"), "id"))
    wanted = items.filter(F.col("collection") == "even").select("url")
    index = scenes.index_scenes(items, wanted, "mangrove")
    root = scratch_path(spark, "index")
    sinks.write_table(index.select("id", "assets", "minx", "miny", "maxx", "maxy"), root)
    return spark.read.parquet(root).select(
        "id", F.explode("assets").alias("asset", "a"), "minx", "miny", "maxx", "maxy"
    ).select("id", "asset", "a.href", "minx", "miny", "maxx", "maxy")


@query(
    "rename_single_asset",
    tables_sql("scenes") + "SELECT scene_id AS id, 'seagrass' AS asset, 's3://scenes/'||bx AS href FROM scenes",
)
def rename_single_asset(spark, sf_dir):
    renamed = scenes.rename_single_asset(scene_documents(spark, sf_dir), "seagrass")
    return renamed.select("id", F.explode_outer("assets").alias("asset", "a")).select("id", "asset", "a.href")


@query(
    "scene_dates",
    tables_sql("scenes")
    + """SELECT scene_id, yr||'-01-01' AS start_date, yr||'-07-02' AS mid_date, yr||'-12-31' AS end_date FROM scenes
    UNION ALL SELECT replace(scene_id,'_v3','_v4'), '2020-01-01', '2020-07-02', '2020-12-31' FROM scenes""",
)
def scene_dates(spark, sf_dir):
    third = inputs.scenes(spark, sf_dir).select("scene_id")
    fourth = third.select(F.replace("scene_id", F.lit("_v3"), F.lit("_v4")).alias("scene_id"))
    dated = scenes.scene_dates(third.unionByName(fourth))
    names = ("start_date", "mid_date", "end_date")
    return dated.select("scene_id", *(F.col(c).cast("string").alias(c) for c in names))


@query(
    "file_diff",
    """WITH f AS (SELECT 'f/'||p_partkey||'.tif' AS path, CAST(p_size AS BIGINT) AS size, p_size<=40 AS there,
     p_brand NOT IN ('Brand#1','Brand#2','Brand#3') AS same FROM part)
    SELECT 'size' AS policy, FALSE AS overwrite, path, CASE WHEN there AND same THEN 'skip' ELSE 'copy' END AS action FROM f
    UNION ALL SELECT 'size', TRUE, path, 'copy' FROM f
    UNION ALL SELECT 'name', FALSE, path, CASE WHEN there THEN 'skip' ELSE 'copy' END FROM f
    UNION ALL SELECT 'name', TRUE, path, CASE WHEN there AND same THEN 'skip' ELSE 'copy' END FROM f""",
)
def file_diff(spark, sf_dir):
    part = inputs.table(spark, sf_dir, "part")
    source = part.select(
        F.concat(F.lit("f/"), "p_partkey", F.lit(".tif")).alias("path"),
        F.col("p_size").cast("long").alias("size"), "p_brand",
    )
    changed = F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")
    target = source.filter(F.col("size") <= 40).select(
        "path", F.when(changed, F.col("size") + 1).otherwise(F.col("size")).alias("size")
    )
    decided = [
        files.file_diff(source, target, overwrite, policy).select(
            F.lit(policy).alias("policy"), F.lit(overwrite).alias("overwrite"), "path", "action"
        )
        for policy in ("size", "name")
        for overwrite in (False, True)
    ]
    return tables.merge_regions(decided)


@query(
    "parse_partition_path",
    """SELECT country_code, s2_code, 'https://proxy/country_iso='||country_code||'/'||s2_code||'.parquet' AS url,
    's3://bucket/country_iso='||country_code||'/'||s2_code||'.parquet' AS s3_url
    FROM (SELECT event_type AS country_code, CAST(event_id AS VARCHAR) AS s2_code FROM events WHERE event_type<>'error')""",
)
def parse_partition_path(spark, sf_dir):
    kind = F.col("event_type")
    country = F.when(kind == "error", "None").otherwise(kind)
    listing = inputs.table(spark, sf_dir, "events").select(
        F.concat(F.lit("country_iso="), country, F.lit("/"), "event_id", F.lit(".parquet")).alias("path")
    )
    other = listing.select(F.concat(F.lit("readme/"), "path").alias("path"))
    return files.parse_partition_path(listing.unionByName(other), "https://proxy/", "s3://bucket/")


_INDEX_SQL = f"""{tables_sql("points")}, {PARTITIONED_SQL} SELECT country_code, s2_code, ROUND(minx,6) AS minx, ROUND(miny,6) AS miny,
    ROUND(maxx,6) AS maxx, ROUND(maxy,6) AS maxy, ROUND((maxx-minx)*(maxy-miny),6) AS area_deg2 FROM partition_index"""


def _index_columns(index: DataFrame) -> DataFrame:
    return index.select(
        "country_code",
        F.col("s2_code").cast("string").alias("s2_code"),
        *(F.round(c, 6).alias(c) for c in ("minx", "miny", "maxx", "maxy")),
        F.round(F.expr(g.area(g.from_wkt("bbox_wkt"))), 6).alias("area_deg2"),
    )


@query("bbox_index", _INDEX_SQL)
def bbox_index(spark, sf_dir):
    stored = spark.read.parquet(point_files(spark, sf_dir))
    return _index_columns(files.bbox_index(stored, PARTITION_KEYS))


@query("bbox_index_from_footers", _INDEX_SQL)
def bbox_index_from_footers(spark, sf_dir):
    listing = files.list_files(spark, point_files(spark, sf_dir), r"\.parquet$")
    # the Parquet listing names local files "file:/..."; footers are opened by path or URI
    named = listed_partitions(files.indexed_files(listing)).withColumn(
        "url", F.regexp_replace("path", r"^file:/+", "file:///")
    )
    return _index_columns(files.bbox_index_from_footers(named, x="lon", y="lat"))


@query(
    "merge_regions",
    """SELECT s_suppkey, s_name, s_acctbal, NULL AS s_nationkey FROM supplier WHERE s_nationkey<12
    UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier WHERE s_nationkey>=12""",
)
def merge_regions(spark, sf_dir):
    supplier = inputs.table(spark, sf_dir, "supplier")
    west = supplier.filter("s_nationkey < 12").select("s_suppkey", "s_name", "s_acctbal")
    east = supplier.filter("s_nationkey >= 12").select("s_suppkey", "s_name", "s_nationkey")
    return tables.merge_regions([west, east])


@query(
    "read_geojson",
    tables_sql("feature_base")
    + "SELECT feature_id, class, 5 AS n_vertices, ROUND(2e0*half*half,6) AS area_deg2 FROM feature_base",
)
def read_geojson(spark, sf_dir):
    root = scratch_path(spark, "geojson")
    coordinates = F.transform(
        F.get("geometry", F.lit(0)),
        lambda ring: F.transform(ring, lambda v: F.array(v["x"], v["y"])),
    )
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct("feature_id", "class").alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"),
    )
    collection = F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))
    inputs.features(spark, sf_dir).select(F.to_json(collection).alias("value")).write.text(root)
    read = tables.read_geojson(spark, root, "feature_id bigint, class string", lines=True)
    return read.select(
        "feature_id",
        "class",
        F.size(F.expr(g.xs("geometry"))).alias("n_vertices"),
        F.round(F.expr(g.area("geometry")), 6).alias("area_deg2"),
    )


@query(
    "zones_from_wkt",
    tables_sql("zone_edges")
    + """, rings AS (SELECT zone_id, part, ring, ABS(SUM(lon1*lat2-lon2*lat1))/2e0 AS ar FROM zone_edges GROUP BY 1,2,3)
    SELECT zone_id, 2 AS n_parts, ROUND(SUM(CASE WHEN ring=0 THEN ar ELSE -ar END),6) AS area_deg2 FROM rings GROUP BY 1""",
)
def zones_from_wkt(spark, sf_dir):
    text = tables.zones_to_wkt(inputs.zones(spark, sf_dir)).select("zone_id", "wkt")
    return tables.zones_from_wkt(text).select(
        "zone_id",
        F.size("geometry").alias("n_parts"),
        F.round(F.expr(g.area("geometry")), 6).alias("area_deg2"),
    )


@query(
    "zones_to_wkt",
    tables_sql("zone_vertices")
    + """SELECT zone_id, part, CAST(CASE WHEN part=0 THEN 2 ELSE 1 END AS BIGINT) AS n_rings, COUNT(*)-1 AS n_commas, 'POLYGON' AS kind
    FROM zone_vertices GROUP BY 1,2""",
)
def zones_to_wkt(spark, sf_dir):
    text = tables.zones_to_wkt(zone_parts(spark, sf_dir))
    return text.select(
        "zone_id", "part",
        (F.length("wkt") - F.length(F.replace("wkt", F.lit("("), F.lit(""))) - 1).cast("long").alias("n_rings"),
        (F.length("wkt") - F.length(F.replace("wkt", F.lit(","), F.lit("")))).cast("long").alias("n_commas"),
        F.substring_index("wkt", " ", 1).alias("kind"),
    )


@query(
    "write_table",
    "SELECT s_suppkey AS zone_id, s_name AS zone_name FROM supplier",
)
def write_table(spark, sf_dir):
    root = scratch_path(spark, "zones")
    zones = inputs.zones(spark, sf_dir).select("zone_id", "zone_name")
    sinks.write_table(zones, root)
    sinks.write_table(zones.withColumn("zone_name", F.lit("other")), root)
    return spark.read.parquet(root)


_BIN_SQL = """CAST(CAST(GREATEST(CEIL((lon+180e0)/18e0)-1,0) AS BIGINT) AS VARCHAR)||'_'||
    CAST(CAST(GREATEST(CEIL((lat+90e0)/18e0)-1,0) AS BIGINT) AS VARCHAR)"""


@query(
    "grid_cell",
    tables_sql("feature_base") + f'SELECT feature_id, {_BIN_SQL} AS "partition" FROM feature_base',
)
def grid_cell(spark, sf_dir):
    return sinks.grid_cell(with_centroid(inputs.features(spark, sf_dir))).select("feature_id", "partition")


@query(
    "write_partitioned",
    tables_sql("feature_base")
    + f"""SELECT {_BIN_SQL} AS "partition", COUNT(*) AS n_features, SUM(feature_id) AS id_sum FROM feature_base GROUP BY 1""",
)
def write_partitioned(spark, sf_dir):
    """Written twice: the second run finds every cell present and adds nothing."""
    root = scratch_path(spark, "cells")
    features = inputs.features(spark, sf_dir)
    sinks.write_partitioned(features, root, overwrite=True)
    sinks.write_partitioned(features.withColumn("class", F.lit("again")), root)
    return spark.read.parquet(root).groupBy("partition").agg(
        F.count("*").alias("n_features"), F.sum("feature_id").alias("id_sum")
    )


@query(
    "write_region",
    tables_sql("pixels")
    + """, one AS (SELECT * FROM pixels QUALIFY ROW_NUMBER() OVER (PARTITION BY ix, iy ORDER BY pixel_id)=1)
    SELECT ix, iy, CASE WHEN ix BETWEEN 30 AND 90 AND iy BETWEEN 15 AND 120 THEN value+10e0 ELSE value END AS value FROM one""",
)
def write_region(spark, sf_dir):
    root = scratch_path(spark, "raster")
    world = mosaic(inputs.pixels(spark, sf_dir), ["ix", "iy"], "pixel_id").select("ix", "iy", "value")
    sinks.write_region(world, root, chunk=40)
    region = world.filter(F.col("ix").between(30, 90) & F.col("iy").between(15, 120))
    sinks.write_region(region.withColumn("value", F.col("value") + 10), root, chunk=40)
    return spark.read.parquet(root).select("ix", "iy", "value")


@query(
    "tile_pyramid",
    tables_sql("feature_base")
    + """, zooms AS (SELECT f.*, z.z, CAST(1<<z.z AS DOUBLE) AS n FROM feature_base f CROSS JOIN (SELECT UNNEST(generate_series(0,6)) AS z) z),
    spans AS (SELECT *, CAST(FLOOR((lon-half+180e0)/360e0*n) AS INT) AS xa, CAST(FLOOR((lon+half+180e0)/360e0*n) AS INT) AS xb,
     CAST(FLOOR((1e0-LN(TAN(RADIANS(lat+half))+1e0/COS(RADIANS(lat+half)))/PI())/2e0*n) AS INT) AS ya,
     CAST(FLOOR((1e0-LN(TAN(RADIANS(lat-half))+1e0/COS(RADIANS(lat-half)))/PI())/2e0*n) AS INT) AS yb FROM zooms),
    wide AS (SELECT *, UNNEST(generate_series(xa,xb)) AS tile_x FROM spans),
    tiles AS (SELECT *, UNNEST(generate_series(ya,yb)) AS tile_y FROM wide)
    SELECT CAST(z AS INT) AS z, CAST(tile_x AS INT) AS tile_x, CAST(tile_y AS INT) AS tile_y, feature_id FROM tiles
    QUALIFY ROW_NUMBER() OVER (PARTITION BY z, tile_x, tile_y ORDER BY half DESC, feature_id)<=25""",
)
def tile_pyramid(spark, sf_dir):
    sized = inputs.features(spark, sf_dir).join(
        inputs.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("feature_id"), "p_size"), "feature_id"
    )
    tiles = sinks.tile_pyramid(sized, "feature_id", zmax=6, keep_per_tile=25, rank="p_size")
    return tiles.select("z", "tile_x", "tile_y", "feature_id")


@query(
    "read_provenance",
    """SELECT p_brand||' '||p_type AS id, 'parquet' AS "dataType", CAST(SUM(p_size) AS BIGINT) AS "dataSize",
    's3://data/'||MIN(p_partkey) AS "dataUrl", 's3://data/'||MIN(p_partkey) AS "sourceUrl",
    's3://data/'||MIN(p_partkey)||'.xml' AS "sourceMetadataUrl", '{"steps":["read","sum"]}' AS "workflowDagSimple"
    FROM part GROUP BY p_brand, p_type""",
)
def read_provenance(spark, sf_dir):
    """One document per brand and type, written side by side and read as a table of runs."""
    sets = inputs.table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(
        F.sum("p_size").alias("size"), F.min("p_partkey").alias("first")
    )
    url = F.concat(F.lit("s3://data/"), "first")
    info = sets.select(
        F.concat_ws(" ", "p_brand", "p_type").alias("id"),
        F.lit("parquet").alias("data_type"),
        url.alias("data_url"),
        url.alias("path"),
        "size",
        F.lit('"tag"').alias("tag"),
        F.concat(url, F.lit(".xml")).alias("source_metadata_url"),
    )
    records = provenance.provenance_rows(
        info, "2024-01-01T00:00:00Z", "https://code/tree/abc/", "image:1",
        workflow_dag_simple='{"steps": ["read", "sum"]}',
    )
    root = scratch_path(spark, "provenance")
    provenance.provenance_documents(records).select("value").write.text(root)
    return provenance.read_provenance(spark, root, "*.txt", lines=True).select(
        "id", "dataType", "dataSize", "dataUrl", "sourceUrl", "sourceMetadataUrl", "workflowDagSimple"
    )
