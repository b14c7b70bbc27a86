"""Queries of the raster and filter operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.functions import geometry as g
from zonewright.operators import filters, raster
from zonewright.operators.geometry import project_zones, with_bounds, zone_pieces
from zonewright.plans import inputs
from zonewright.plans.geometry_queries import overlap_sql, zone_parts
from zonewright.plans.inputs import tables_sql
from zonewright.plans.registry import query


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.mosaic(inputs.pixels(spark, sf_dir), ["ix", "iy", "yr"], "pixel_id")


def pieces_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_zones(zone_pieces(inputs.zones(spark, sf_dir).select("zone_id", "geometry")))


def parts_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_zones(zone_parts(spark, sf_dir))


def uuid5_sql(text: str) -> str:
    """A version-5 id (URL namespace) of an SQL text expression."""
    digest = f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8')||encode({text}))"
    return (
        f"substr({digest},1,8)||'-'||substr({digest},9,4)||'-5'||substr({digest},14,3)||'-'||"
        f"translate(substr({digest},17,1),'0123456789abcdef','89ab89ab89ab89ab')||substr({digest},18,3)"
        f"||'-'||substr({digest},21,12)"
    )


@query(
    "mosaic",
    tables_sql("pixels")
    + """SELECT CAST(FLOOR(ix/2) AS BIGINT) AS ix, iy, yr, pixel_id, value FROM pixels
    QUALIFY ROW_NUMBER() OVER (PARTITION BY FLOOR(ix/2), iy, yr ORDER BY pixel_id)=1""",
)
def mosaic(spark, sf_dir):
    coarse = inputs.pixels(spark, sf_dir).withColumn("ix", F.floor(F.col("ix") / 2))
    merged = raster.mosaic(coarse, ["ix", "iy", "yr"], "pixel_id")
    return merged.select("ix", "iy", "yr", "pixel_id", "value")


@query(
    "regrid",
    tables_sql("mosaic")
    + """, fine AS (SELECT UNNEST(generate_series(0,333)) AS t), coarse AS (SELECT UNNEST(generate_series(0,142)) AS t)
    SELECT 30 AS km, x.t AS ix, y.t AS iy, m.yr, m.value FROM mosaic m JOIN fine x ON FLOOR((x.t+0.5e0)*30e0/50e0)=m.ix
     JOIN fine y ON FLOOR((y.t+0.5e0)*30e0/50e0)=m.iy
    UNION ALL
    SELECT 70 AS km, x.t AS ix, y.t AS iy, m.yr, m.value FROM mosaic m JOIN coarse x ON FLOOR((x.t+0.5e0)*70e0/50e0)=m.ix
     JOIN coarse y ON FLOOR((y.t+0.5e0)*70e0/50e0)=m.iy""",
)
def regrid(spark, sf_dir):
    source = cells(spark, sf_dir)

    def to(km: int) -> DataFrame:
        grid = raster.regrid(source, inputs.PIXEL_M, km * 1000.0)
        return grid.select(F.lit(km).alias("km"), "ix", "iy", "yr", "value")

    return to(30).unionByName(to(70))


@query(
    "pixels_to_chunks",
    tables_sql("mosaic")
    + """SELECT yr, CAST(FLOOR(ix/20) AS BIGINT) AS chunk_x, CAST(FLOOR(iy/20) AS BIGINT) AS chunk_y,
    FLOOR(ix/20)*1e6 AS x0, FLOOR(iy/20)*1e6 AS y0, 400 AS n_cells, COUNT(*) AS n_filled, SUM(value) AS total
    FROM mosaic GROUP BY 1,2,3,4,5""",
)
def pixels_to_chunks(spark, sf_dir):
    chunks = raster.pixels_to_chunks(cells(spark, sf_dir), 20, inputs.PIXEL_M, ["yr"])
    filled = F.array_compact("values")
    return chunks.select(
        "yr", "chunk_x", "chunk_y", "x0", "y0",
        F.size("values").alias("n_cells"),
        F.size(filled).alias("n_filled"),
        F.aggregate(filled, F.lit(0.0), lambda t, v: t + v).alias("total"),
    )


@query(
    "chunks_to_pixels",
    tables_sql("mosaic")
    + "SELECT yr, ix, iy, (ix+0.5e0)*5e4 AS x, (iy+0.5e0)*5e4 AS y, value FROM mosaic",
)
def chunks_to_pixels(spark, sf_dir):
    chunks = raster.pixels_to_chunks(cells(spark, sf_dir), 20, inputs.PIXEL_M, ["yr"])
    pixels = raster.chunks_to_pixels(chunks, ["yr"])
    return pixels.filter(F.col("value").isNotNull())


@query(
    "filter_values",
    tables_sql("pixels")
    + """SELECT yr, COUNT(*) AS n_cells, COUNT(*) FILTER (WHERE value IN (1,3)) AS n_kept,
    SUM(CASE WHEN value IN (1,3) THEN value END) AS total FROM pixels GROUP BY 1""",
)
def filter_values(spark, sf_dir):
    kept = raster.filter_values(inputs.pixels(spark, sf_dir), [1.0, 3.0])
    return kept.groupBy("yr").agg(
        F.count("*").alias("n_cells"), F.count("value").alias("n_kept"), F.sum("value").alias("total")
    )


@query(
    "mask_pixels",
    tables_sql("pixel_hits")
    + "SELECT zone_id, pixel_id, yr, value FROM pixel_hits",
)
def mask_pixels(spark, sf_dir):
    masked = filters.mask_pixels(
        cells(spark, sf_dir), pieces_m(spark, sf_dir), ["pixel_id"], ["zone_id"]
    )
    return masked.select("zone_id", "pixel_id", "yr", "value")


@query(
    "crop_to_bounds",
    tables_sql("pixels")
    + """SELECT pixel_id, CASE WHEN value>=2 THEN value ELSE 0e0 END AS value FROM pixels
    WHERE x BETWEEN -2e6 AND 3e6 AND y BETWEEN -1e6 AND 2.5e6""",
)
def crop_to_bounds(spark, sf_dir):
    valid = inputs.pixels(spark, sf_dir).withColumn(
        "value", F.when(F.col("value") >= 2, F.col("value"))
    )
    return raster.crop_to_bounds(valid, -2e6, -1e6, 3e6, 2.5e6).select("pixel_id", "value")


@query(
    "index_bounds",
    tables_sql("feature_base")
    + """SELECT feature_id, 1280-LEAST(GREATEST(FLOOR((lat+half+32e0)/0.05e0)+1,0),1280) AS lat_start,
    1280-LEAST(GREATEST(CEIL((lat-half+32e0)/0.05e0),0),1280)+1 AS lat_end,
    LEAST(GREATEST(CEIL((lon-half+180e0)/0.05e0),0),7200) AS lon_start,
    LEAST(GREATEST(FLOOR((lon+half+180e0)/0.05e0)+1,0),7200)+1 AS lon_end FROM feature_base""",
)
def index_bounds(spark, sf_dir):
    boxes = with_bounds(inputs.features(spark, sf_dir)).withColumnsRenamed(
        {"minx": "lon_first", "maxx": "lon_last", "maxy": "lat_first", "miny": "lat_last"}
    )
    sliced = raster.index_bounds(boxes, -180.0, -32.0, 0.05, 7200, 1280)
    names = ("lat_start", "lat_end", "lon_start", "lon_end")
    return sliced.select("feature_id", *(F.col(n).cast("double").alias(n) for n in names))


@query(
    "width_guard",
    tables_sql("scenes")
    + "SELECT CAST(ROUND((MAX(maxx)-MIN(minx))/5e4) AS BIGINT) AS width FROM scenes",
)
def width_guard(spark, sf_dir):
    return raster.width_guard(inputs.scenes(spark, sf_dir), inputs.PIXEL_M)


@query(
    "percent_of_extent",
    tables_sql("mosaic")
    + """SELECT yr, n_match, n_extent, ROUND(n_match/n_extent*100e0,6) AS percent FROM (
    SELECT yr, COUNT(*) FILTER (WHERE value=1) AS n_match,
    (MAX(ix)-MIN(ix)+1)*(MAX(iy)-MIN(iy)+1) AS n_extent FROM mosaic GROUP BY 1)""",
)
def percent_of_extent(spark, sf_dir):
    share = raster.percent_of_extent(cells(spark, sf_dir), ["yr"], F.col("value") == 1)
    return share.withColumn("percent", F.round("percent", 6))


def _box_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inputs.scenes(spark, sf_dir)
    return found.withColumn("geometry", F.expr(g.rectangle("minx", "miny", "maxx", "maxy")))


@query(
    "search_scenes",
    tables_sql("scenes", "zone_edges")
    + f""", rings AS (SELECT s.scene_id, e.zone_id, e.part, e.ring,
     ABS(SUM({overlap_sql("e", "x1", "y1", "x2", "y2", "s")})) AS ar
     FROM scenes s JOIN zone_edges e ON s.yr BETWEEN 1996 AND 1997 GROUP BY 1,2,3,4)
    SELECT scene_id, zone_id, part FROM rings GROUP BY 1,2,3 HAVING SUM(CASE WHEN ring=0 THEN ar ELSE -ar END)>1e2""",
)
def search_scenes(spark, sf_dir):
    found = filters.search_scenes(
        _box_scenes(spark, sf_dir), parts_m(spark, sf_dir), ["scene_id"], "1996/1997-06", cell=1e6
    )
    return found.select("scene_id", "zone_id", "part")


@query(
    "filter_collection",
    tables_sql("scenes")
    + "SELECT yr, COUNT(*) AS n_scenes FROM scenes WHERE collection='even' GROUP BY 1",
)
def filter_collection(spark, sf_dir):
    kept = filters.filter_collection(inputs.scenes(spark, sf_dir), ["even"])
    return kept.groupBy("yr").agg(F.count("*").alias("n_scenes"))


@query(
    "parse_value_lists",
    """SELECT event_id, CASE WHEN event_type='error' THEN NULL WHEN event_type='click' THEN 1 ELSE 2 END AS n_numbers,
    CASE WHEN event_type='error' THEN NULL WHEN event_type='click' THEN 0 ELSE 1 END AS n_texts,
    CASE WHEN event_type<>'error' THEN CAST(user_id AS DOUBLE) END AS first_number,
    CASE WHEN event_type NOT IN ('error','click') THEN event_type END AS first_text FROM events""",
)
def parse_value_lists(spark, sf_dir):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    listed = (
        F.when(kind == "click", user)
        .when(kind != "error", F.concat(user, F.lit(", "), kind, F.lit(" , 7.5")))
    )
    spec = inputs.table(spark, sf_dir, "events").select("event_id", listed.alias("value"))
    return filters.parse_value_lists(spec).select(
        "event_id",
        F.when(F.col("numbers").isNotNull(), F.size("numbers")).alias("n_numbers"),
        F.when(F.col("texts").isNotNull(), F.size("texts")).alias("n_texts"),
        F.get("numbers", F.lit(0)).alias("first_number"),
        F.get("texts", F.lit(0)).alias("first_text"),
    )


@query(
    "select_zones",
    """SELECT s_suppkey AS zone_id, s_name AS zone_name FROM supplier
    WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)""",
)
def select_zones(spark, sf_dir):
    ids = inputs.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("zone_id"))
    return filters.select_zones(inputs.zones(spark, sf_dir), ids).select("zone_id", "zone_name")


@query(
    "filter_by_names",
    f"""SELECT {uuid5_sql("'zones.parquet2024-01-01T00:00:00'||s_suppkey")} AS zone_id, s_name AS zone_name,
    CASE WHEN s_acctbal>=0 THEN 'credit' ELSE 'debit' END AS standing FROM supplier
    WHERE s_acctbal>=0 OR s_name='Supplier#000000004'""",
)
def filter_by_names(spark, sf_dir):
    named = inputs.zones(spark, sf_dir).select(
        F.col("zone_id").alias("source_row"),
        "zone_name",
        F.when(F.col("balance") >= 0, " credit ").otherwise("debit").alias("standing"),
    )
    kept = filters.filter_by_names(
        named, ["zone_name", "standing"], ["credit", " Supplier#000000004"],
        "zones.parquet", "2024-01-01T00:00:00", "source_row",
    )
    return kept.select("zone_id", "zone_name", F.trim("standing").alias("standing"))
