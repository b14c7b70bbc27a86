"""Queries of the join and indicator operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.operators import indicators, joins
from zonewright.operators.geometry import zone_pieces
from zonewright.plans import inputs
from zonewright.plans.geometry_queries import RUNS_SQL, overlap_sql, runs, spread_parts, zone_parts
from zonewright.plans.inputs import tables_sql
from zonewright.plans.raster_queries import cells, parts_m, pieces_m
from zonewright.plans.registry import query
from zonewright.sources.files import bbox_index

CELL_M2 = float(inputs.PIXEL_M) ** 2
YEARS = list(range(1995, 2002))


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_pieces(inputs.zones(spark, sf_dir).select("zone_id", "geometry"))


def partitioned_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points with the keys of the 10-degree file they would be stored in."""
    return inputs.points(spark, sf_dir).withColumns(
        {
            "country_code": F.concat(F.lit("L"), F.floor(F.col("lon") / 10).cast("string")),
            "s2_code": F.floor(F.col("lat") / 10).cast("string"),
        }
    )


PARTITIONED_SQL = """partitioned AS (SELECT *, 'L'||CAST(CAST(FLOOR(lon/10e0) AS BIGINT) AS VARCHAR) AS country_code,
    CAST(CAST(FLOOR(lat/10e0) AS BIGINT) AS VARCHAR) AS s2_code FROM points),
    partition_index AS (SELECT country_code, s2_code, MIN(lon) AS minx, MIN(lat) AS miny, MAX(lon) AS maxx, MAX(lat) AS maxy
    FROM partitioned GROUP BY 1,2)"""


@query("spatial_join_points", tables_sql("point_hits") + "SELECT point_id, zone_id, part FROM point_hits")
def spatial_join_points(spark, sf_dir):
    hits = joins.spatial_join_points(
        inputs.points(spark, sf_dir), zone_parts(spark, sf_dir), ["zone_id", "part"], ["point_id"]
    )
    return hits.select("point_id", "zone_id", "part")


@query(
    "spatial_join_points_shuffled",
    tables_sql("point_hits") + "SELECT point_id, zone_id, part FROM point_hits",
)
def spatial_join_points_shuffled(spark, sf_dir):
    hits = joins.spatial_join_points(
        inputs.points(spark, sf_dir), zone_parts(spark, sf_dir), ["zone_id", "part"], ["point_id"],
        broadcast_bytes=0,
    )
    return hits.select("point_id", "zone_id", "part")


@query(
    "spatial_join_polygons",
    tables_sql("feature_hits") + "SELECT feature_id, zone_id, part FROM feature_hits",
)
def spatial_join_polygons(spark, sf_dir):
    pairs = joins.spatial_join_polygons(
        inputs.features(spark, sf_dir), spread_parts(spark, sf_dir), ["feature_id"]
    )
    return pairs.select("feature_id", "zone_id", "part")


@query(
    "spatial_join_polygons_shuffled",
    tables_sql("feature_hits") + "SELECT feature_id, zone_id, part FROM feature_hits",
)
def spatial_join_polygons_shuffled(spark, sf_dir):
    pairs = joins.spatial_join_polygons(
        inputs.features(spark, sf_dir), spread_parts(spark, sf_dir), ["feature_id"], broadcast_bytes=0
    )
    return pairs.select("feature_id", "zone_id", "part")


@query(
    "prune_partitions",
    tables_sql("points", "zone_edges")
    + f""", {PARTITIONED_SQL}, rings AS (SELECT i.country_code, i.s2_code, e.zone_id, e.part, e.ring,
     ABS(SUM({overlap_sql("e", "lon1", "lat1", "lon2", "lat2", "i")})) AS ar
     FROM partition_index i JOIN zone_edges e ON TRUE GROUP BY 1,2,3,4,5)
    SELECT zone_id, part, country_code, s2_code FROM rings GROUP BY 1,2,3,4
    HAVING SUM(CASE WHEN ring=0 THEN ar ELSE -ar END)>1e-9""",
)
def prune_partitions(spark, sf_dir):
    keys = ["country_code", "s2_code"]
    index = bbox_index(partitioned_points(spark, sf_dir), keys)
    return joins.prune_partitions(index, zone_parts(spark, sf_dir), keys, ["zone_id", "part"])


@query(
    "pixels_in_zones",
    tables_sql("pixel_hits") + "SELECT zone_id, part, pixel_id, yr, value FROM pixel_hits",
)
def pixels_in_zones(spark, sf_dir):
    hits = joins.pixels_in_zones(
        cells(spark, sf_dir), pieces_m(spark, sf_dir), indicators.PIECE, ["pixel_id"]
    )
    return hits.select("zone_id", "part", "pixel_id", "yr", "value")


@query(
    "work_list",
    """SELECT s_suppkey AS zone_id, y.year FROM supplier CROSS JOIN (VALUES ('2018'),('2019'),('2020')) AS y(year)
    WHERE s_acctbal>=0""",
)
def work_list(spark, sf_dir):
    zones = inputs.zones(spark, sf_dir)
    return joins.work_list(zones, ["2018", "2019", "2020"], zones.filter(F.col("balance") < 0))


@query(
    "pending",
    """SELECT s_suppkey AS zone_id, CAST(y.year AS INT) AS year FROM supplier
    CROSS JOIN (SELECT UNNEST(generate_series(1995,2001)) AS year) y
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey=s_suppkey AND YEAR(l_shipdate)=y.year
     AND l_returnflag='A' AND l_linestatus='F' AND l_quantity>45)""",
)
def pending(spark, sf_dir):
    lines = inputs.table(spark, sf_dir, "lineitem")
    done = lines.filter(
        "l_returnflag = 'A' AND l_linestatus = 'F' AND l_quantity > 45"
    ).select(F.col("l_suppkey").alias("zone_id"), F.year("l_shipdate").alias("year"))
    return joins.pending(
        joins.work_list(inputs.zones(spark, sf_dir), YEARS), done, ["zone_id", "year"]
    )


@query(
    "attach_values",
    tables_sql("product_values")
    + """SELECT s.s_suppkey AS zone_id, s.s_name AS zone_name, p.indicator, p.value/1e6 AS value_display,
    format('{:,.2f} km²', p.value/1e6) AS value_label
    FROM supplier s LEFT JOIN (SELECT * FROM product_values WHERE year=(SELECT MAX(year) FROM product_values)) p
    ON p.zone_id=s.s_suppkey ORDER BY value_display DESC NULLS LAST, zone_id LIMIT 10""",
)
def attach_values(spark, sf_dir):
    values = inputs.product_values(spark, sf_dir).select(
        "zone_id", "indicator", "year", (F.col("value") / 1e6).alias("value_display")
    )
    zones = inputs.zones(spark, sf_dir).select("zone_id", "zone_name")
    shown = joins.attach_values(zones, values, value="value_display", k=10)
    return shown.select("zone_id", "zone_name", "indicator", "value_display", "value_label")


@query(
    "lineage",
    """WITH d AS (SELECT p_brand AS id, MIN(p_partkey) AS run FROM part GROUP BY 1),
    z AS (SELECT p_type AS id, MAX(p_partkey) AS run FROM part GROUP BY 1)
    SELECT p.p_partkey AS product_id, p.p_name AS product_name, d.id AS dataset_name, z.id AS zone_set_name,
    's3://runs/'||p.p_partkey AS product_data_url, 's3://runs/'||d.run AS dataset_data_url,
    's3://runs/'||z.run AS zone_set_data_url, p.p_size AS product_data_size
    FROM part p JOIN d ON d.id=p.p_brand JOIN z ON z.id=p.p_type WHERE d.id='Brand#2'""",
)
def lineage(spark, sf_dir):
    part = inputs.table(spark, sf_dir, "part")

    def named(column: str, run) -> DataFrame:
        return part.groupBy(F.col(column).alias("id")).agg(run.alias("main_run_id")).withColumn(
            "name", F.col("id")
        )

    made = part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_partkey").alias("main_run_id"),
        F.col("p_brand").alias("dataset_id"), F.col("p_type").alias("zone_set_id"),
    )
    run_rows = part.select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("s3://runs/"), "p_partkey").alias("data_url"),
        F.col("p_size").alias("data_size"),
    )
    chain = joins.lineage(
        made, named("p_brand", F.min("p_partkey")), named("p_type", F.max("p_partkey")), run_rows,
        dataset_name="Brand#2",
    )
    return chain.select(
        "product_id", "product_name", "dataset_name", "zone_set_name", "product_data_url",
        "dataset_data_url", "zone_set_data_url", "product_data_size",
    )


@query(
    "validate_indicators",
    tables_sql("product_values")
    + "SELECT indicator AS key, COUNT(*) AS n_values FROM product_values GROUP BY 1",
)
def validate_indicators(spark, sf_dir):
    spec = inputs.product_values(spark, sf_dir).withColumnRenamed("indicator", "key")
    checked, _ = indicators.validate_indicators(spec, datetime_match="2020")
    return checked.groupBy("key").agg(F.count("*").alias("n_values"))


@query(
    "classify_indicators",
    """SELECT p_partkey, CASE WHEN p_size<=15 THEN 'sum-area' WHEN p_size<=30 THEN 'percent-area' WHEN p_size<=45 THEN 'count' ELSE 'other' END AS kind,
    CASE WHEN p_size>15 AND p_size<=30 THEN 1 ELSE 0 END AS rank FROM part""",
)
def classify_indicators(spark, sf_dir):
    size, thing = F.col("p_size"), F.lower("p_type")
    key = (
        F.when(size <= 15, F.concat(F.lit("sum-"), thing, F.lit("-area")))
        .when(size <= 30, F.concat(F.lit("percent-"), thing, F.lit("-area")))
        .when(size <= 45, F.concat(F.lit("count-"), thing))
        .otherwise(F.concat(F.lit("mean-"), thing))
    )
    spec = inputs.table(spark, sf_dir, "part").select("p_partkey", key.alias("key"))
    return indicators.classify_indicators(spec).select("p_partkey", "kind", "rank")


ZONE_YEARS_SQL = """zone_years AS (SELECT s_suppkey AS zone_id, CAST(y.yr AS INT) AS yr FROM supplier
    CROSS JOIN (SELECT UNNEST(generate_series(1995,2001)) AS yr) y)"""


def raster_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area of value 1 per zone and year, zero where there is none."""
    sums = indicators.sum_area_raster(
        cells(spark, sf_dir), pieces_m(spark, sf_dir), CELL_M2, ["pixel_id"], [1.0], ["yr"]
    )
    work = joins.work_list(inputs.zones(spark, sf_dir), YEARS).withColumnRenamed("year", "yr")
    return indicators.fill_zones(work, sums, ["zone_id", "yr"], "area_m2")


@query(
    "sum_area_raster",
    tables_sql("pixel_hits")
    + f""", {ZONE_YEARS_SQL}, sums AS (SELECT zone_id, yr, COUNT(*)*2.5e9 AS a FROM pixel_hits WHERE value=1 GROUP BY 1,2)
    SELECT w.zone_id, w.yr, COALESCE(s.a,0e0) AS area_m2 FROM zone_years w LEFT JOIN sums s ON s.zone_id=w.zone_id AND s.yr=w.yr""",
)
def sum_area_raster(spark, sf_dir):
    return raster_areas(spark, sf_dir).select("zone_id", "yr", "area_m2")


@query(
    "sum_area_vector",
    tables_sql("feature_hits", "feature_area")
    + """, per_piece AS (SELECT h.zone_id, h.part, ROUND(SUM(a.area_m2),2) AS a FROM feature_hits h
     JOIN feature_area a ON a.feature_id=h.feature_id GROUP BY 1,2),
    once AS (SELECT h.zone_id, SUM(a.area_m2) AS a FROM (SELECT DISTINCT zone_id, feature_id FROM feature_hits) h
     JOIN feature_area a ON a.feature_id=h.feature_id GROUP BY 1)
    SELECT p.zone_id, ROUND(SUM(p.a)/1e6,3) AS area_km2, ROUND(MAX(o.a)/1e6,3) AS once_km2
    FROM per_piece p JOIN once o ON o.zone_id=p.zone_id GROUP BY 1""",
)
def sum_area_vector(spark, sf_dir):
    # whole parts stand for pieces here; the tiled form is checked by brute force in the tests
    parts = spread_parts(spark, sf_dir).withColumn("tile", F.lit(0))
    features = inputs.features(spark, sf_dir)
    per_piece = indicators.sum_area_vector(features, parts, ["feature_id"])
    once = indicators.sum_area_vector(features, parts, ["feature_id"], dedupe=True)
    return per_piece.join(once.withColumnRenamed("area_m2", "_once"), "zone_id").select(
        "zone_id",
        F.round(F.col("area_m2") / 1e6, 3).alias("area_km2"),
        F.round(F.col("_once") / 1e6, 3).alias("once_km2"),
    )


def clipped_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.sum_area_vector_clipped(
        runs(spark, sf_dir), parts_m(spark, sf_dir).withColumn("tile", F.lit(0)), ["yr", "iy", "ix_first"], ["yr"]
    )


CLIPPED_SQL = f"""{RUNS_SQL}, boxes AS (SELECT yr, iy, ix_first, (ix_first-100)*5e4 AS minx, (iy-100)*5e4 AS miny,
    (ix_last-99)*5e4 AS maxx, (iy-99)*5e4 AS maxy FROM runs),
    rings AS (SELECT b.yr, b.iy, b.ix_first, e.zone_id, e.part, e.ring,
     ABS(SUM({overlap_sql("e", "x1", "y1", "x2", "y2", "b")})) AS ar
     FROM boxes b JOIN zone_edges e ON TRUE GROUP BY 1,2,3,4,5,6),
    clipped AS (SELECT zone_id, yr, SUM(CASE WHEN ring=0 THEN ar ELSE -ar END) AS a FROM rings GROUP BY 1,2)"""


@query(
    "sum_area_vector_clipped",
    tables_sql("mosaic", "zone_edges")
    + f""", {ZONE_YEARS_SQL}, {CLIPPED_SQL} SELECT w.zone_id, w.yr, ABS(ROUND(COALESCE(c.a,0e0)/1e6,3)) AS area_km2
    FROM zone_years w LEFT JOIN clipped c ON c.zone_id=w.zone_id AND c.yr=w.yr""",
)
def sum_area_vector_clipped(spark, sf_dir):
    work = joins.work_list(inputs.zones(spark, sf_dir), YEARS).withColumnRenamed("year", "yr")
    areas = indicators.fill_zones(work, clipped_areas(spark, sf_dir), ["zone_id", "yr"], "area_m2")
    return areas.select("zone_id", "yr", F.abs(F.round(F.col("area_m2") / 1e6, 3)).alias("area_km2"))


@query(
    "count_in_zones",
    tables_sql("point_hits")
    + """SELECT s_suppkey AS zone_id, COUNT(h.point_id) AS n_points FROM supplier
    LEFT JOIN point_hits h ON h.zone_id=s_suppkey GROUP BY 1""",
)
def count_in_zones(spark, sf_dir):
    keys = ["country_code", "s2_code"]
    points = partitioned_points(spark, sf_dir)
    return indicators.count_in_zones(
        points, bbox_index(points, keys), inputs.zones(spark, sf_dir), keys, ["point_id"]
    )


@query(
    "percent_area",
    tables_sql("pixel_hits", "part_area")
    + """, sums AS (SELECT zone_id, COUNT(*)*2.5e9 AS a FROM pixel_hits WHERE value IN (1,2) GROUP BY 1),
    totals AS (SELECT zone_id, SUM(area_m2) AS t FROM part_area GROUP BY 1)
    SELECT t.zone_id, ROUND(COALESCE(s.a/t.t*100e0,0e0),5) AS percent FROM totals t LEFT JOIN sums s ON s.zone_id=t.zone_id""",
)
def percent_area(spark, sf_dir):
    shapes = pieces_m(spark, sf_dir)
    sums = indicators.sum_area_raster(
        cells(spark, sf_dir), shapes, CELL_M2, ["pixel_id"], [1.0, 2.0]
    )
    share = indicators.percent_area(sums, indicators.zone_totals(shapes))
    return share.select("zone_id", F.round("percent", 5).alias("percent"))


def all_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = spark.createDataFrame(
        [
            ("sum-mangrove-area", "mangrove", "1"),
            ("percent-mangrove-area", "mangrove", "1"),
            ("sum-reef-area", "mangrove", "2, 3"),
            ("percent-seagrass-area", "mangrove", None),
            ("count-buildings", "buildings", None),
        ],
        "key string, name string, value string",
    )
    return indicators.compute_indicators(
        inputs.zones(spark, sf_dir), spec, YEARS,
        pixels=cells(spark, sf_dir).withColumn("asset", F.lit("mangrove")),
        cell_area_m2=CELL_M2, pixel_key=["pixel_id"],
        points=inputs.points(spark, sf_dir), point_key=["point_id"],
    )


@query(
    "compute_indicators",
    tables_sql("pixel_hits", "part_area", "point_hits")
    + f""", {ZONE_YEARS_SQL}, counts AS (SELECT zone_id, yr, COUNT(*) FILTER (WHERE value=1)*2.5e9 AS one,
     COUNT(*) FILTER (WHERE value IN (2,3))*2.5e9 AS two_three FROM pixel_hits GROUP BY 1,2),
    totals AS (SELECT zone_id, SUM(area_m2) AS t FROM part_area GROUP BY 1),
    counted AS (SELECT zone_id, COUNT(*) AS n FROM point_hits GROUP BY 1),
    wide AS (SELECT w.zone_id, w.yr AS year, COALESCE(c.one,0e0) AS one, COALESCE(c.two_three,0e0) AS two_three,
     t.t, COALESCE(p.n,0) AS n FROM zone_years w LEFT JOIN counts c ON c.zone_id=w.zone_id AND c.yr=w.yr
     JOIN totals t ON t.zone_id=w.zone_id LEFT JOIN counted p ON p.zone_id=w.zone_id)
    SELECT zone_id, year, 'sum-mangrove-area' AS key, ROUND(one,5) AS value FROM wide
    UNION ALL SELECT zone_id, year, 'percent-mangrove-area', ROUND(one/t*100e0,5) FROM wide
    UNION ALL SELECT zone_id, year, 'sum-reef-area', ROUND(two_three,5) FROM wide
    UNION ALL SELECT zone_id, year, 'percent-seagrass-area', 0e0 FROM wide
    UNION ALL SELECT zone_id, year, 'count-buildings', CAST(n AS DOUBLE) FROM wide""",
)
def compute_indicators(spark, sf_dir):
    return all_indicators(spark, sf_dir).select(
        "zone_id", "year", F.explode("indicators").alias("key", "value")
    ).withColumn("value", F.round("value", 5))


@query(
    "zonal_mean",
    tables_sql("pixel_hits")
    + """SELECT s_suppkey AS zone_id, ROUND(AVG(value),6) AS mean_value, ROUND(AVG(value)*MAX(s_nationkey),6) AS weighted
    FROM supplier LEFT JOIN pixel_hits h ON s_suppkey=h.zone_id GROUP BY 1""",
)
def zonal_mean(spark, sf_dir):
    # a zone attribute times the mean gives the covered share of that attribute
    means = indicators.zonal_mean(cells(spark, sf_dir), pieces_m(spark, sf_dir), ["pixel_id"])
    return means.join(inputs.zones(spark, sf_dir).select("zone_id", "nation"), "zone_id").select(
        "zone_id",
        F.round("mean_value", 6).alias("mean_value"),
        F.round(F.col("mean_value") * F.col("nation"), 6).alias("weighted"),
    )


@query(
    "raster_vs_vector",
    tables_sql("pixel_hits", "zone_edges")
    + f""", {ZONE_YEARS_SQL}, {CLIPPED_SQL}, sums AS (SELECT zone_id, yr, COUNT(*)*2.5e9 AS a FROM pixel_hits WHERE value=1 GROUP BY 1,2)
    SELECT w.zone_id, w.yr, ROUND(COALESCE(s.a,0e0)/1e6,3) AS raster_km2, ABS(ROUND(COALESCE(c.a,0e0)/1e6,3)) AS vector_km2,
     ROUND((COALESCE(s.a,0e0)-COALESCE(c.a,0e0))/1e6,3)+0e0 AS diff_km2
    FROM zone_years w LEFT JOIN sums s ON s.zone_id=w.zone_id AND s.yr=w.yr
    LEFT JOIN clipped c ON c.zone_id=w.zone_id AND c.yr=w.yr""",
)
def raster_vs_vector(spark, sf_dir):
    raster = indicators.sum_area_raster(
        cells(spark, sf_dir), pieces_m(spark, sf_dir), CELL_M2, ["pixel_id"], [1.0], ["yr"]
    )
    both = indicators.raster_vs_vector(raster, clipped_areas(spark, sf_dir), ["zone_id", "yr"])
    work = joins.work_list(inputs.zones(spark, sf_dir), YEARS).withColumnRenamed("year", "yr")
    filled = work.join(both, ["zone_id", "yr"], "left").fillna(0.0, ["raster_m2", "vector_m2", "diff_m2"])
    return filled.select(
        "zone_id",
        "yr",
        F.round(F.col("raster_m2") / 1e6, 3).alias("raster_km2"),
        F.abs(F.round(F.col("vector_m2") / 1e6, 3)).alias("vector_km2"),
        (F.round(F.col("diff_m2") / 1e6, 3) + 0e0).alias("diff_km2"),
    )
