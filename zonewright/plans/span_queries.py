"""Queries of chunked rasters against zones by spans, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.operators import indicators, joins, raster, spans
from zonewright.plans import inputs
from zonewright.plans.indicator_queries import CELL_M2, YEARS, ZONE_YEARS_SQL
from zonewright.plans.inputs import PIXEL_M, tables_sql
from zonewright.plans.raster_queries import cells, parts_m, pieces_m
from zonewright.plans.registry import query

SIZE = 8
GRID = {"size": SIZE, "res": float(PIXEL_M), "origin": (-100.0 * PIXEL_M, -100.0 * PIXEL_M)}


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.pixels_to_chunks(cells(spark, sf_dir), SIZE, PIXEL_M, ["yr"])


def span_areas(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    sums = spans.sum_area_spans(
        chunks(spark, sf_dir), pieces_m(spark, sf_dir), CELL_M2, indicators.PIECE, ["yr"], **GRID,
        values=[1.0], **options,
    )
    work = joins.work_list(inputs.zones(spark, sf_dir), YEARS).withColumnRenamed("year", "yr")
    filled = indicators.fill_zones(work, sums, ["zone_id", "yr"], "area_m2")
    return filled.select("zone_id", "yr", "area_m2")


AREAS_SQL = (
    tables_sql("pixel_hits")
    + f""", {ZONE_YEARS_SQL}, sums AS (SELECT zone_id, yr, COUNT(*)*2.5e9 AS a FROM pixel_hits WHERE value=1 GROUP BY 1,2)
    SELECT w.zone_id, w.yr, COALESCE(s.a,0e0) AS area_m2 FROM zone_years w LEFT JOIN sums s ON s.zone_id=w.zone_id AND s.yr=w.yr"""
)


@query("sum_area_spans", AREAS_SQL)
def sum_area_spans(spark, sf_dir):
    return span_areas(spark, sf_dir)


@query("sum_area_spans_shuffled", AREAS_SQL)
def sum_area_spans_shuffled(spark, sf_dir):
    return span_areas(spark, sf_dir, broadcast_bytes=0)


@query(
    "zonal_mean_spans",
    tables_sql("pixel_hits")
    + """SELECT s_suppkey AS zone_id, ROUND(AVG(value),6) AS mean_value
    FROM supplier LEFT JOIN pixel_hits h ON s_suppkey=h.zone_id GROUP BY 1""",
)
def zonal_mean_spans(spark, sf_dir):
    means = spans.zonal_mean_spans(chunks(spark, sf_dir), pieces_m(spark, sf_dir), ["yr"], **GRID)
    return means.select("zone_id", F.round("mean_value", 6).alias("mean_value"))


@query(
    "mask_chunks", tables_sql("pixel_hits") + "SELECT DISTINCT zone_id, yr, ix, iy, value FROM pixel_hits"
)
def mask_chunks(spark, sf_dir):
    return spans.mask_chunks(chunks(spark, sf_dir), pieces_m(spark, sf_dir), ["zone_id"], ["yr"], **GRID)


@query(
    "classify_chunks",
    tables_sql("zone_edges")
    + f""", g AS (SELECT zone_id, part, (x1+5e6)/5e4 AS x1, (y1+5e6)/5e4 AS y1, (x2+5e6)/5e4 AS x2, (y2+5e6)/5e4 AS y2 FROM zone_edges),
    b AS (SELECT zone_id, part, CAST(FLOOR(MIN(LEAST(x1,x2))/{SIZE}) AS BIGINT) AS cx0, CAST(FLOOR(MAX(GREATEST(x1,x2))/{SIZE}) AS BIGINT) AS cx1,
     CAST(FLOOR(MIN(LEAST(y1,y2))/{SIZE}) AS BIGINT) AS cy0, CAST(FLOOR(MAX(GREATEST(y1,y2))/{SIZE}) AS BIGINT) AS cy1 FROM g GROUP BY 1,2),
    c AS (SELECT zone_id, part, chunk_x, UNNEST(generate_series(cy0,cy1)) AS chunk_y FROM
     (SELECT *, UNNEST(generate_series(cx0,cx1)) AS chunk_x FROM b))
    SELECT c.zone_id, c.part, chunk_x, chunk_y, CASE WHEN met>0 THEN 'crossed' ELSE 'inside' END AS kind FROM (
     SELECT c.zone_id, c.part, chunk_x, chunk_y,
      COUNT(*) FILTER (LEAST(x1,x2)<=(chunk_x+1)*{SIZE} AND GREATEST(x1,x2)>=chunk_x*{SIZE}
       AND LEAST(y1,y2)<=(chunk_y+1)*{SIZE} AND GREATEST(y1,y2)>=chunk_y*{SIZE}) AS met,
      COUNT(*) FILTER ((y1>(chunk_y+0.5e0)*{SIZE})<>(y2>(chunk_y+0.5e0)*{SIZE})
       AND (chunk_x+0.5e0)*{SIZE}<(x2-x1)*((chunk_y+0.5e0)*{SIZE}-y1)/(y2-y1)+x1) AS crossings
     FROM c JOIN g ON g.zone_id=c.zone_id AND g.part=c.part GROUP BY ALL) c WHERE met>0 OR crossings%2=1""",
)
def classify_chunks(spark, sf_dir):
    classes = spans.classify_chunks(parts_m(spark, sf_dir), ["zone_id", "part"], **GRID)
    kind = F.when(F.col("edges").isNull(), "inside").otherwise("crossed")
    return classes.select("zone_id", "part", "chunk_x", "chunk_y", kind.alias("kind"))
