"""Reading tables and GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from zonewright.functions import geometry as g
from zonewright.functions import projection as proj
from zonewright.functions.wkb import from_wkb, srid_of

_COORDINATES = "array<array<array<double>>>"


# Numbers of the systems that are read (0 is "not stated").
DEGREES, METRES = (0, 4326), 6933


def polygons_from_wkb(df: DataFrame, geometry: str = "geometry", srid: int = 4326) -> DataFrame:
    """A binary geometry column as polygons in degrees.

    Each row's own coordinate system counts, ``srid`` where the binary form names none. Metres of
    EPSG:6933 are turned into degrees; any other system fails the job.
    """
    number = F.coalesce(F.expr(srid_of(f"`{geometry}`")), F.lit(srid))
    degrees = g.map_vertices("_shape", proj.inverse_x("v.x"), proj.inverse_y("v.y"))
    unknown = F.concat(F.lit("coordinate system not supported: EPSG:"), F.col("_srid").cast("string"))
    shape = (
        F.when(F.col("_shape").isNull() | F.col("_srid").isin(*DEGREES), F.col("_shape"))
        .when(F.col("_srid") == METRES, F.expr(degrees))
        .otherwise(F.raise_error(unknown).cast(g.GEOMETRY))
    )
    unpacked = df.withColumns({"_srid": number, "_shape": from_wkb(F.col(geometry))})
    return unpacked.withColumn(geometry, shape).drop("_srid", "_shape")


def read_table(
    spark: SparkSession, url: str, geometry: str = "geometry", srid: int = 4326
) -> DataFrame:
    """Parquet, else GeoJSON, by suffix; a folder is read as Parquet.

    A binary geometry column, as GeoParquet has it, is unpacked to polygons in degrees. GeoParquet
    names its coordinate system in the footer, which Spark does not show: ``srid`` states it.
    """
    lowered = url.rstrip("/").lower()
    if lowered.endswith((".geojson", ".json")):
        return read_geojson(spark, url)
    name = lowered.rsplit("/", 1)[-1]
    if "." not in name or name.endswith(".parquet"):
        stored = spark.read.parquet(url)
        if geometry in stored.columns and stored.schema[geometry].dataType == T.BinaryType():
            return polygons_from_wkb(stored, geometry, srid)
        return stored
    raise ValueError(f"no reader for {url}")


def _ring(positions: Column) -> Column:
    return F.transform(
        positions,
        lambda p: F.named_struct(F.lit("x"), p[0], F.lit("y"), p[1]),
    )


def polygons_from_geojson(kind: Column, coordinates: Column) -> Column:
    """Polygon or MultiPolygon coordinates (JSON text) -> geometry column."""
    single = F.from_json(coordinates, _COORDINATES)
    several = F.from_json(coordinates, f"array<{_COORDINATES}>")
    polygons = F.when(kind == "Polygon", F.array(single)).when(kind == "MultiPolygon", several)
    return F.transform(polygons, lambda poly: F.transform(poly, _ring))


def read_geojson(
    spark: SparkSession, path: str, properties: str | None = None, lines: bool = False
) -> DataFrame:
    """FeatureCollection files -> one row per feature: properties and geometry.

    ``properties`` (DDL) names typed property columns; without it they stay a
    JSON text column. A multi-line document is one task's work; with ``lines``
    every line is a collection and large files are split.
    """
    schema = (
        "features array<struct<type string, properties string, "
        "geometry struct<type string, coordinates string>>>"
    )
    features = (
        spark.read.schema(schema).option("multiLine", not lines).json(path)
        .select(F.explode("features").alias("f"))
    )
    geometry = polygons_from_geojson(F.col("f.geometry.type"), F.col("f.geometry.coordinates"))
    if properties is None:
        return features.select(F.col("f.properties").alias("properties"), geometry.alias("geometry"))
    return features.select(
        F.from_json("f.properties", properties).alias("p"), geometry.alias("geometry")
    ).select("p.*", "geometry")


def zones_from_wkt(df: DataFrame, column: str = "wkt", geometry: str = "geometry") -> DataFrame:
    return df.withColumn(geometry, F.expr(g.from_wkt(f"`{column}`")))


def zones_to_wkt(df: DataFrame, column: str = "wkt", geometry: str = "geometry") -> DataFrame:
    return df.withColumn(column, F.expr(g.to_wkt(f"`{geometry}`")))


def merge_regions(tables: list[DataFrame]) -> DataFrame:
    """Region tables of unlike columns as one; missing columns are null."""
    if not tables:
        raise ValueError("no region tables to merge")
    merged = tables[0]
    for other in tables[1:]:
        merged = merged.unionByName(other, allowMissingColumns=True)
    return merged
