"""Scene items: reading, indexing, naming, dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from zonewright.functions.checks import require_each, require_none

ITEM_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("collection", T.StringType()),
        T.StructField("bbox", T.ArrayType(T.DoubleType())),
        T.StructField(
            "geometry",
            T.StructType(
                [T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]
            ),
        ),
        T.StructField(
            "properties",
            T.StructType(
                [
                    T.StructField("datetime", T.StringType()),
                    T.StructField("start_datetime", T.StringType()),
                    T.StructField("end_datetime", T.StringType()),
                    T.StructField("proj:epsg", T.IntegerType()),
                    T.StructField("proj:shape", T.ArrayType(T.IntegerType())),
                    T.StructField("proj:transform", T.ArrayType(T.DoubleType())),
                ]
            ),
        ),
        T.StructField(
            "assets",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [T.StructField("href", T.StringType()), T.StructField("type", T.StringType())]
                ),
            ),
        ),
    ]
)


def read_scene_items(
    spark: SparkSession, root: str, pattern: str = "*.stac-item.json", lines: bool = False
) -> DataFrame:
    """All scene documents below ``root`` with the ``url`` of their file, one per file or with ``lines`` one a line."""
    return (
        spark.read.schema(ITEM_SCHEMA)
        .option("multiLine", not lines)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .json(root)
        .withColumn("url", F.col("_metadata.file_path"))
    )


def rename_single_asset(items: DataFrame, name: str) -> DataFrame:
    """Gives the one asset a fixed name; an item without exactly one fails the job."""
    message = F.concat(
        F.lit("exactly one asset is needed, scene "),
        F.coalesce(F.col("id"), F.lit("?")),
        F.lit(" has "),
        F.coalesce(F.size("assets"), F.lit(0)).cast("string"),
    )
    single = require_each(items, F.size("assets") == 1, message)
    return single.withColumn("assets", F.transform_keys("assets", lambda key, _: F.lit(name)))


def index_scenes(
    items: DataFrame, wanted: DataFrame | None = None, asset_name: str | None = None
) -> DataFrame:
    """Index rows with plain bounds; ``wanted(url)`` lists items that all must exist."""
    chosen = items
    if wanted is not None:
        asked = wanted.select("url").distinct()
        absent = asked.join(items, "url", "left_anti")
        chosen = require_none(items.join(asked, "url", "left_semi"), absent, "scene items not found")
    if asset_name is not None:
        chosen = rename_single_asset(chosen, asset_name)
    corners = {name: F.get("bbox", F.lit(i)) for i, name in enumerate(("minx", "miny", "maxx", "maxy"))}
    return chosen.withColumns(corners)


def scene_dates(items: DataFrame, name: str = "scene_id") -> DataFrame:
    """start, mid and end date of the year a scene name stands for; other names give null.

    Names of the third series hold the year in the 11th to 8th character from
    the end; the fourth series is 2020.
    """
    # Series marks, position of the year, year of the fourth series.
    third = F.substring(F.col(name), -11, 4).try_cast("int")
    year = F.when(F.col(name).contains("_v3"), third).when(F.col(name).contains("_v4"), 2020)
    return items.withColumns(
        {
            "start_date": F.make_date(year, F.lit(1), F.lit(1)),
            "mid_date": F.make_date(year, F.lit(7), F.lit(2)),
            "end_date": F.make_date(year, F.lit(12), F.lit(31)),
        }
    )
