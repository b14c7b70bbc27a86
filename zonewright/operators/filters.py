"""Scene search, zone selection, value lists."""

from __future__ import annotations

import calendar
import re
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from zonewright.functions import geometry as g
from zonewright.functions import text
from zonewright.functions.checks import require_each, require_none
from zonewright.operators.joins import spatial_join_points, spatial_join_polygons


def _instant_range(value: str) -> tuple[datetime, datetime]:
    """The first and last moment an ISO text of some precision stands for."""
    if re.fullmatch(r"\d{4}", value):
        year = int(value)
        return datetime(year, 1, 1), datetime(year + 1, 1, 1) - timedelta(microseconds=1)
    if re.fullmatch(r"\d{4}-\d{2}", value):
        year, month = (int(p) for p in value.split("-"))
        days = calendar.monthrange(year, month)[1]
        return datetime(year, month, 1), datetime(year, month, days, 23, 59, 59, 999999)
    moment = datetime.fromisoformat(value.replace("Z", "+00:00"))
    if moment.tzinfo is not None:
        moment = (moment - moment.utcoffset()).replace(tzinfo=None)
    if len(value) == 10:
        return moment, moment + timedelta(days=1) - timedelta(microseconds=1)
    return moment, moment


def datetime_overlaps(spec: str, start: Column, end: Column) -> Column:
    """Interval test for ``2020``, ``2020-07``, an instant, or ``start/end`` (``..`` is open)."""
    first, _, last = spec.partition("/")
    low = None if first in ("", "..") else _instant_range(first)[0]
    until = last if "/" in spec else first
    high = None if until in ("", "..") else _instant_range(until)[1]
    test = F.lit(True)
    if low is not None:
        test = test & (end.cast("timestamp_ntz") >= F.lit(low.isoformat()).cast("timestamp_ntz"))
    if high is not None:
        test = test & (start.cast("timestamp_ntz") <= F.lit(high.isoformat()).cast("timestamp_ntz"))
    return test


def search_scenes(
    scenes: DataFrame,
    zones: DataFrame,
    scene_key: list[str],
    datetime_spec: str | None = None,
    cell: float = 1.0,
) -> DataFrame:
    """(scene, zone) pairs: bounds meet, geometry meets and the time ranges overlap.

    Both sides need a ``geometry`` in the same coordinates; scenes also
    ``start_datetime`` and ``end_datetime``. The time test runs on the scan.
    """
    wanted = scenes
    if datetime_spec is not None:
        wanted = scenes.filter(
            datetime_overlaps(datetime_spec, F.col("start_datetime"), F.col("end_datetime"))
        )
    return spatial_join_polygons(wanted, zones, scene_key, cell=cell)


def filter_collection(items: DataFrame, collections: list[str]) -> DataFrame:
    """Scenes of the named collections."""
    return items.filter(F.col("collection").isin(*collections))


def parse_value_lists(spec: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``numbers`` and ``texts``: the parts of a comma list; both null for a null value."""
    given = F.col(value).cast("string")
    return spec.withColumns(
        {
            "numbers": F.when(given.isNotNull(), text.numeric_items(given)),
            "texts": F.when(given.isNotNull(), text.text_items(given)),
        }
    )


def mask_pixels(
    pixels: DataFrame,
    zone_pieces_m: DataFrame,
    pixel_key: list[str],
    zone_keys: list[str],
    cell: float = 200_000.0,
    touch_res: float | None = None,
) -> DataFrame:
    """Pixels inside any piece of a zone, once per zone.

    The test is on the cell centre; with ``touch_res`` (the cell side) every cell
    that touches the polygon counts.
    """
    pieces = zone_pieces_m.select(*zone_keys, "geometry")
    if touch_res is None:
        hits = spatial_join_points(pixels, pieces, zone_keys, pixel_key, "x", "y", cell=cell)
    else:
        half = touch_res / 2
        boxes = pixels.withColumn(
            "geometry",
            F.expr(g.rectangle(f"x - {half}D", f"y - {half}D", f"x + {half}D", f"y + {half}D")),
        )
        hits = spatial_join_polygons(boxes, pieces, pixel_key, cell=cell)
    return hits.dropDuplicates([*pixel_key, *zone_keys])


def select_zones(zones: DataFrame, ids: DataFrame, zone_id: str = "zone_id") -> DataFrame:
    """Zones by id; an id without a row, or with several, fails the job."""
    asked = ids.select(zone_id).distinct()
    found = zones.join(asked, zone_id, "left_semi")
    counts = found.groupBy(zone_id).agg(F.count("*").alias("_rows"))
    message = F.concat(
        F.lit("zone id "),
        F.col(zone_id).cast("string"),
        F.when(F.col("_rows").isNull(), " not found").otherwise(" is not unique"),
    )
    checked = require_each(asked.join(counts, zone_id, "left"), F.col("_rows") == 1, message)
    # a left join: an inner one would skip the checked side when no zone is found at all
    return checked.drop("_rows").join(found, zone_id, "left")


def filter_by_names(
    zones: DataFrame,
    fields: list[str],
    names: list[str],
    source_url: str,
    run_time: str,
    source_key: str,
    zone_id: str = "zone_id",
) -> DataFrame:
    """Rows where any field, trimmed, is a requested name; rows get a new id.

    A name found in no field fails the job. The id depends on the source, the
    run time and the row's own key.
    """
    absent = [f for f in fields if f not in zones.columns]
    if absent:
        raise ValueError(f"fields not found: {absent}")
    wanted = sorted({n.strip() for n in names if n.strip()})
    spark = zones.sparkSession
    asked = spark.createDataFrame([(n,) for n in wanted], "name string")
    trimmed = [F.trim(F.col(f).cast("string")) for f in fields]
    match = F.lit(False)
    for field in trimmed:
        match = match | F.coalesce(field.isin(*wanted), F.lit(False))
    kept = zones.filter(match)
    present = kept.select(F.explode(F.array(*trimmed)).alias("name")).distinct()
    missing = asked.join(present, "name", "left_anti")
    new_id = text.uuid5(F.concat(F.lit(source_url + run_time), F.col(source_key).cast("string")))
    return require_none(kept, missing, "names not found").withColumn(zone_id, new_id)
