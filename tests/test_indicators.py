from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shapes import box, covers, intersects, ring, zones
from zonewright.functions import geometry as g
from zonewright.operators import filters, indicators as ind
from zonewright.operators.geometry import explode_parts, project_zones, unproject_zones, with_area_m2, zone_pieces

SIZES = [ind.BROADCAST_BYTES, 0]
# the sample outline of one zone in the Gulf of Guinea, against one 1 x 1 degree scene
SAMPLE = [[ring((8.64, -0.57), (8.72, -0.6), (8.79, -0.57), (8.81, -0.66), (8.76, -0.75), (8.68, -0.74), (8.63, -0.58))]]


def test_vector_area_counts_the_whole_feature(spark):
    scene = zones(spark, {1: [[box(8, -1, 9, 0)]]}, "feature_id")
    got = ind.sum_area_vector(scene, zone_pieces(zones(spark, {7: SAMPLE})), ["feature_id"]).collect()
    assert [(r["zone_id"], r["area_m2"]) for r in got] == [(7, 12308463893.98)]


@pytest.mark.parametrize("limit", SIZES)
def test_vector_area_counts_once_per_piece(spark, limit):
    rng = random.Random(4)
    features = {}
    for i in range(150):
        x, y, h = rng.uniform(-2, 14), rng.uniform(-2, 14), rng.uniform(0.05, 1.5)
        features[i] = [[ring((x - h, y), (x, y - h), (x + h, y), (x, y + h))]]
    shapes = {1: [[ring((0, 0), (12, 0), (12, 4), (4, 4), (4, 12), (0, 12)), box(1, 1, 3, 3)]], 2: [[box(5, 5, 6, 6)], [box(7, 7, 8, 8)]]}
    pieces = zone_pieces(zones(spark, shapes))
    listed = [(r["zone_id"], r["geometry"]) for r in pieces.collect()]
    assert len(listed) > 6
    area = {r["feature_id"]: r["area_m2"] for r in with_area_m2(zones(spark, features, "feature_id")).collect()}
    expected, once = {}, {}
    for zone, shape in listed:
        hit = [f for f, s in features.items() if intersects(s, shape)]
        expected[zone] = expected.get(zone, 0) + round(sum(area[f] for f in hit), 2)
        once.setdefault(zone, set()).update(hit)
    df = zones(spark, features, "feature_id")
    got = {r["zone_id"]: r["area_m2"] for r in ind.sum_area_vector(df, pieces, ["feature_id"], broadcast_bytes=limit).collect()}
    assert got == pytest.approx(expected, rel=1e-12)
    dedup = ind.sum_area_vector(df, pieces, ["feature_id"], dedupe=True, broadcast_bytes=limit).collect()
    assert {r["zone_id"]: r["area_m2"] for r in dedup} == pytest.approx({z: sum(area[f] for f in s) for z, s in once.items()})
    assert sum(got.values()) > sum(r["area_m2"] for r in dedup)


def raster(spark, seed=2, n=60, side=40_000.0):
    rng = random.Random(seed)
    rows = [
        (ix * 1000 + iy, ix, iy, 2020 + rng.randint(0, 1), rng.choice([None, 0.0, 1.0, 2.0, 3.0]), (ix - 5 + 0.5) * side, (iy - 5 + 0.5) * side)
        for ix in range(n)
        for iy in range(n)
    ]
    return rows, spark.createDataFrame(rows, "pixel_id long, ix int, iy int, yr int, value double, x double, y double")


SHAPES = {
    1: [[ring((0, 0), (12, 0), (12, 4), (4, 4), (4, 12), (0, 12)), box(1, 1, 3, 3)]],
    2: [[box(5, 5, 6, 6)], [ring((9, 9), (14, 9), (11, 15))]],
    3: [[box(100, 0, 101, 1)]],
}


@pytest.mark.parametrize("limit", SIZES)
@pytest.mark.parametrize("cell", [50_000.0, 200_000.0, 5e6])
def test_raster_area_equals_brute_force(spark, limit, cell):
    rows, pixels = raster(spark)
    pieces = project_zones(zone_pieces(zones(spark, SHAPES)))
    metres = [(r["zone_id"], r["geometry"]) for r in pieces.collect()]
    expected = {}
    for zone, shape in metres:
        for _, _, _, yr, value, x, y in rows:
            if value in (1.0, 2.0) and covers(shape, x, y):
                expected[zone, yr] = expected.get((zone, yr), 0) + 1.6e9
    got = ind.sum_area_raster(pixels, pieces, 1.6e9, ["pixel_id"], [1.0, 2.0], ["yr"], cell, limit)
    assert {(r["zone_id"], r["yr"]): r["area_m2"] for r in got.collect()} == expected
    assert len(expected) == 4


def test_rounding_happens_per_piece(spark):
    rows, pixels = raster(spark)
    pieces = project_zones(zone_pieces(zones(spark, SHAPES)))
    unit = 0.123456
    per_piece = ind.zonal_aggregate(pixels.filter("value = 1"), pieces, ind.PIECE, [], ["pixel_id"]).collect()
    expected = {}
    for r in per_piece:
        expected[r["zone_id"]] = expected.get(r["zone_id"], 0) + round(r["n"] * unit + 1e-12, 2)
    got = ind.sum_area_raster(pixels, pieces, unit, ["pixel_id"], [1.0])
    assert {r["zone_id"]: r["area_m2"] for r in got.collect()} == pytest.approx(expected)


def test_no_value_list_means_every_valid_cell(spark):
    rows, pixels = raster(spark)
    pieces = project_zones(zone_pieces(zones(spark, {1: [[box(-89, -80, 89, 80)]]})))
    got = ind.sum_area_raster(pixels, pieces, 1.0, ["pixel_id"]).first()["area_m2"]
    assert got == sum(r[4] is not None for r in rows)


def test_percent_is_zero_without_a_sum(spark):
    shapes = project_zones(explode_parts(zones(spark, {1: [[box(0, 0, 1, 1)]], 2: []})).withColumn("tile", F.lit(0)))
    totals = spark.createDataFrame([(1, 100.0), (2, 0.0), (3, 50.0)], "zone_id bigint, zone_m2 double")
    sums = spark.createDataFrame([(1, 25.0), (2, 5.0)], "zone_id bigint, area_m2 double")
    got = {r["zone_id"]: r["percent"] for r in ind.percent_area(sums, totals).collect()}
    assert got == {1: 25.0, 2: 0.0, 3: 0.0}
    assert shapes.count() == 2


def test_compute_indicators(spark):
    rows, pixels = raster(spark)
    spec = spark.createDataFrame(
        [("percent-reef-area", "reef", None), ("sum-reef-area", "reef", "1, 2"), ("sum-mangrove-area", "other", None),
         ("percent-saltmarsh-area", "reef", "1"), ("count-buildings", "b", None)],
        "key string, name string, value string",
    )
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 5.5, 5.5), (3, 0.25, 0.5)], "point_id int, lon double, lat double")
    with pytest.raises(Exception, match="unknown indicators: percent-reef-area"):
        ind.compute_indicators(zones(spark, SHAPES), spec, [2020], pixels.withColumn("asset", F.lit("reef")), 1.0, ["pixel_id"]).collect()
    spec = spec.filter("key <> 'percent-reef-area'").union(
        spark.createDataFrame([("percent-mangrove-area", "other", None)], spec.schema)
    )
    got = ind.compute_indicators(
        zones(spark, SHAPES), spec, [2020, 2021], pixels.withColumn("asset", F.lit("reef")), 1.6e9, ["pixel_id"],
        points, ["point_id"],
    ).collect()
    assert len(got) == 6
    pieces = project_zones(zone_pieces(zones(spark, SHAPES)))
    sums = {
        (r["zone_id"], r["yr"]): r["area_m2"]
        for r in ind.sum_area_raster(pixels, pieces, 1.6e9, ["pixel_id"], [1.0, 2.0], ["yr"]).collect()
    }
    counts = {1: 2.0, 2: 1.0, 3: 0.0}
    for r in got:
        assert r["indicators"] == {
            "sum-reef-area": sums.get((r["zone_id"], r["year"]), 0.0),
            "sum-mangrove-area": 0.0,
            "percent-mangrove-area": 0.0,
            "percent-saltmarsh-area": 0.0,
            "count-buildings": counts[r["zone_id"]],
        }


def test_indicator_spec_checks(spark):
    spec = spark.createDataFrame([("sum-reef-area",), ("sum-tree-area",)], "key string")
    with pytest.raises(ValueError, match="datetime"):
        ind.validate_indicators(spec)
    checked, when = ind.validate_indicators(spec, None, "2020")
    assert when == "2020" and ind.validate_indicators(spec, "2020-01", "2020")[1] == "2020-01"
    with pytest.raises(Exception, match="unknown indicators: sum-tree-area"):
        checked.collect()


def test_zonal_mean_and_clipped_area(spark):
    rows, pixels = raster(spark)
    pieces = project_zones(zone_pieces(zones(spark, SHAPES)))
    metres = [(r["zone_id"], r["geometry"]) for r in pieces.collect()]
    values = {}
    for zone, shape in metres:
        values.setdefault(zone, []).extend(v for _, _, _, _, v, x, y in rows if v is not None and covers(shape, x, y))
    got = {r["zone_id"]: r["mean_value"] for r in ind.zonal_mean(pixels, pieces, ["pixel_id"]).collect()}
    means = {z: sum(v) / len(v) for z, v in values.items() if v}
    assert {z: v for z, v in got.items() if v is not None} == pytest.approx(means)
    assert set(got) == {z for z, _ in metres}
    # one rectangle over everything gives the zone's own area
    world = spark.createDataFrame([(1, -1e6, -1e6, 2e7, 2e7)], "k int, minx double, miny double, maxx double, maxy double")
    world = world.withColumn("geometry", F.expr(g.rectangle("minx", "miny", "maxx", "maxy")))
    clipped = {r["zone_id"]: r["area_m2"] for r in ind.sum_area_vector_clipped(world, pieces, ["k"], cell=1e6).collect()}
    totals = {r["zone_id"]: r["zone_m2"] for r in ind.zone_totals(pieces).collect()}
    assert clipped == pytest.approx(totals, rel=1e-9)


def test_mask_with_touching_cells(spark):
    rows, pixels = raster(spark)
    pieces = project_zones(zone_pieces(zones(spark, SHAPES)))
    centre = filters.mask_pixels(pixels, pieces, ["pixel_id"], ["zone_id"])
    touch = filters.mask_pixels(pixels, pieces, ["pixel_id"], ["zone_id"], touch_res=40_000.0)
    key = ["pixel_id", "zone_id"]
    assert centre.select(*key).exceptAll(touch.select(*key)).count() == 0
    assert touch.count() > centre.count() > 0
    assert unproject_zones(pieces).count() == len(pieces.collect())


def test_datetime_forms(spark):
    rows = [("a", "2019-12-31 00:00:00", "2020-01-01 00:00:00"), ("b", "2020-06-01 00:00:00", "2020-06-30 00:00:00"), ("c", "2021-01-01 00:00:00", "2021-12-31 00:00:00")]
    df = spark.createDataFrame(rows, "id string, s string, e string")

    def found(spec):
        test = filters.datetime_overlaps(spec, F.col("s").cast("timestamp_ntz"), F.col("e").cast("timestamp_ntz"))
        return "".join(sorted(r["id"] for r in df.filter(test).collect()))

    assert found("2020") == "ab"
    assert found("2020-06") == "b"
    assert found("2020-06-15T00:00:00Z") == "b"
    assert found("2020-06-15T00:00:00+10:00") == "b"
    assert found("../2020-01-15") == "a"
    assert found("2020-06/2021-03") == "bc"
    assert found("2020-07/..") == "c"
