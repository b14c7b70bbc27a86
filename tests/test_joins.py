from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shapes import box, covers, intersects, ring, zones
from zonewright.operators import joins

SIZES = [joins.BROADCAST_BYTES, 0]


def some_zones(seed: int = 5, n: int = 25) -> dict:
    rng = random.Random(seed)
    shapes = {}
    for i in range(n):
        x, y, s = rng.uniform(-8, 8), rng.uniform(-8, 8), rng.choice([0.3, 1.0, 4.0])
        shapes[i] = [[ring((x, y), (x + 3 * s, y), (x + 3 * s, y + s), (x + s, y + s), (x + s, y + 3 * s), (x, y + 3 * s))]]
    shapes[n] = [[box(-9, -9, 9, 9), box(-2, -2, 2, 2)]]
    shapes[n + 1] = [[box(1, 1, 3, 3)]]  # edges on cell borders
    return shapes


@pytest.mark.parametrize("limit", SIZES)
@pytest.mark.parametrize("cell", [0.7, 1.0, 25.0])
def test_point_join_equals_brute_force(spark, limit, cell):
    rng = random.Random(1)
    points = [(i, rng.uniform(-10, 10), rng.uniform(-10, 10)) for i in range(300)]
    points += [(300 + i, float(x), float(y)) for i, (x, y) in enumerate([(1, 1), (3, 3), (2, 1), (3, 2), (-2, 0), (9, 9), (-9, 4)])]
    shapes = some_zones()
    hits = joins.spatial_join_points(
        spark.createDataFrame(points, "point_id int, lon double, lat double"),
        zones(spark, shapes), ["zone_id"], ["point_id"], cell=cell, broadcast_bytes=limit,
    )
    got = sorted((r["point_id"], r["zone_id"]) for r in hits.collect())
    assert got == sorted((i, z) for i, x, y in points for z, s in shapes.items() if covers(s, x, y))


def test_points_without_coordinates_match_nothing(spark):
    points = spark.createDataFrame([(1, None, 0.0)], "point_id int, lon double, lat double")
    assert joins.spatial_join_points(points, zones(spark, some_zones()), ["zone_id"], ["point_id"]).count() == 0


def test_hot_cell_is_split_and_stays_whole(spark):
    shapes = {1: [[box(0.2, 0.2, 0.8, 0.8)]], 2: [[box(0.0, 0.0, 9.0, 9.0)]]}
    near = spark.range(20_000).select(
        F.col("id").alias("point_id"), F.lit(0.5).alias("lon"), F.lit(0.5).alias("lat")
    )
    wide = spark.range(20_000, 60_000).select(
        F.col("id").alias("point_id"),
        (F.col("id") % 997 * 0.009).alias("lon"), (F.col("id") % 991 * 0.009).alias("lat"),
    )
    points = near.unionByName(wide)
    a = joins.spatial_join_points(points, zones(spark, shapes), ["zone_id"], ["point_id"], broadcast_bytes=0)
    b = joins.spatial_join_points(points, zones(spark, shapes), ["zone_id"], ["point_id"])
    assert a.groupBy("zone_id").count().orderBy("zone_id").collect() == b.groupBy("zone_id").count().orderBy("zone_id").collect()
    assert a.filter("zone_id = 1").count() >= 20_000
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("limit", SIZES)
def test_polygon_join_equals_brute_force(spark, limit):
    rng = random.Random(9)
    features = {}
    for i in range(120):
        x, y, h = rng.uniform(-10, 10), rng.uniform(-10, 10), rng.choice([0.05, 0.5, 3.0])
        features[i] = [[ring((x - h, y), (x, y - h), (x + h, y), (x, y + h))]]
    features[500] = [[box(-20, -20, 20, 20)]]  # covers all
    features[501] = [[box(-1.5, -1.5, 1.5, 1.5)]]  # inside the hole of one
    features[502] = [[box(9, 9, 9.5, 9.5)]]  # touches a corner
    shapes = some_zones()
    pairs = joins.spatial_join_polygons(
        zones(spark, features, "feature_id"), zones(spark, shapes), ["feature_id"], broadcast_bytes=limit
    )
    got = sorted((r["feature_id"], r["zone_id"]) for r in pairs.collect())
    expected = sorted((f, z) for f, a in features.items() for z, b in shapes.items() if intersects(a, b))
    assert got == expected and len(got) > 200


@pytest.mark.parametrize("limit", [0, joins.BROADCAST_BYTES])
def test_pairs_of_zones_with_null_or_equal_attributes(spark, limit):
    same = zones(spark, {1: [[box(0, 0, 2, 2)]], 2: [[box(1, 1, 3, 3)]]})
    named = same.select(F.lit(None).cast("string").alias("name"), F.lit(7).alias("zone_id"), "geometry")
    features = zones(spark, {5: [[box(1.2, 1.2, 1.5, 1.5)]]}, "feature_id")
    pairs = joins.candidate_pairs(features, named, ["feature_id"], broadcast_bytes=limit)
    assert [(r["feature_id"], r["zone_id"], r["name"]) for r in pairs.collect()] == [(5, 7, None)] * 2


def test_point_join_plan_has_no_nested_loop(spark):
    points = spark.createDataFrame([(1, 0.5, 0.5)], "point_id int, lon double, lat double")
    hits = joins.spatial_join_points(points, zones(spark, some_zones()), ["zone_id"], ["point_id"])
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_work_list_and_pending(spark):
    shapes = zones(spark, {1: None, 2: None, 3: None})
    work = joins.work_list(shapes, ["2018", "2019"], spark.createDataFrame([(2,)], "zone_id bigint"))
    assert sorted(map(tuple, work.select("year", "zone_id").collect())) == [("2018", 1), ("2018", 3), ("2019", 1), ("2019", 3)]
    done = spark.createDataFrame([("2018", 1)], "year string, zone_id bigint")
    assert joins.pending(work, done, ["year", "zone_id"]).count() == 3
    assert joins.pending(work, done, ["year", "zone_id"], overwrite=True).count() == 4


def test_attach_values_keeps_zones_without_value(spark):
    names = spark.createDataFrame([(1, "a"), (2, "b")], "zone_id bigint, zone_name string")
    values = spark.createDataFrame([(1, 2019, 5.0), (1, 2020, 1234.567)], "zone_id bigint, year int, value double")
    rows = joins.attach_values(names, values).collect()
    assert [(r["zone_id"], r["value_label"]) for r in rows] == [(1, "1,234.57 km²"), (2, None)]


@pytest.mark.parametrize("limit", SIZES)
def test_points_among_many_overlapping_zones_stream_past_the_edges(spark, limit):
    rng = random.Random(3)
    shapes = {i: [[box(0.1 * i - 2, 0.2, 0.1 * i, 1.9)]] for i in range(40)}
    shapes[40] = [[box(-5, -5, 9, 9), box(1, 1, 2, 2)]]
    points = [(i % 90, rng.uniform(-3, 5), rng.uniform(-1, 3)) for i in range(200)] + [(None, 1.0, 1.0)] * 2
    frame = spark.createDataFrame(points, "point_id int, lon double, lat double")
    hits = joins.spatial_join_points(frame, zones(spark, shapes), ["zone_id"], ["point_id"], broadcast_bytes=limit)
    assert "MapInArrow" in hits._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(str, (tuple(r) for r in hits.select("point_id", "zone_id").collect())))
    assert got == sorted(str((i, z)) for i, x, y in points for z, s in shapes.items() if covers(s, x, y))


def test_features_of_a_wide_zone_are_spread(spark):
    shapes = zones(spark, {1: [[box(-50, -50, 50, 50)]], 2: [[box(0, 0, 1, 1)]]})
    features = spark.range(3000).select(
        F.col("id").alias("feature_id"), (F.col("id") % 97 - 48.5).alias("x"), (F.col("id") % 89 - 44.5).alias("y")
    ).selectExpr("feature_id", f"{joins.g.rectangle('x', 'y', 'x + 0.1', 'y + 0.1')} AS geometry")
    pairs = joins.spatial_join_polygons(features, shapes, ["feature_id"])
    assert "MapInArrow" in pairs._jdf.queryExecution().executedPlan().toString()
    tasks = pairs.filter("zone_id = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert pairs.filter("zone_id = 1").count() == 3000 and tasks > 1
