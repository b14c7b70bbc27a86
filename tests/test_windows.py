"""Squares and windows: every pair as by the plain test, rows that move once, keys that count once."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

import shapes
from zonewright.functions import geometry as g
from test_overlay import clipped_area
from zonewright.operators import indicators, joins, kernels, overlay, windows
from zonewright.operators.geometry import with_area_m2


def lattice(rng, n, size):
    """Features and zones with corners on half degrees, so that many touch; holes and two parts among them."""
    features, zones = {}, {}
    for k in range(n):
        x, y, h = rng.randrange(-24, 24) / 2, rng.randrange(-24, 24) / 2, rng.choice(size)
        if k % 3:
            features[k] = [[shapes.ring((x - h, y), (x, y - h), (x + h, y), (x, y + h))]]
        else:
            features[k] = [[shapes.box(x, y, x + h, y + h)], [shapes.box(x + 2 * h, y, x + 3 * h, y + h)]]
    for k in range(40):
        x, y, s = rng.randrange(-24, 24) / 2, rng.randrange(-24, 24) / 2, rng.choice([0.5, 1.0, 4.0])
        angles = [2 * math.pi * a / 40 for a in range(40)]
        star = shapes.ring(*((x + s * (3 + rng.random()) * math.cos(a), y + s * (3 + rng.random()) * math.sin(a)) for a in angles))
        lying = shapes.ring((x, y), (x + 3 * s, y), (x + 3 * s, y + s), (x + s, y + s), (x + s, y + 3 * s), (x, y + 3 * s))
        zones[k] = [
            [[star, shapes.box(x - s, y - s, x + s, y + s)]], [[lying]], [[lying], [shapes.box(x + 4 * s, y, x + 5 * s, y + s)]],
            [[shapes.box(x, y, x + 6 * s, y + 6 * s), shapes.box(x + s, y + s, x + 5 * s, y + 5 * s)]],
        ][k % 4]
    zones[90] = [[shapes.box(-60, -60, 60, 60)]]
    zones[91] = [[shapes.box(-60, -60, 60, 60), shapes.box(-7, -7, 7, 7)], [shapes.box(-1, -1, 1, 1)]]
    return features, zones


@pytest.mark.parametrize("cell,size,held", [(1.0, [0.25, 0.5], 1000), (0.5, [0.01, 1.0, 9.0], 1 << 26), (3.0, [0.0, 0.5], 1 << 26)])
def test_pairs_equal_the_plain_test(spark, monkeypatch, cell, size, held):
    monkeypatch.setattr(windows, "HELD", held)
    features, zones = lattice(random.Random(int(cell * 10)), 400, size)
    left, right = shapes.zones(spark, features, "feature_id"), shapes.zones(spark, zones)
    got = joins.spatial_join_polygons(left, right, ["feature_id"], cell=cell).collect()
    both = left.withColumn("e", F.expr(g.edges("geometry"))).crossJoin(
        right.select("zone_id", F.col("geometry").alias("z"), F.expr(g.edges("geometry")).alias("o"))
    )
    want = both.filter(F.expr(g.intersects("geometry", "e", "z", "o"))).select("feature_id", "zone_id").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 1000


def test_features_move_once_however_many_zones_they_meet(spark, monkeypatch):
    moved = {}
    tested = kernels.tested

    def noted(rows, cut, *others, **named):
        moved["rows"], moved["zones"] = rows.count(), cut.count()
        return tested(rows, cut, *others, **named)

    monkeypatch.setattr(kernels, "tested", noted)
    features = shapes.zones(spark, {k: [[shapes.box(k / 100, 0, k / 100 + 1, 1)]] for k in range(200)}, "feature_id")
    zones = shapes.zones(spark, {k: [[shapes.box(-1, -1, 4 + k / 100, 3)]] for k in range(150)})
    assert joins.spatial_join_polygons(features, zones, ["feature_id"]).count() == 200 * 150
    assert moved["rows"] == 200 and moved["zones"] < 150 * 20


def test_edges_beyond_a_window_stay_behind(spark, monkeypatch):
    most = []
    tested = kernels.tested

    def noted(rows, cut, *others, **named):
        most.append(cut.select(F.max(F.size("__edges"))).first()[0])
        return tested(rows, cut, *others, **named)

    monkeypatch.setattr(kernels, "tested", noted)
    steps = [(k / 50, -20.0) for k in range(-1000, 1000)] + [(20.0, k / 50) for k in range(-1000, 1000)]
    corners = steps + [(-x, -y) for x, y in steps]
    zones = shapes.zones(spark, {1: [[shapes.ring(*corners)]]})
    features = shapes.zones(spark, {k: [[shapes.box(k, k, k + 0.5, k + 0.5)]] for k in range(-30, 30)}, "feature_id")
    found = joins.spatial_join_polygons(features, zones, ["feature_id"]).select("feature_id").collect()
    assert sorted(r[0] for r in found) == list(range(-20, 21)) and most[0] < 5 * 1000


def test_features_without_whole_finite_bounds_meet_nothing(spark):
    shape = [[shapes.box(0, 0, 1, 1)]]
    odd = {1: None, 2: [], 3: [None], 4: [[]], 5: [[[{"x": math.nan, "y": 0.0}, *shape[0][0]]]], 6: shape, 7: [[None, shape[0][0]]]}
    odd[8] = [[shapes.box(0, 0, math.inf, 1)]]
    odd[9] = [[shapes.box(0, 0, 1e12, 1)]]
    left, right = shapes.zones(spark, odd, "feature_id"), shapes.zones(spark, odd)
    pairs = joins.spatial_join_polygons(left, right, ["feature_id"]).collect()
    assert [tuple(r) for r in pairs] == [(6, 6)]


@pytest.mark.parametrize("held", [windows.HELD, 2000])
def test_a_key_meets_a_zone_once_wherever_its_rows_and_pieces_lie(spark, monkeypatch, held):
    monkeypatch.setattr(windows, "HELD", held)
    rng = random.Random(8)
    features, zones = lattice(rng, 300, [0.25, 2.0])
    left = shapes.zones(spark, features, "n").selectExpr(
        "if(n % 7 = 0, null, n % 90) AS feature_id", "if(n % 3 = 0, null, n % 2) AS asset", "geometry"
    )
    right = shapes.zones(spark, zones).selectExpr(
        "if(zone_id % 5 = 0, null, zone_id % 9) AS zone_id", "if(zone_id % 4 = 0, double('nan'), 1) AS kind", "zone_id AS part", "geometry"
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        once = (["feature_id", "asset"], ["zone_id", "kind"])
        got = joins.spatial_join_polygons(left, right, ["feature_id"], once=once)
        columns = [*once[0], *once[1]]
        found = sorted(map(str, got.select(*columns).collect()))
        pairs = joins.spatial_join_polygons(left, right, ["feature_id"]).select(*columns)
        assert found == sorted(map(str, pairs.distinct().collect())) and pairs.count() > 2 * len(found)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_areas_once_per_zone_shuffle_no_pairs(spark):
    features = shapes.zones(spark, {k: [[shapes.box(k / 99, 0, k / 99 + 1, 1)]] for k in range(200)}, "feature_id")
    pieces = shapes.zones(spark, {k: [[shapes.box(-1, -1, 4 + k / 100, 3)]] for k in range(60)}, "k").selectExpr(
        "k % 20 AS zone_id", "k AS part", "0 AS tile", "geometry"
    )
    sums = indicators.sum_area_vector(features, pieces, ["feature_id"], dedupe=True)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    # between the test and the sums, only what each task has added up already
    after = plan[: plan.index("MapInArrow")]
    assert after.count("Exchange") == 1 and "feature_id" not in after[after.index("Exchange") : after.rindex("HashAggregate")]
    whole = {r["feature_id"]: r["a"] for r in with_area_m2(features, name="a").collect()}
    rows = sums.collect()
    assert len(rows) == 20 and all(r["area_m2"] == pytest.approx(sum(whole.values()), abs=0.01) for r in rows)


def test_shared_areas_of_many_features_equal_clipping_and_move_none_twice(spark, monkeypatch):
    moved = {}
    tested = kernels.tested

    def noted(rows, cut, *others, **named):
        moved["rows"], moved["zones"] = rows.count(), cut.count()
        return tested(rows, cut, *others, **named)

    monkeypatch.setattr(kernels, "tested", noted)
    features, zones = lattice(random.Random(6), 300, [0.25, 0.7, 5.0])
    convex = {k: [shape[0]] for k, shape in features.items()}
    got = overlay.overlap_areas(shapes.zones(spark, convex, "feature_id"), shapes.zones(spark, zones)).collect()
    found = {(r.feature_id, r.zone_id): r.overlap for r in got}
    assert len(found) == len(got) > 2000 and moved["rows"] == 300 and moved["zones"] < 60 * 200
    for z, polygons in zones.items():
        for f, shape in convex.items():
            want = sum(clipped_area(rings, shape[0][0]) for rings in polygons)
            assert found.get((f, z), 0.0) == pytest.approx(want, abs=1e-9)


def test_shared_areas_keep_columns_named_alike(spark):
    left = shapes.zones(spark, {1: [[shapes.box(0, 0, 2, 2)]]}, "zone_id")
    areas = overlay.overlap_areas(left, shapes.zones(spark, {7: [[shapes.box(1, 1, 3, 3)]]}))
    assert areas.columns == ["overlap", "zone_id", "zone_id"] and tuple(areas.first()) == (1.0, 1, 7)
