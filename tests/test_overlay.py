"""Edge tables against plain Python: which polygons meet, and the area they share."""

from __future__ import annotations

import math
import random

import pytest

from pyspark.sql import functions as F

import shapes
from zonewright.operators import joins, overlay


def star(rng, n, scale, hole=False, turn=1):
    cx, cy = rng.uniform(-6, 6), rng.uniform(-6, 6)
    angles = [turn * 2 * math.pi * k / n for k in range(n)]
    corners = [(rng.uniform(0.4, 1) * scale, a) for a in angles]
    outer = shapes.ring(*((cx + r * math.cos(a), cy + r * math.sin(a)) for r, a in corners))
    if not hole:
        return [outer]
    inner = shapes.ring(*((cx + 0.35 * scale * math.cos(a), cy + 0.35 * scale * math.sin(a)) for a in angles))
    return [outer, inner]


def sides():
    rng = random.Random(17)
    features = {k: [star(rng, rng.choice([3, 5, 9]), rng.choice([0.3, 1.5, 4]), turn=rng.choice([1, -1]))] for k in range(25)}
    features[50] = [[shapes.box(0, 0, 1, 1)], [shapes.box(3, 3, 4, 4)]]
    features[51] = [[shapes.box(1, 1, 2, 2)]]
    zones = {
        k: [star(rng, rng.choice([4, 30, 200]), rng.choice([1, 5]), hole=k % 2 == 0, turn=rng.choice([1, -1]))]
        for k in range(12)
    }
    # a shared side, a shared corner, a feature in the hole, one that fills a zone, two parts
    zones[30] = [[shapes.box(1, 0, 2, 1)]]
    zones[31] = [[shapes.box(-3, -3, 5, 5), shapes.box(-1, -1, 2.5, 2.5)]]
    zones[32] = [[shapes.box(0, 0, 1, 1)], [shapes.box(5, 5, 6, 6)]]
    zones[33] = [[shapes.box(-50, -50, 50, 50)]]
    return features, zones


@pytest.mark.parametrize("limit,cell", [(0, 1.0), (1 << 26, 2.5)])
def test_pairs_equal_brute_force_and_the_other_form(spark, limit, cell):
    features, zones = sides()
    left, right = shapes.zones(spark, features, "feature_id"), shapes.zones(spark, zones)
    got = overlay.meeting_pairs(left, right, cell=cell, broadcast_bytes=limit).collect()
    pairs = [(r.feature_id, r.zone_id) for r in got]
    want = {(f, z) for f in features for z in zones if shapes.intersects(features[f], zones[z])}
    assert len(pairs) == len(set(pairs)) and want <= set(pairs)
    # the plain test looks at the first part only; parts of features[50] may lie inside alone
    assert {p for p in pairs if p[0] != 50} == {p for p in want if p[0] != 50}
    other = joins.spatial_join_polygons(left, right, ["feature_id"]).collect()
    assert set(pairs) == {(r.feature_id, r.zone_id) for r in other}


def clipped_area(rings, convex):
    """Area of a polygon with holes inside a convex ring, by cutting along each side."""

    def area(points):
        return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1])) / 2

    sides = [(p["x"], p["y"]) for p in convex[:-1]]
    if area(sides) < 0:
        sides.reverse()
    total = 0.0
    for i, ring in enumerate(rings):
        points = [(p["x"], p["y"]) for p in ring[:-1]]
        for (ax, ay), (bx, by) in zip(sides, sides[1:] + sides[:1]):
            out = []
            for p, q in zip(points, points[1:] + points[:1]):
                d, e = ((bx - ax) * (y - ay) - (by - ay) * (x - ax) for x, y in (p, q))
                if d >= 0:
                    out.append(p)
                if (d < 0) != (e < 0):
                    t = d / (d - e)
                    out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
            points = out
        total += (1 if i == 0 else -1) * abs(area(points)) if points else 0
    return total


@pytest.mark.parametrize("limit,cell,band", [(0, 1.0, 0.3), (1 << 26, 3.0, None)])
def test_shared_area_equals_clipping(spark, limit, cell, band):
    rng = random.Random(4)
    _, zones = sides()
    convex = {}
    for k in range(20):
        cx, cy, r, n = rng.uniform(-6, 6), rng.uniform(-6, 6), rng.uniform(0.2, 4), rng.choice([3, 4, 7])
        turn = rng.choice([1, -1])
        spun = [(cx + r * math.cos(turn * 2 * math.pi * i / n), cy + r * math.sin(turn * 2 * math.pi * i / n)) for i in range(n)]
        convex[k] = [[shapes.ring(*spun)]]
    got = overlay.overlap_areas(
        shapes.zones(spark, convex, "feature_id"), shapes.zones(spark, zones), cell=cell, band=band, broadcast_bytes=limit
    ).collect()
    found = {(r.feature_id, r.zone_id): r.overlap for r in got}
    assert len(found) == len(got)
    for f, shape in convex.items():
        for z, polygons in zones.items():
            want = sum(clipped_area(rings, shape[0][0]) for rings in polygons)
            assert found.get((f, z), 0.0) == pytest.approx(want, abs=1e-9)


def test_two_concave_outlines(spark):
    comb = [(0, 0), (9, 0), (9, 5), (8, 5), (8, 1), (5, 1), (5, 5), (4, 5), (4, 1), (1, 1), (1, 5), (0, 5)]
    lying = [(-1, 2), (10, 2), (10, 3), (0.5, 3), (0.5, 3.5), (10, 3.5), (10, 4), (-1, 4)]
    left = shapes.zones(spark, {1: [[shapes.ring(*comb)]]}, "feature_id")
    right = shapes.zones(spark, {2: [[shapes.ring(*lying)]]})
    # three teeth, each cut by two bars; the bars are joined at the left half of the first tooth
    (row,) = overlay.overlap_areas(left, right, cell=2.0).collect()
    assert row.overlap == pytest.approx(3 * 1 + 3 * 0.5 + 0.5 * 0.5)


def test_callers_columns_pass(spark):
    box = [[shapes.box(0, 0, 1, 1)]]
    left = shapes.zones(spark, {1: box}, "feature_id").selectExpr("*", "1 AS cx", "2 AS cy", "3 AS edges", "4 AS sign")
    (row,) = overlay.meeting_pairs(left, shapes.zones(spark, {2: box})).collect()
    assert (row.cx, row.cy, row.edges, row.sign) == (1, 2, 3, 4)


def test_empty_sides(spark):
    box = shapes.zones(spark, {1: [[shapes.box(0, 0, 1, 1)]]})
    other = shapes.zones(spark, {1: [[shapes.box(0, 0, 1, 1)]]}, "feature_id")
    assert overlay.meeting_pairs(other, box.filter("false")).collect() == []
    assert overlay.meeting_pairs(other.filter("false"), box).collect() == []
    assert overlay.overlap_areas(other, box.filter("false")).collect() == []


def test_long_outlines_meet_as_short_ones_and_pairs_are_no_edge_tables(spark):
    rng = random.Random(11)
    features = {}
    for i in range(150):
        x, y, h = rng.uniform(-10, 10), rng.uniform(-10, 10), rng.choice([0.05, 0.5, 3.0])
        features[i] = [[shapes.ring((x - h, y), (x, y - h), (x + h, y), (x, y + h))]]
    steps = [k / 100 for k in range(1200)]
    corners = [(-6, -6), (6, -6), (6, 6), (-6, 6), (-6, -6)]
    drawn = [
        (a[0] + (b[0] - a[0]) * t / 12, a[1] + (b[1] - a[1]) * t / 12)
        for a, b in zip(corners, corners[1:]) for t in steps
    ]
    left = shapes.zones(spark, features, "feature_id")
    hole = shapes.box(-2, -2, 2, 2)
    got = {}
    for name, ring in (("long", shapes.ring(*drawn)), ("short", shapes.box(-6, -6, 6, 6))):
        pairs = overlay.meeting_pairs(left, shapes.zones(spark, {1: [[ring, hole]]}))
        assert "MapInArrow" in pairs._jdf.queryExecution().executedPlan().toString()
        got[name] = sorted(r.feature_id for r in pairs.collect())
    assert got["long"] == got["short"] and 20 < len(got["long"]) < 150


def test_pairs_of_one_input_task_are_summed_by_many(spark, monkeypatch):
    kept = {}
    written = overlay.written

    def noted(df, name):
        kept[name] = written(df, name)
        return kept[name]

    monkeypatch.setattr(overlay, "written", noted)
    features = shapes.zones(spark, {k: [[shapes.box(k, 0, k + 2, 2)]] for k in range(40)}, "feature_id").coalesce(1)
    areas = overlay.overlap_areas(features, shapes.zones(spark, {1: [[shapes.box(0, 0, 30, 1)]]}), cell=5.0)
    assert areas.filter("overlap > 0").count() == 30
    files = kept["box-pairs"].select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1
