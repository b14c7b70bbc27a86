"""Quadtree tiles against a test of every tile."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import shapes
from zonewright.operators import quadtree
from zonewright.sources import sinks

ZMAX = 6


def figures():
    rng = random.Random(9)
    out = {k: [[shapes.box(x, y, x + rng.choice([0.5, 7, 90]), y + rng.choice([0.4, 9, 60]))]] for k, (x, y) in enumerate((rng.uniform(-170, 80), rng.uniform(-70, 5)) for _ in range(9))}
    out[20] = [[shapes.box(-100, -50, 60, 70), shapes.box(-60, -30, 20, 50)]]
    out[21] = [[shapes.ring((0, 0), (80, 10), (10, 60))], [shapes.box(-20, -20, -19, -19)]]
    return out


@pytest.fixture(scope="module")
def tiles(spark):
    frame = shapes.zones(spark, figures())
    return quadtree.quadtree(frame, ["zone_id"], ZMAX).cache()


def test_crossed_and_whole_tiles_cover_what_every_tile_shows(spark, tiles):
    """The older table lists a feature in all tiles of its bounds; for boxes without holes both agree."""
    rows = tiles.collect()
    shown = {}
    for r in rows:
        below = [(r.z, r.tile_x, r.tile_y)]
        while below:
            z, x, y = below.pop()
            shown.setdefault(r.zone_id, set()).add((z, x, y))
            if r.whole and z < ZMAX:
                below += [(z + 1, 2 * x + i, 2 * y + j) for i in (0, 1) for j in (0, 1)]
    boxes = shapes.zones(spark, figures()).filter("zone_id < 20").withColumn("area", F.lit(1.0))
    want = {}
    for r in sinks.tile_pyramid(boxes, "zone_id", ZMAX).collect():
        want.setdefault(r.zone_id, set()).add((r.z, r.tile_x, r.tile_y))
    assert {k: v for k, v in shown.items() if k < 20} == want
    # the hole shows nothing of its inside, and rows follow the outline
    hole = (6, int((-20 + 180) / 360 * 64), 31)
    assert hole not in shown[20]
    counts = Counter((r.zone_id, r.z) for r in rows if r.zone_id == 20)
    assert counts[20, 6] < 3 * counts[20, 5] and counts[20, 6] < len([t for t in shown[20] if t[0] == 6]) / 2


def test_whole_tiles_have_a_crossed_parent(tiles):
    rows = tiles.collect()
    crossed = {(r.zone_id, r.z, r.tile_x, r.tile_y) for r in rows if not r.whole}
    for r in rows:
        if r.z:
            assert (r.zone_id, r.z - 1, r.tile_x // 2, r.tile_y // 2) in crossed


@pytest.mark.parametrize("keep", [1, 4])
def test_thinned_lists_are_the_best_of_each_tile(tiles, keep):
    ranked = tiles.withColumn("rank", (F.col("zone_id") * 7 % 5).cast("double"))
    got = {}
    for r in quadtree.thin_tiles(ranked, "zone_id", "rank", keep, ZMAX).collect():
        got.setdefault((r.z, r.tile_x, r.tile_y), set()).add(r.zone_id)
    lists = {}
    for r in tiles.collect():
        lists.setdefault((r.z, r.tile_x, r.tile_y), []).append((-(r.zone_id * 7 % 5), r.zone_id))
    assert got == {t: {k for _, k in sorted(v)[:keep]} for t, v in lists.items()}


def test_empty_table(spark):
    none = shapes.zones(spark, figures()).filter("false")
    assert quadtree.quadtree(none, ["zone_id"], 2).collect() == []
