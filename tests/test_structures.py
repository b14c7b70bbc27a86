"""Patches, merged chunks and laid-out points against plain Python."""

from __future__ import annotations

import io
import random
from contextlib import redirect_stdout
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import shapes
from zonewright.operators import chunk_mosaic, joins, patches, raster
from zonewright.sources import layout


def flood(cells):
    """Patches of (year, x, y) cells that touch along a side."""
    left, out = set(cells), []
    while left:
        waiting, patch = [left.pop()], set()
        while waiting:
            t, x, y = waiting.pop()
            patch.add((t, x, y))
            for n in ((t, x + 1, y), (t, x - 1, y), (t, x, y + 1), (t, x, y - 1)):
                if n in left:
                    left.remove(n)
                    waiting.append(n)
        first = min((y, x) for _, x, y in patch)
        xs, ys = [c[1] for c in patch], [c[2] for c in patch]
        t = next(iter(patch))[0]
        out.append((t, first[1], first[0], len(patch), len(patch) * 4.0, min(xs), max(xs), min(ys), max(ys)))
    return sorted(out)


def drawings():
    rng = random.Random(2)
    cells = {(1, rng.randrange(30), rng.randrange(30)) for _ in range(520)}
    # a long snake, a comb whose teeth meet only at the end, a ring around a cell, negative places
    snake = [(2, x, 2 * y) for y in range(15) for x in range(40)]
    snake += [(2, 39 if y % 2 == 0 else 0, 2 * y + 1) for y in range(14)]
    comb = [(3, x, y) for x in range(0, 30, 2) for y in range(-20, 5)] + [(3, x, 5) for x in range(29)]
    ring = [(4, x, y) for x in range(-3, 2) for y in range(-3, 2) if max(abs(x + 1), abs(y + 1)) == 2] + [(4, -1, -1)]
    return cells | set(snake) | set(comb) | set(ring)


@pytest.mark.parametrize("block", [7, 1 << 12])
def test_patches_equal_flood_fill(spark, block):
    cells = drawings()
    frame = spark.createDataFrame([(*c, 1.0) for c in cells], "yr int, ix bigint, iy bigint, value double")
    runs = raster.polygonize_runs(frame, 1.0, 2.0, ["yr"])
    got = patches.patches(runs, ["yr"], 2.0, block=block).collect()
    assert sorted(map(tuple, got)) == flood(cells)
    assert patches.patches(runs.filter("false"), ["yr"], 2.0).collect() == []


def test_connected_labels_are_the_smallest_node(spark):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 700)]
    links += [(900, k) for k in range(901, 1300)]
    parent = {}

    def root(n):
        while parent.setdefault(n, n) != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    nodes = {n for link in links if link[0] != link[1] for n in link}
    got = patches.connected(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    assert {r.node: r.label for r in got} == {n: root(n) for n in nodes} and len(got) == len(nodes)


def test_merged_chunks_equal_first_valid_cell(spark):
    rng = random.Random(3)
    rows = []
    for place in range(30):
        for scene in rng.sample(range(9), rng.choice([1, 1, 2, 6])):
            values = [rng.choice([None, None, float(scene), float("nan")]) for _ in range(16)]
            rows.append((place % 3, place, -place, scene, values))
    rows.append((None, 1, 1, 1, [None, 2.0]))
    rows.append((None, 1, 1, 0, [7.0, None]))
    rng.shuffle(rows)
    schema = "yr int, chunk_x bigint, chunk_y bigint, scene int, values array<double>"
    frame = spark.createDataFrame(rows, schema).repartition(4).withColumn("_n", F.lit(1))
    got = {tuple(r)[:3]: r["values"] for r in chunk_mosaic.mosaic_chunks(frame, ["yr"], ["scene"]).collect()}
    want = {}
    for yr, x, y, _, values in sorted(rows, key=lambda r: r[3]):
        held = want.setdefault((yr, x, y), [None] * len(values))
        want[yr, x, y] = [v if h is None else h for h, v in zip(held, values)]
    assert str(sorted(got.items(), key=str)) == str(sorted(want.items(), key=str))


def test_single_chunks_are_not_moved(spark):
    frame = spark.createDataFrame([(1, 0, 0, 1, [1.0])], "yr int, chunk_x bigint, chunk_y bigint, scene int, values array<double>")
    text = io.StringIO()
    with redirect_stdout(text):
        chunk_mosaic.mosaic_chunks(frame, ["yr"], ["scene"]).explain()
    assert text.getvalue().count("Exchange hashpartitioning") == 1 and "SortAggregate" not in text.getvalue()


def test_layout_opens_only_the_cells_of_the_zones(spark, folder):
    rng = random.Random(8)
    rows = [(n, rng.uniform(-60, 60), rng.uniform(-60, 60)) for n in range(3000)]
    rows += [(9001, None, 1.0), (9002, float("inf"), 0.0), (9003, float("nan"), 2.0)]
    points = spark.createDataFrame(rows, "point_id bigint, lon double, lat double")
    root = f"{folder}/points"
    layout.write_by_curve(points, root)
    assert spark.read.parquet(root).count() == len(rows)
    zones = shapes.zones(spark, {1: [[shapes.box(1, 1, 8, 9)]], 2: [[shapes.box(31, -9, 44, -3)]], 3: [[shapes.box(90, 0, 91, 1)]]})
    counts = layout.count_in_layout(spark, root, zones, ["point_id"])
    want = {1: 0, 2: 0, 3: 0}
    for _, x, y in rows[:3000]:
        want[1] += 1 <= x <= 8 and 1 <= y <= 9
        want[2] += 31 <= x <= 44 and -9 <= y <= -3
    assert {r.zone_id: r.n_points for r in counts.collect()} == want and want[1]
    text = io.StringIO()
    with redirect_stdout(text):
        counts.explain()
    assert "dynamicpruning" in text.getvalue()
    # the other folders' files hold nothing readable any more
    opened = {"0_0", "3_-1", "4_-1", "9_0"}
    spoiled = 0
    for path in Path(root).glob("cell=*/*.parquet"):
        if path.parent.name.split("=")[1] not in opened:
            path.write_bytes(b"nothing")
            spoiled += 1
    assert spoiled > 20
    schema = "point_id bigint, lon double, lat double, cell string"
    again = layout.count_in_layout(spark, root, zones, ["point_id"], schema=schema)
    assert {r.zone_id: r.n_points for r in again.collect()} == want


def test_curve_keeps_neighbours_together(spark):
    key = layout.curve_key("x", "y", 0.0, 65536.0)
    rows = [(x, y) for x in range(8) for y in range(8)]
    frame = spark.createDataFrame([(float(x), float(y)) for x, y in rows], "x double, y double")
    got = {(int(r.x), int(r.y)): r.k for r in frame.select("x", "y", F.expr(key).alias("k")).collect()}
    want = {(x, y): sum((x >> b & 1) << 2 * b | (y >> b & 1) << 2 * b + 1 for b in range(16)) for x, y in rows}
    assert got == want


def test_callers_columns_and_odd_coordinates_pass_the_point_join(spark):
    points = spark.createDataFrame(
        [(1, 0.5, 0.5), (2, float("inf"), 0.5), (3, float("nan"), 0.5), (4, None, 0.5), (5, 5.0, 5.0)],
        "point_id bigint, lon double, lat double",
    ).selectExpr("*", "7 AS cx", "8 AS cy", "9 AS edges", "10 AS _salt")
    zones = shapes.zones(spark, {1: [[shapes.box(0, 0, 1, 1)]]})
    for limit in (0, 1 << 20):
        (row,) = joins.spatial_join_points(points, zones, ["zone_id"], ["point_id"], broadcast_bytes=limit).collect()
        assert (row.point_id, row.cx, row.cy, row.edges, row._salt, row.zone_id) == (1, 7, 8, 9, 10, 1)
