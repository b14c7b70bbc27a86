"""Spans of zones against a test of every cell centre."""

from __future__ import annotations

import io
import random
from contextlib import redirect_stdout
from pathlib import Path

import pytest

import shapes
from zonewright.operators import spans

RES, ORIGIN, SIZE = 2.0, (-9.0, 3.0), 5


def figures():
    rng = random.Random(11)

    def star(n, scale):
        import math

        cx, cy = rng.uniform(-5, 30), rng.uniform(8, 40)
        corners = []
        for k in range(n):
            r, a = rng.uniform(0.3, 1) * scale, 2 * math.pi * k / n
            corners.append((cx + r * math.cos(a), cy + r * math.sin(a)))
        return [[shapes.ring(*corners)]]

    out = {k: star(rng.choice([3, 7, 40]), rng.choice([2, 9, 30])) for k in range(12)}
    # corners and sides on cell centres, a hole, two parts, a sliver between two rows, a flat part
    out[20] = [[shapes.box(-8, 4, 14, 26), shapes.box(0, 10, 6, 16)]]
    out[21] = [[shapes.box(0, 4, 1, 5)], [shapes.ring((2, 6), (10, 14), (10, 6))]]
    out[22] = [[shapes.box(-8, 4.2, 40, 5.8)]]
    out[23] = [[shapes.ring((0, 8), (6, 14), (12, 8), (6, 2))]]
    out[24] = [[shapes.box(-9, 3, 91, 103)]]
    return out


def centre(i, k):
    return ORIGIN[k] + (i + 0.5) * RES


@pytest.fixture(scope="module")
def raster(spark):
    rng = random.Random(5)
    rows, cells = [], {}
    for year in (1, 2):
        for cx in range(-1, 6):
            for cy in range(-1, 6):
                if rng.random() < 0.1:
                    continue
                values = [rng.choice([None, 1.0, 2.0, 3.0, float("nan")]) for _ in range(SIZE * SIZE)]
                rows.append((year, cx, cy, values))
                for p, v in enumerate(values):
                    if v is not None:
                        cells[year, cx * SIZE + p % SIZE, cy * SIZE + p // SIZE] = v
    frame = spark.createDataFrame(rows, "yr int, chunk_x bigint, chunk_y bigint, values array<double>")
    return frame.repartition(3), cells


def inside(geometry, ix, iy):
    return shapes.covers(geometry, centre(ix, 0), centre(iy, 1))


@pytest.mark.parametrize("limit", [0, 1 << 26])
@pytest.mark.parametrize("values", [None, [1.0, 3.0]])
def test_sums_equal_a_test_of_every_cell(spark, raster, limit, values):
    chunks, cells = raster
    zones = figures()
    got = spans.zonal_sums(
        chunks, shapes.zones(spark, zones), ["zone_id"], ["yr"], SIZE, RES, ORIGIN, values, limit
    ).collect()
    want = {}
    for zone, geometry in zones.items():
        for (year, ix, iy), v in cells.items():
            if v == v and (values is None or v in values) and inside(geometry, ix, iy):
                n, total = want.get((zone, year), (0, 0.0))
                want[zone, year] = (n + 1, total + v)
    assert {(r.zone_id, r.yr): (r.n, r.total) for r in got} == want


def test_mask_gives_each_cell_of_a_zone_once(spark, raster):
    chunks, cells = raster
    zones = figures()
    # pieces of one zone that overlap, with whole and crossed chunks in common
    owner = {k: k % 3 for k in zones}
    pieces = spark.createDataFrame(
        [(owner[k], k, v) for k, v in zones.items()],
        f"zone_id int, tile bigint, geometry {shapes.GEOMETRY}",
    )
    got = spans.mask_chunks(chunks, pieces, ["zone_id"], ["yr"], SIZE, RES, ORIGIN).collect()
    want = {
        (owner[k], *cell): cells[cell]
        for cell in cells
        for k, geometry in zones.items()
        if inside(geometry, *cell[1:])
    }
    found = {(r.zone_id, r.yr, r.ix, r.iy): r.value for r in got}
    assert len(found) == len(got) and found.keys() == want.keys()
    assert all(found[c] == want[c] or want[c] != want[c] for c in want)


def plan(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_only_met_chunks_are_read_and_no_cell_is_tested(spark, raster, folder):
    chunks, _ = raster
    chunks.write.partitionBy("chunk_x").parquet(folder + "/chunks")
    stored = spark.read.schema(chunks.schema).parquet(folder + "/chunks")
    zone = shapes.zones(spark, {1: [[shapes.box(0, 4, 5, 9)]]})
    sums = spans.zonal_sums(stored, zone, ["zone_id"], ["yr"], SIZE, RES, ORIGIN)
    text = plan(sums)
    scans = [x for x in text.splitlines() if "FileScan parquet" in x and "values" in x]
    assert len(scans) == 1 and "dynamicpruning" in text
    assert "explode" not in text.lower() and "edge" not in text and "BroadcastHashJoin" in text
    masked = spans.mask_chunks(stored, zone, ["zone_id"], ["yr"], SIZE, RES, ORIGIN)
    # the chunk join stands below the explode of the mask, whose rows come from met chunks only
    lines = plan(masked).splitlines()
    explode = max(i for i, x in enumerate(lines) if "posexplode" in x)
    join = next(i for i, x in enumerate(lines) if "BroadcastHashJoin" in x)
    scan = next(i for i, x in enumerate(lines) if "FileScan parquet" in x)
    assert explode < join < scan
    # only the met chunks' files are read: all others hold no Parquet any more
    want = (str(sums.collect()), str(sorted(masked.collect())))
    assert "Row" in want[0] and "Row" in want[1]
    for path in Path(folder).glob("chunks/chunk_x=*/*.parquet"):
        if path.parent.name not in ("chunk_x=0", "chunk_x=1"):
            path.write_bytes(b"nothing")
    assert (str(sums.collect()), str(sorted(masked.collect()))) == want


def test_empty_inputs(spark, raster):
    chunks, _ = raster
    none = shapes.zones(spark, figures()).filter("false")
    assert spans.zonal_sums(chunks, none, ["zone_id"], ["yr"], SIZE, RES, ORIGIN).collect() == []
    zones = shapes.zones(spark, figures())
    empty = chunks.filter("false")
    assert spans.zonal_sums(empty, zones, ["zone_id"], ["yr"], SIZE, RES, ORIGIN).collect() == []
    means = spans.zonal_mean_spans(empty, zones, ["yr"], SIZE, RES, ORIGIN).collect()
    assert len(means) == len(figures()) and all(r.mean_value is None for r in means)
