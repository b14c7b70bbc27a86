from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonewright.operators import raster


def pixels(spark, rows):
    return spark.createDataFrame(rows, "ix long, iy long, t int, value double, seq int")


def test_chunks_round_trip(spark):
    rows = [(ix, iy, 1, float(ix * 10 + iy), 0) for ix in range(-3, 4) for iy in range(-2, 5) if (ix + iy) % 3]
    chunks = raster.pixels_to_chunks(pixels(spark, rows), 4, 10.0, ["t"])
    assert all(len(r["values"]) == 16 for r in chunks.collect())
    back = raster.chunks_to_pixels(chunks, ["t"]).filter("value is not null")
    got = sorted((r["ix"], r["iy"], r["value"], r["x"], r["y"]) for r in back.collect())
    assert got == sorted((ix, iy, v, (ix + 0.5) * 10, (iy + 0.5) * 10) for ix, iy, _, v, _ in rows)


def test_mosaic_takes_the_first_valid_value(spark):
    rows = [(0, 0, 1, None, 1), (0, 0, 1, 5.0, 2), (0, 0, 1, 7.0, 3), (1, 0, 1, None, 1)]
    got = raster.mosaic(pixels(spark, rows), ["ix", "iy", "t"], "seq")
    assert {(r["ix"], r["value"]) for r in got.collect()} == {(0, 5.0), (1, None)}


@pytest.mark.parametrize(("source", "target"), [(50.0, 30.0), (50.0, 70.0), (50.0, 50.0)])
def test_regrid_is_nearest_neighbour(spark, source, target):
    n = 21
    rows = [(ix, iy, 1, float(ix * 100 + iy), 0) for ix in range(n) for iy in range(n)]
    got = {(r["ix"], r["iy"]): r["value"] for r in raster.regrid(pixels(spark, rows), source, target).collect()}
    expected = {}
    for tx in range(int(n * source / target) + 2):
        for ty in range(int(n * source / target) + 2):
            sx, sy = int((tx + 0.5) * target // source), int((ty + 0.5) * target // source)
            if sx < n and sy < n:
                expected[tx, ty] = float(sx * 100 + sy)
    assert got == expected


def test_index_bounds_agree_with_sorted_search(spark):
    res, left, bottom, n_lon, n_lat = 0.5, -180.0, -32.0, 720, 128
    lon = left + np.arange(n_lon) * res
    lat = (bottom + np.arange(n_lat) * res)[::-1]
    cases = [(10.0, 12.0, 5.0, 1.5), (10.2, 11.9, 5.3, 1.1), (-200.0, -170.0, 40.0, 20.0), (170.0, 200.0, -20.0, -40.0)]
    df = spark.createDataFrame(cases, "lon_first double, lon_last double, lat_first double, lat_last double")
    for r in raster.index_bounds(df, left, bottom, res, n_lon, n_lat).collect():
        ascending = lat[::-1]
        assert r["lat_start"] == n_lat - np.searchsorted(ascending, r["lat_first"], side="right")
        assert r["lat_end"] == n_lat - np.searchsorted(ascending, r["lat_last"], side="left") + 1
        assert r["lon_start"] == np.searchsorted(lon, r["lon_first"], side="left")
        assert r["lon_end"] == np.searchsorted(lon, r["lon_last"], side="right") + 1


def test_runs_and_block_borders(spark):
    rows = [(ix, 0, 1, 1.0, 0) for ix in (0, 1, 2, 4, 5, 9)] + [(3, 0, 1, 2.0, 0), (1, 1, 1, 1.0, 0)]
    whole = raster.polygonize_runs(pixels(spark, rows), 1.0, 10.0, ["t"])
    found = sorted((r["iy"], r["ix_first"], r["ix_last"], r["minx"], r["maxx"]) for r in whole.collect())
    assert found == [(0, 0, 2, 0, 30), (0, 4, 5, 40, 60), (0, 9, 9, 90, 100), (1, 1, 1, 10, 20)]
    cut = raster.polygonize_runs(pixels(spark, rows), 1.0, 10.0, ["t"], block=2)
    assert sorted((r["iy"], r["ix_first"], r["ix_last"], r["minx"], r["maxx"]) for r in cut.collect()) == found


def test_a_long_run_is_one_rectangle(spark):
    long = spark.range(140_000).selectExpr("id AS ix", "0L AS iy", "1 AS t", "1.0D AS value")
    row = raster.polygonize_runs(long, 1.0, 10.0, ["t"]).collect()
    assert [(r["ix_first"], r["ix_last"]) for r in row] == [(0, 139_999)]


def test_width_guard(spark):
    scenes = spark.createDataFrame([(0.0, 100.0), (900.0, 1000.0)], "minx double, maxx double")
    assert raster.width_guard(scenes, 10.0, 1000).first()["width"] == 100
    with pytest.raises(Exception, match="spans the world"):
        raster.width_guard(scenes, 10.0, 100).collect()


def test_filter_values_and_crop(spark):
    rows = [(ix, 0, 1, v, 0) for ix, v in enumerate([1.0, 2.0, None, 3.0])]
    df = pixels(spark, rows)
    assert [r["value"] for r in raster.filter_values(df, [1.0, 3.0]).orderBy("ix").collect()] == [1, None, None, 3]
    assert raster.filter_values(df, None).count() == 4
    placed = df.withColumns({"x": F.col("ix") + 0.5, "y": F.lit(0.5)})
    cropped = raster.crop_to_bounds(placed, 1.5, 0, 2.5, 1).orderBy("ix").collect()
    assert [r["value"] for r in cropped] == [2, 0]
