from __future__ import annotations

import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shapes import box, zones
from zonewright.functions import geometry as g
from zonewright.sources import files, scenes, sinks, tables


def collection(*features):
    return {"type": "FeatureCollection", "features": list(features)}


def feature(kind, coordinates, **properties):
    return {"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": coordinates}}


SQUARE = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]


def test_geojson(spark, folder):
    path = f"{folder}/zones.geojson"
    with open(path, "w") as f:
        json.dump(collection(feature("Polygon", SQUARE, name="a", value=1), feature("MultiPolygon", [SQUARE, SQUARE], name="b"), feature("Point", [1, 2], name="c")), f, indent=2)
    read = tables.read_geojson(spark, path, "name string, value int")
    got = {r["name"]: (r["value"], r["geometry"] and len(r["geometry"])) for r in read.collect()}
    assert got == {"a": (1, 1), "b": (None, 2), "c": (None, None)}
    plain = tables.read_table(spark, path)
    assert plain.columns == ["properties", "geometry"] and plain.count() == 3
    assert plain.select(F.expr(g.area("geometry"))).first()[0] == 4


def test_read_table_by_suffix(spark, folder):
    spark.range(3).write.parquet(f"{folder}/t")
    assert tables.read_table(spark, f"{folder}/t/").count() == 3
    with pytest.raises(ValueError, match="no reader"):
        tables.read_table(spark, f"{folder}/t.shp")


def test_scene_items(spark, folder):
    def item(name, **assets):
        with open(f"{folder}/{name}.stac-item.json", "w") as f:
            json.dump({"id": name, "collection": "c", "bbox": [8, -1, 9, 0], "geometry": {"type": "Polygon", "coordinates": SQUARE}, "properties": {"datetime": "2020-07-02T00:00:00Z"}, "assets": assets}, f, indent=2)

    item("one", asset={"href": "s3://x"})
    item("two", a={"href": "s3://y"}, b={"href": "s3://z"})
    with open(f"{folder}/other.json", "w") as f:
        f.write("{}")
    items = scenes.read_scene_items(spark, folder)
    assert sorted(r["id"] for r in items.collect()) == ["one", "two"]
    index = scenes.index_scenes(items.filter("id = 'one'"), asset_name="mangrove").first()
    assert index["minx"] == 8 and index["assets"]["mangrove"]["href"] == "s3://x"
    with pytest.raises(Exception, match="scene two has 2"):
        scenes.rename_single_asset(items, "m").collect()
    wanted = spark.createDataFrame([("file:///nowhere",)], "url string")
    with pytest.raises(Exception, match="scene items not found: file:///nowhere"):
        scenes.index_scenes(items, wanted).collect()


def test_scene_dates(spark):
    df = spark.createDataFrame([("GMW_N00E008_1996_v3.tif",), ("GMW_S01E009_v4019_mng.tif",), ("other.tif",)], "scene_id string")
    got = {r["scene_id"]: str(r["mid_date"]) for r in scenes.scene_dates(df).collect()}
    assert got == {"GMW_N00E008_1996_v3.tif": "1996-07-02", "GMW_S01E009_v4019_mng.tif": "2020-07-02", "other.tif": "None"}


def test_file_listing(spark, folder):
    spark.range(4).withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(f"{folder}/t")
    found = files.list_files(spark, folder, r"k=1/.*\.parquet$", prefix="t/")
    assert found.count() >= 1 and all("k=1" in r["path"] for r in found.collect())
    with pytest.raises(ValueError, match="no data files"):
        files.indexed_files(found.filter("false"))


def test_file_decisions(spark):
    source = spark.createDataFrame([("new", 1), ("same", 2), ("changed", 3)], "path string, size long")
    target = spark.createDataFrame([("same", 2), ("changed", 9)], "path string, size long")

    def actions(overwrite, policy):
        return {r["path"]: r["action"] for r in files.file_diff(source, target, overwrite, policy).collect()}

    assert actions(False, "size") == {"new": "copy", "same": "skip", "changed": "copy"}
    assert actions(True, "size") == {"new": "copy", "same": "copy", "changed": "copy"}
    assert actions(False, "name") == {"new": "copy", "same": "skip", "changed": "skip"}
    assert actions(True, "name") == {"new": "copy", "same": "skip", "changed": "copy"}
    with pytest.raises(ValueError):
        files.file_diff(source, target, True, "date")


def test_partition_paths(spark):
    paths = ["country_iso=IDN/330.parquet", "country_iso=None/1.parquet", "x/country_iso=IDN/330.parquet", "country_iso=IDN/readme.txt"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    rows = files.parse_partition_path(df, "https://h/", "s3://b/").collect()
    assert [tuple(r) for r in rows] == [("IDN", "330", "https://h/country_iso=IDN/330.parquet", "s3://b/country_iso=IDN/330.parquet")]


def test_bounds_from_geometry_footers(spark, folder):
    meta = {"columns": {"geometry": {"bbox": [1.0, 2.0, 3.0, 5.0]}}}
    table = pa.table({"v": [1, 2]}).replace_schema_metadata({"geo": json.dumps(meta)})
    pq.write_table(table, f"{folder}/a.parquet")
    listing = spark.createDataFrame([(f"{folder}/a.parquet", "IDN")], "url string, country string")
    row = files.bbox_index_from_footers(listing).first()
    assert (row["country"], row["minx"], row["maxy"]) == ("IDN", 1.0, 5.0)
    assert row["bbox_wkt"].startswith("POLYGON ((1.0 2.0, 3.0 2.0")


def test_merge_regions(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, a string"), spark.createDataFrame([(2, 0.5)], "i int, b double")
    assert sorted(map(tuple, tables.merge_regions([a, b]).collect())) == [(1, "x", None), (2, None, 0.5)]
    with pytest.raises(ValueError):
        tables.merge_regions([])


@pytest.mark.parametrize(
    ("x", "y", "cell"),
    [(-180, -90, "0_0"), (-162, -72, "0_0"), (-161.9, -71.9, "1_1"), (180, 90, "19_9"), (0, 0, "9_4"), (0.1, 0.1, "10_5")],
)
def test_grid_cells_are_closed_on_the_right(spark, x, y, cell):
    df = spark.createDataFrame([(float(x), float(y))], "cx double, cy double")
    assert sinks.grid_cell(df).first()["partition"] == cell


def test_write_table_skips_an_existing_target(spark, folder):
    url = f"{folder}/t"
    sinks.write_table(spark.range(1), url)
    sinks.write_table(spark.range(5), url)
    assert spark.read.parquet(url).count() == 1
    sinks.write_table(spark.range(5), url, overwrite=True)
    assert spark.read.parquet(url).count() == 5


def test_write_partitioned_adds_missing_cells_only(spark, folder):
    url = f"{folder}/cells"
    first = zones(spark, {1: [[box(0, 0, 1, 1)]]})
    second = zones(spark, {2: [[box(0, 0, 1, 1)]], 3: [[box(40, 0, 41, 1)]]})
    sinks.write_partitioned(first, url)
    sinks.write_partitioned(second, url)
    assert sorted(r["zone_id"] for r in spark.read.parquet(url).collect()) == [1, 3]
    sinks.write_partitioned(second, url, overwrite=True)
    assert sorted(r["zone_id"] for r in spark.read.parquet(url).collect()) == [2, 3]


def test_write_region_keeps_the_rest(spark, folder):
    root = f"{folder}/raster"
    world = spark.createDataFrame([(i, j, 0.0) for i in range(6) for j in range(6)], "ix long, iy long, value double")
    sinks.write_region(world, root, chunk=4)
    sinks.write_region(world.filter("ix between 3 and 4 and iy = 2").withColumn("value", F.lit(1.0)), root, chunk=4)
    stored = spark.read.parquet(root)
    assert stored.count() == 36
    assert sorted((r["ix"], r["iy"]) for r in stored.filter("value = 1").collect()) == [(3, 2), (4, 2)]


def test_tile_pyramid(spark):
    shapes = {i: [[box(i * 10, 0, i * 10 + 1, 1)]] for i in range(10)}
    df = zones(spark, shapes).withColumn("area", F.col("zone_id").cast("double"))
    every = sinks.tile_pyramid(df, "zone_id", zmax=2)
    assert every.filter("z = 0").count() == 10
    kept = sinks.tile_pyramid(df, "zone_id", zmax=2, keep_per_tile=3, salts=4)
    assert sorted(r["zone_id"] for r in kept.filter("z = 0").collect()) == [7, 8, 9]
    poles = zones(spark, {1: [[box(-180, -90, 180, 90)]]}).withColumn("area", F.lit(1.0))
    assert sinks.tile_pyramid(poles, "zone_id", zmax=2).filter("z = 2").count() == 16


def test_pyramid_rows_go_up_once_and_only_if_kept_below(spark):
    rng = random.Random(4)
    shapes_of = {i: [[box(x, y, x + w, y + w)]] for i in range(90) for x, y, w in [(rng.uniform(-170, 150), rng.uniform(-70, 60), rng.choice([0.5, 9.0]))]}
    df = zones(spark, shapes_of).withColumn("area", (F.col("zone_id") % 7).cast("double"))
    df = df.unionByName(df.filter("zone_id < 5"))  # keys that repeat
    every = {}
    for r in sinks.tile_pyramid(df, "zone_id", zmax=3).collect():
        every.setdefault((r.z, r.tile_x, r.tile_y), []).append((-r.area, r.zone_id))
    kept = sinks.tile_pyramid(df, "zone_id", zmax=3, keep_per_tile=4, salts=3)
    got = {}
    for r in kept.collect():
        got.setdefault((r.z, r.tile_x, r.tile_y), []).append((-r.area, r.zone_id))
    assert {t: sorted(v) for t, v in got.items()} == {t: sorted(v)[:4] for t, v in every.items()}
    # no window reads rows of more than the deepest zoom from the table
    assert "RDD" in kept._jdf.queryExecution().optimizedPlan().toString()
