from __future__ import annotations

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from shapes import box, covers, ring, zones
from zonewright.functions import geometry as g
from zonewright.functions.wkb import from_wkb, srid_of, to_wkb
from zonewright.operators import geometry as ops
from zonewright.sources.tables import polygons_from_wkb

DONUT = [box(0, 0, 10, 10), box(4, 4, 6, 6)]
CONCAVE = [ring((0, 0), (12, 0), (12, 4), (4, 4), (4, 12), (0, 12))]


def inside(spark, geometry, x, y):
    df = zones(spark, {1: geometry}).select(F.expr(g.covers(g.edges("geometry"), f"{x}D", f"{y}D")))
    return df.first()[0]


@pytest.mark.parametrize(
    ("x", "y", "expected"),
    [
        (5, 5, False),  # in the hole
        (4, 5, True),  # on the hole's edge
        (4, 4, True),  # on the hole's corner
        (0, 0, True),
        (10, 10, True),
        (10, 3, True),
        (10.000001, 3, False),
        (2, 2, True),
        (-1, 0, False),  # in line with the lower edge
        (11, 10, False),
    ],
)
def test_covers_counts_the_boundary(spark, x, y, expected):
    assert inside(spark, [DONUT], x, y) is expected
    assert covers([DONUT], x, y) is expected


def test_covers_concave_and_multipolygon(spark):
    shape = [CONCAVE, [ring((14, 14), (18, 14), (16, 18))]]
    rng = random.Random(3)
    points = [(i, rng.choice([0.0, 4.0, 12.0, 14.0, rng.uniform(-1, 19)]), rng.uniform(-1, 19)) for i in range(200)]
    df = spark.createDataFrame(points, "i int, x double, y double").join(
        F.broadcast(zones(spark, {1: shape}))
    )
    got = {r["i"]: r["hit"] for r in df.select("i", F.expr(g.covers(g.edges("geometry"), "x", "y")).alias("hit")).collect()}
    assert got == {i: covers(shape, x, y) for i, x, y in points}


def test_area_centroid_and_bounds(spark):
    df = ops.with_bounds(ops.with_centroid(zones(spark, {1: [DONUT], 2: [CONCAVE]})))
    rows = {r["zone_id"]: r for r in df.withColumn("a", F.expr(g.area("geometry"))).collect()}
    assert rows[1]["a"] == 96 and (rows[1]["cx"], rows[1]["cy"]) == pytest.approx((5, 5))
    assert rows[2]["a"] == 80 and (rows[2]["cx"], rows[2]["cy"]) == pytest.approx((4.4, 4.4))
    assert (rows[2]["minx"], rows[2]["maxy"]) == (0, 12)


def test_empty_geometry(spark):
    df = ops.with_centroid(zones(spark, {1: []}))
    row = df.select("cx", F.expr(g.area("geometry")).alias("a")).first()
    assert row["cx"] is None and row["a"] == 0


def test_equal_area_golden_number(spark):
    square = zones(spark, {1: [[box(8, -1, 9, 0)]]})
    assert round(ops.with_area_m2(square).first()["area_m2"], 2) == 12308463893.98


def test_projection_round_trip(spark):
    points = [(float(lon), float(lat)) for lon in range(-180, 181, 30) for lat in range(-80, 81, 5)]
    shape = [[[{"x": lon, "y": lat} for lon, lat in points]]]
    back = ops.unproject_zones(ops.project_zones(zones(spark, {1: shape}))).first()["geometry"][0][0]
    for (lon, lat), v in zip(points, back):
        assert v["x"] == pytest.approx(lon, abs=1e-7) and v["y"] == pytest.approx(lat, abs=1e-7)


def test_clip_matches_overlap_area_and_is_idempotent(spark):
    rng = random.Random(11)
    shapes = {}
    for i in range(30):
        n = rng.randint(3, 9)
        spokes = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        star = ring(*((10 + rng.uniform(2, 9) * math.cos(t), 10 + rng.uniform(2, 9) * math.sin(t)) for t in spokes))
        shapes[i] = [[star]]
    shapes[98], shapes[99] = [DONUT], [CONCAVE]
    limits = ("3.5D", "2.25D", "9.75D", "5.5D")
    df = zones(spark, shapes).withColumn("cut", F.expr(g.clip("geometry", *limits)))
    df = df.withColumn("again", F.expr(g.clip("cut", *limits)))
    for r in df.select(
        "zone_id",
        F.expr(g.area("cut")).alias("a"),
        F.expr(g.area("again")).alias("b"),
        F.expr(g.box_overlap_area("geometry", *limits)).alias("c"),
    ).collect():
        # a self-crossing ring has no single area; stars sorted by angle do not cross
        assert r["a"] == pytest.approx(r["b"], abs=1e-9)
        assert r["a"] == pytest.approx(r["c"], abs=1e-7), r


def test_tiles_add_up(spark):
    shapes = {1: [[box(100, -20, 140, 10)]], 2: [CONCAVE], 3: [[box(0, 0, 1, 1)]]}
    parts = ops.explode_parts(zones(spark, shapes))
    whole = {r["zone_id"]: r["area_m2"] for r in ops.with_area_m2(parts).collect()}
    tiles = ops.with_area_m2(ops.tile_zones(parts)).groupBy("zone_id").agg(
        F.sum("area_m2").alias("a"), F.count("*").alias("n"), F.count_distinct("tile").alias("d")
    )
    for r in tiles.collect():
        assert r["a"] == pytest.approx(whole[r["zone_id"]], rel=1e-9)
        assert r["n"] == r["d"] and (r["n"] == 1) == (whole[r["zone_id"]] <= 5e11)
    # 3,859 km by 3,770 km in the equal-area grid
    assert {r["zone_id"]: r["n"] for r in tiles.collect()}[1] == 8 * 8


def test_tile_side_and_limit_are_parameters(spark):
    # one degree at the equator is 96 km by 128 km in the equal-area grid
    df = ops.tile_zones(ops.explode_parts(zones(spark, {1: [[box(0, 0, 1, 1)]]})), max_km2=1, side_m=60_000)
    assert df.count() == 2 * 3


def test_antimeridian(spark):
    shapes = {
        1: [[box(170, 0, 190, 5)]],  # beyond 180
        2: [[ring((170, 0), (-170, 0), (-170, 5), (170, 5))]],  # wrapped
        3: [[box(10, 0, 20, 5)]],
        4: [[box(170, 0, 180, 5)]],
    }
    got = ops.with_bounds(ops.split_antimeridian(zones(spark, shapes)))
    rows = [(r["zone_id"], r["side"], r["minx"], r["maxx"]) for r in got.orderBy("zone_id", "side").collect()]
    assert rows == [
        (1, 0, 170, 180), (1, 1, -180, -170), (2, 0, 170, 180), (2, 1, -180, -170), (3, 0, 10, 20), (4, 0, 170, 180),
    ]


def test_wkt_round_trip(spark):
    df = zones(spark, {1: [DONUT], 2: [DONUT, CONCAVE]})
    text = df.withColumn("wkt", F.expr(g.to_wkt("geometry")))
    back = text.withColumn("back", F.expr(g.from_wkt("wkt")))
    for r in back.collect():
        assert r["back"] == r["geometry"]
    loose = spark.createDataFrame(
        [("multipolygon(((0 0, 1 0,1 1, 0 0)) , ((5 5,6 5,6 6,5 5),(5.1 5.1,5.2 5.1,5.2 5.2,5.1 5.1)))",), ("POINT (1 2)",)],
        "wkt string",
    ).select(F.expr(g.from_wkt("wkt")).alias("geometry"))
    first, second = loose.collect()
    assert [len(p) for p in first["geometry"]] == [1, 2] and second["geometry"] is None


def test_parts_keep_null_geometries(spark):
    df = ops.explode_parts(zones(spark, {1: None, 2: [DONUT, CONCAVE]}))
    assert sorted((r["zone_id"], r["part"]) for r in df.fillna({"part": -1}).collect()) == [(1, -1), (2, 0), (2, 1)]
    assert ops.geometry_counts(zones(spark, {1: None, 2: [DONUT]})).first().asDict() == {"n_kept": 1, "n_skipped": 1}


def test_geometry_kind_is_checked(spark):
    df = zones(spark, {1: [DONUT]}).withColumn("kind", F.lit("Point"))
    with pytest.raises(Exception, match="not Point"):
        ops.geometry_checks(df, kind="kind").collect()


def test_clip_to_boxes_drops_empty_rows(spark):
    boxes = spark.createDataFrame(
        [(1, 0.0, 0.0, 5.0, 5.0), (1, 4.5, 4.5, 5.5, 5.5), (1, 20.0, 0.0, 30.0, 5.0)],
        "zone_id bigint, minx double, miny double, maxx double, maxy double",
    )
    got = ops.clip_to_boxes(zones(spark, {1: [DONUT]}), boxes, "zone_id")
    areas = [r[0] for r in got.select(F.expr(g.area("geometry"))).collect()]
    assert areas == [24.0]  # the second box lies in the hole, the third outside


def test_wkb(spark):
    # little-endian EWKB of POLYGON ((0 0, 1 0, 1 1, 0 0)), SRID 4326
    known = (
        "0103000020E61000000100000004000000"
        "00000000000000000000000000000000"
        "000000000000F03F0000000000000000"
        "000000000000F03F000000000000F03F"
        "00000000000000000000000000000000"
    )
    triangle = [[ring((0, 0), (1, 0), (1, 1))]]
    df = zones(spark, {1: triangle, 2: [DONUT, CONCAVE], 3: None, 4: []})
    coded = df.withColumn("wkb", to_wkb(F.col("geometry")))
    assert coded.filter("zone_id = 1").select(F.hex("wkb")).first()[0] == known
    for r in coded.withColumn("back", from_wkb(F.col("wkb"))).collect():
        assert r["back"] == r["geometry"]
    # big-endian polygon with z (ISO)
    z = struct.pack(">BIII9d", 0, 1003, 1, 3, 0, 0, 9, 1, 0, 9, 0, 0, 9)
    rows = spark.createDataFrame([(1, bytearray(z)), (2, None)], "i int, wkb binary")
    got = {r["i"]: r["g"] for r in rows.select("i", from_wkb(F.col("wkb")).alias("g")).collect()}
    assert [(v["x"], v["y"]) for v in got[1][0][0]] == [(0, 0), (1, 0), (0, 0)] and got[2] is None
    srids = coded.filter("wkb IS NOT NULL").select(F.expr(srid_of("wkb"))).collect()
    assert [r[0] for r in srids] == [4326, 4326, 4326]
    assert rows.select(F.expr(srid_of("wkb"))).first()[0] is None
    big = spark.createDataFrame([(bytearray(struct.pack(">BIIII", 0, 0x20000003, 6933, 1, 0)),)], "wkb binary")
    assert big.select(F.expr(srid_of("wkb"))).first()[0] == 6933
    point = spark.createDataFrame([(bytearray(struct.pack("<BIdd", 1, 1, 1, 2)),)], "wkb binary")
    with pytest.raises(Exception, match="geometry of kind 1"):
        point.select(from_wkb(F.col("wkb"))).collect()


def test_small_zones_survive_clip_and_split(spark):
    tiny = [[ring((10, 10), (10.0001, 10), (10.0001, 10.0001), (10, 10.0001))]]
    df = zones(spark, {1: tiny})
    assert ops.split_antimeridian(df).count() == 1
    world = spark.createDataFrame(
        [(1, -180.0, -90.0, 180.0, 90.0)],
        "zone_id int, minx double, miny double, maxx double, maxy double",
    )
    assert ops.clip_to_boxes(df, world, ["zone_id"]).count() == 1


def test_binary_polygons_keep_their_coordinate_system(spark):
    # the inverse is a series of the projection, good to about 1e-8 degrees (a millimetre)
    df = zones(spark, {1: [DONUT], 2: [CONCAVE], 3: None})
    metres = ops.project_zones(df).withColumn("geometry", to_wkb(F.col("geometry"), 6933))
    back = {r["zone_id"]: r["geometry"] for r in polygons_from_wkb(metres).collect()}
    for r in df.collect():
        if r["geometry"] is None:
            assert back[r["zone_id"]] is None
            continue
        for want, got in zip(r["geometry"], back[r["zone_id"]], strict=True):
            flat = [(v["x"], v["y"]) for x in want for v in x]
            assert [(v["x"], v["y"]) for x in got for v in x] == [pytest.approx(v, abs=1e-7) for v in flat]
    degrees = df.withColumn("geometry", to_wkb(F.col("geometry")))
    assert [r["geometry"] for r in polygons_from_wkb(degrees, srid=6933).collect()] == [r["geometry"] for r in df.collect()]
    other = df.withColumn("geometry", to_wkb(F.col("geometry"), 3577))
    with pytest.raises(Exception, match="not supported: EPSG:3577"):
        polygons_from_wkb(other).collect()
