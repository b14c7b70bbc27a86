"""Vector data sets in a whole run, on tiled pieces."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import shapes
from zonewright.operators import indicators
from zonewright.operators.geometry import with_area_m2, zone_pieces

SPEC = "key string, name string, value string"


def run(spark, zones, features, records, **options):
    spec = spark.createDataFrame([("sum-reef-area", "reef", "7"), ("percent-reef-area", "reef", None)][:1], SPEC)
    made = indicators.compute_indicators(
        zones, spec, [2019, 2020], features=features, feature_key=["feature_id"],
        provenance=spark.createDataFrame(records, "name string, dataType string"), **options,
    )
    return {(r.zone_id, r.year): r.indicators["sum-reef-area"] for r in made.collect()}


def sides(spark):
    # zone 1 is far above the tiling limit; zone 2 is small; zone 3 meets nothing
    zones = shapes.zones(
        spark, {1: [[shapes.box(0, 0, 14, 12)]], 2: [[shapes.box(20, 0, 21, 1)]], 3: [[shapes.box(40, 0, 41, 1)]]}
    )
    boxes = {k: [[shapes.box(x, y, x + 0.7, y + 0.7)]] for k, (x, y) in enumerate((i * 0.93, j * 0.87) for i in range(24) for j in range(14))}
    features = shapes.zones(spark, boxes, "feature_id").withColumn("asset", F.lit("reef"))
    return zones, features


def test_features_count_once_per_piece_or_zone(spark):
    zones, features = sides(spark)
    pieces = zone_pieces(zones).collect()
    assert sum(p.zone_id == 1 for p in pieces) > 4
    areas = {r.feature_id: (r.geometry, r.area_m2) for r in with_area_m2(features).collect()}

    def plain(geometry):
        return [[[{"x": v.x, "y": v.y} for v in ring] for ring in poly] for poly in geometry]

    per_piece, per_zone = {}, {}
    for piece in pieces:
        met = {k: a for k, (g, a) in areas.items() if shapes.intersects(plain(g), plain(piece.geometry))}
        per_piece[piece.zone_id] = per_piece.get(piece.zone_id, 0) + round(sum(met.values()), 2)
        per_zone.setdefault(piece.zone_id, {}).update(met)
    records = [("reef", "geoparquet")]
    got = run(spark, zones, features, records)
    assert got == {(z, y): pytest.approx(per_piece[z], abs=0.05) for z in (1, 2, 3) for y in (2019, 2020)}
    once = run(spark, zones, features, records, dedupe=True)
    assert once[1, 2019] == pytest.approx(sum(per_zone[1].values()), abs=0.05) and once[1, 2019] < got[1, 2019]
    assert got[3, 2020] == 0.0


def test_the_format_decides(spark):
    zones, features = sides(spark)
    assert set(run(spark, zones, features, [("reef", "stac-geoparquet")]).values()) == {0.0}
    for records in ([("reef", "zarr")], [("other", "parquet")]):
        with pytest.raises(Exception, match="no data format known for reef"):
            run(spark, zones, features, records)
