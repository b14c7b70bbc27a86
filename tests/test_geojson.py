"""A collection in one file, read in small ranges, against a plain JSON parser."""

from __future__ import annotations

import json
import random

import pytest

from zonewright.sources import geojson


def collection(seed):
    rng = random.Random(seed)
    odd = ['}', '{"a":[', '\\"', '"', "\\", '\\\\"}', "ünï😀", "\n", "]}", "x" * 400, ""]
    features = []
    for k in range(60):
        properties = {"id": k, "odd": "".join(rng.choice(odd) for _ in range(rng.randrange(6)))}
        if k % 7 == 0:
            properties["deep"] = {"a": [{"b": [{}]}, {"c": "}"}]}
        x = float(k)
        ring = [[x, 0.0], [x + 1, 0.0], [x + 1, 1.0], [x, 0.0]]
        features.append({"type": "Feature", "properties": properties, "geometry": {"type": "Polygon", "coordinates": [ring]}})
    # one feature larger than many ranges
    features[30]["properties"]["odd"] = "}{" * 3000
    document = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x"}}, "bbox": [0, 1]}
    document["features"] = features
    return document


@pytest.mark.parametrize("indent,split", [(None, 100), (None, 777), (2, 300), (None, 1 << 20)])
def test_equals_a_plain_parser(spark, folder, indent, split):
    documents = [collection(1), collection(2)]
    for k, document in enumerate(documents):
        with open(f"{folder}/c{k}.geojson", "w", encoding="utf-8") as file:
            json.dump(document, file, indent=indent, ensure_ascii=k == 0)
    read = geojson.read_geojson_split(spark, folder, "id bigint, odd string", split_bytes=split)
    got = sorted((r.id, r.odd, r.geometry[0][0][0].x) for r in read.collect())
    want = sorted(
        (f["properties"]["id"], f["properties"]["odd"], float(f["properties"]["id"]))
        for d in documents
        for f in d["features"]
    )
    assert got == want
    assert int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b")) > 1 << 20


def test_one_file_feeds_many_tasks(spark, folder):
    with open(f"{folder}/c.geojson", "w", encoding="utf-8") as file:
        json.dump(collection(3), file)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        pieces = spark.read.option("lineSep", "}").text(folder)
        assert pieces.rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_empty_collection(spark, folder):
    with open(f"{folder}/c.geojson", "w", encoding="utf-8") as file:
        file.write('{"type": "FeatureCollection", "features": []}\n')
    assert geojson.read_geojson_split(spark, folder).collect() == []
