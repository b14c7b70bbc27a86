"""Documents of several runs, and what counts of them."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from zonewright.operators import products
from zonewright.sources import manifest

KEY = "sum-reef-area"


def outputs(spark, rows, run="r"):
    results = spark.createDataFrame(rows, "zone_id bigint, year int, v double").select(
        "zone_id", "year", F.create_map(F.lit(KEY), "v").alias("indicators")
    )
    return products.product_outputs(results, "reef", run, "s3://z", "s3://d", "make")


def stored(spark, root):
    rows = manifest.read_documents(spark, root).collect()
    assert len({(r.geometryOutputId, r.timePoint) for r in rows}) == len(rows)
    return {(int(r.geometryOutputId), r.timePoint[:4]): (r.indicators[KEY], r.run) for r in rows}


def test_earlier_documents_stay_and_overwritten_ones_count(spark, folder):
    manifest.write_documents(outputs(spark, [(1, 2020, 1.0), (2, 2020, 2.0)]), folder + "/p", [KEY], 1)
    manifest.write_documents(outputs(spark, [(2, 2020, 9.0), (3, 2021, 3.0)]), folder + "/p", [KEY], 2)
    assert stored(spark, folder + "/p") == {(1, "2020"): (1.0, 1), (2, "2020"): (2.0, 1), (3, "2021"): (3.0, 2)}
    manifest.write_documents(outputs(spark, [(2, 2020, 9.0)]), folder + "/p", [KEY], 3, overwrite=True)
    assert stored(spark, folder + "/p")[2, "2020"] == (9.0, 3)
    paths = [r.path for r in manifest.read_documents(spark, folder + "/p").collect()]
    assert f"{KEY}/2020-01-01T00:00:00Z/reef-1.json" in paths


def test_a_key_twice_fails_and_adds_nothing(spark, folder):
    manifest.write_documents(outputs(spark, [(1, 2020, 1.0)]), folder + "/p", [KEY], 1)
    with pytest.raises(Exception, match="given twice: reef/5/2020"):
        manifest.write_documents(outputs(spark, [(5, 2020, 1.0), (5, 2020, 1.5)]), folder + "/p", [KEY], 2)
    assert list(stored(spark, folder + "/p")) == [(1, "2020")]


def test_pending_is_what_has_no_document(spark, folder):
    root = folder + "/p"
    work = spark.createDataFrame([(y, z) for y in (2019, 2020) for z in range(6)], "year int, zone_id bigint")
    ask = lambda: {(r.zone_id, r.year) for r in manifest.pending_documents(spark, work, root, "reef", [KEY]).collect()}
    assert len(ask()) == 12
    manifest.write_documents(outputs(spark, [(z, 2020, 0.0) for z in range(4)]), root, [KEY], 1)
    assert ask() == {(z, 2019) for z in range(6)} | {(4, 2020), (5, 2020)}
    assert manifest.pending_documents(spark, work, root, "other", [KEY]).count() == 12


def test_documents_without_an_entry_do_not_count(spark, folder):
    """A run that broke off between its documents and its entries."""
    root = folder + "/p"
    manifest.write_documents(outputs(spark, [(1, 2020, 1.0)]), root, [KEY], 1)
    entries = set(Path(root, "manifest").rglob("*.parquet"))
    manifest.write_documents(outputs(spark, [(2, 2020, 2.0), (1, 2020, 7.0)]), root, [KEY], 2, overwrite=True)
    for path in set(Path(root, "manifest").rglob("*.parquet")) - entries:
        path.unlink()
    assert stored(spark, root) == {(1, "2020"): (1.0, 1)}


def test_only_touched_buckets_are_read(spark, folder):
    root = folder + "/p"
    manifest.write_documents(outputs(spark, [(z, 2020, 0.0) for z in range(200)]), root, [KEY], 1)
    work = spark.createDataFrame([(2020, 7)], "year int, zone_id bigint")
    names = {p.name for p in Path(root, "manifest").glob("bucket=*")}
    assert len(names) > 40
    bucket = manifest.read_documents(spark, root).filter("geometryOutputId = '7'").select(
        F.pmod(F.xxhash64(*manifest.DOCUMENT_KEY), F.lit(manifest.BUCKETS)).alias("b")
    ).first()["b"]
    for path in Path(root, "manifest").glob("bucket=*/*.parquet"):
        if path.parent.name != f"bucket={bucket}":
            path.write_bytes(b"nothing")
    assert manifest.pending_documents(spark, work, root, "reef", [KEY]).count() == 0


def test_empty_batch_and_null_keys(spark, folder):
    root = folder + "/p"
    none = outputs(spark, [(1, 2020, 1.0)]).filter("false")
    manifest.write_documents(none, root, [KEY], 1)
    odd = outputs(spark, [(1, 2020, 1.0)]).withColumn("geometryOutputId", F.lit(None).cast("string"))
    manifest.write_documents(odd, root, [KEY], 2)
    manifest.write_documents(odd, root, [KEY], 3)
    (row,) = manifest.read_documents(spark, root).collect()
    assert row.geometryOutputId is None and row.run == 2
