from __future__ import annotations

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from shapes import box, zones
from zonewright.operators import analytics, filters, products, provenance
from zonewright.sources import sinks

ZONES_URL, DATA_URL = "s3://z.json", "s3://d.json"


def test_uuid5_equals_the_standard_library(spark):
    names = ["a", "", "zürich", "x" * 300]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for namespace in (uuid.NAMESPACE_URL, uuid.NAMESPACE_DNS):
        got = {r["name"]: r["id"] for r in products.with_uuid5(df, ["name"], namespace).collect()}
        assert got == {n: str(uuid.uuid5(namespace, n)) for n in names}


@pytest.mark.parametrize("zone", ["UTC", "Australia/Sydney"])
def test_time_points_do_not_depend_on_the_session(spark, zone):
    cases = {
        "2020": "2020-01-01T00:00:00Z",
        "2024-01": "2024-01-01T00:00:00Z",
        "2024-02-03": "2024-02-03T00:00:00Z",
        "20240203": "2024-02-03T00:00:00Z",
        "2024-01-01T00:00:00Z": "2024-01-01T00:00:00Z",
        "2024-01-01T00:00:00+10:00": "2023-12-31T14:00:00Z",
        "2024-01-01T00:00:00-0330": "2024-01-01T03:30:00Z",
        "2024-10-06T02:30:00": "2024-10-06T02:30:00Z",
        "2024-01-01T01:02:03.5": "2024-01-01T01:02:03.500000Z",
        "2024-04-07T02:30:00+10:00": "2024-04-06T16:30:00Z",
        "soon": None,
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in cases], "text string")
        got = {r["text"]: r["timePoint"] for r in products.with_time_point(df, "text").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == cases


def results(spark):
    rows = [(1, 2020, {"sum-reef-area": 5.0}), (2, 2020, {"sum-reef-area": 1.0}), (1, 2021, {"sum-reef-area": 6.0}), (2, 2021, {"sum-reef-area": 2.0})]
    return spark.createDataFrame(rows, "zone_id long, year int, indicators map<string,double>")


def outputs(spark, product="p"):
    return products.product_outputs(results(spark), product, "run", ZONES_URL, DATA_URL, "process --id 1 --datetime 2020")


def test_documents_are_written_checked_and_summed_up(spark, folder):
    root = f"{folder}/runs"
    sinks.write_product_json(outputs(spark), root, "reef")
    with open(f"{root}/reef/x.provenance.json", "w") as f:
        f.write('{"id": "p"}')
    merged = products.consolidate(spark, root, "p", ZONES_URL, DATA_URL)
    assert merged.count() == 4
    assert merged.select("id").distinct().count() == 2  # years share an id
    expected = str(uuid.uuid5(uuid.NAMESPACE_URL, f"p-1-{ZONES_URL}-{DATA_URL}"))
    assert {r["id"] for r in merged.filter("geometryOutputId = '1'").collect()} == {expected}
    summary = products.run_summary(merged).first()
    assert summary["years"] == ["2020", "2021"] and summary["zones_per_year"] == 2
    assert summary["command"] == "process --id {geometry_id} --datetime {datetime}"
    for wrong in (("q", None, None), ("p", "s3://other", None), ("p", None, "s3://other")):
        with pytest.raises(Exception, match="another product or input"):
            products.consolidate(spark, root, *wrong).select("id").collect()


def test_documents_of_earlier_runs_stay(spark, folder):
    root = f"{folder}/reruns"
    both = outputs(spark)
    of_year = {y: both.filter(F.col("timePoint").startswith(y)) for y in ("2020", "2021")}
    sinks.write_product_json(of_year["2020"], root, "reef")
    sinks.write_product_json(of_year["2021"], root, "reef")
    sinks.write_product_json(both, root, "reef")  # a rerun adds nothing
    other = outputs(spark, "q").filter(F.col("geometryOutputId") == "1")
    sinks.write_product_json(other, root, "reef")

    def stored():
        rows = spark.read.json(f"{root}/reef").collect()
        return sorted((r["productId"], r["geometryOutputId"], r["timePoint"][:4], r["productRunId"]) for r in rows)

    keys = [("p", z, y) for z in "12" for y in ("2020", "2021")] + [("q", "1", y) for y in ("2020", "2021")]
    assert [k[:3] for k in stored()] == sorted(keys)
    anew = of_year["2020"].filter(F.col("geometryOutputId") == "1").withColumn("productRunId", F.lit("anew"))
    sinks.write_product_json(anew, root, "reef", overwrite=True)
    assert [k[:3] for k in stored()] == sorted(keys)
    assert [k[:3] for k in stored() if k[3] == "anew"] == [("p", "1", "2020")]


def test_consolidating_nothing_is_an_error(spark, folder):
    os.makedirs(f"{folder}/empty")
    with pytest.raises(Exception, match="no product documents"):
        products.consolidate(spark, f"{folder}/empty", "p")


def test_payloads_group_by_indicator_and_time(spark):
    rows = products.product_payloads(outputs(spark), "r", n_slices=1).collect()
    assert sorted((r["indicatorId"], r["timePoint"][:4], len(r["outputs"])) for r in rows) == [
        ("sum-reef-area", "2020", 2), ("sum-reef-area", "2021", 2),
    ]
    sliced = products.product_payloads(outputs(spark), "r", n_slices=3)
    assert sliced.select(F.sum(F.size("outputs"))).first()[0] == 4


def test_paths(spark):
    row = products.output_paths(results(spark).limit(1), "p", ["reef"]).first()
    assert (row["path"], row["directory"], row["file_name"]) == ("reef/2020/p-1.json", "reef/2020", "p-1.json")
    assert products.output_paths(results(spark).limit(1), "p", ["a", "b"]).first()["path"].startswith("many-indicators/")
    cases = {"s3://b/dir/f.parquet": ("s3://b/dir", "f.parquet"), "/data/f.json": ("/data", "f.json"), "f": ("", "f"), "https://h//x": ("https://h", "x")}
    df = spark.createDataFrame([(p,) for p in cases], "path string")
    assert {r["path"]: (r["directory"], r["file_name"]) for r in products.split_path(df).collect()} == cases


def test_batches(spark):
    ids = spark.range(0, 1234).withColumnRenamed("id", "k")
    sizes = [r["count"] for r in products.batches(ids, "k", 50).groupBy("batch").count().orderBy("batch").collect()]
    assert sizes == [50] * 24 + [34]
    for none in (None, 0, -1):
        assert products.batches(ids, "k", none).select("batch").distinct().collect()[0][0] == 1
    with pytest.raises(ValueError):
        products.batch_payloads(ids, "r", 0, "k")


def test_id_and_name(spark):
    df = zones(spark, {1: [[box(0, 0, 1, 1)]], 2: [[box(0, 0, 1, 1)]]}).withColumnRenamed("zone_id", "row")
    named = products.add_id_name(df.withColumn("label", F.lit("x")), "label", "key", "2024", "row")
    assert {r["zone_id"] for r in named.collect()} == {str(uuid.uuid5(uuid.NAMESPACE_URL, f"key2024{i}")) for i in (1, 2)}
    assert products.duplicate_names(named, "zone_name").first()["n_rows"] == 2
    with pytest.raises(ValueError, match="not found"):
        products.add_id_name(df, "label", "key", "2024", "row")
    for blank in ("", None):
        with pytest.raises(Exception, match="null or blank"):
            products.add_id_name(df.withColumn("label", F.lit(blank).cast("string")), "label", "key", "2024", "row").collect()


def test_geometry_outputs_clean_values(spark):
    df = zones(spark, {1: [[box(0, 0, 1, 1)]], 2: None}).withColumns({"zone_name": F.lit("n"), "v": F.lit(float("nan"))})
    rows = products.geometry_outputs(df).collect()
    assert len(rows) == 1 and rows[0]["geometry"].startswith("POLYGON ((0.0 0.0")
    assert json.loads(rows[0]["properties"]) == {"zone_id": 1, "zone_name": "n", "v": None}


def test_zone_selection_checks(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "zone_id long, name string")

    def ids(*wanted):
        return spark.createDataFrame([(i,) for i in wanted], "zone_id long")

    assert filters.select_zones(df, ids(1)).collect()[0]["name"] == "a"
    with pytest.raises(Exception, match="zone id 2 is not unique"):
        filters.select_zones(df, ids(1, 2)).collect()
    for wanted in ((9,), (1, 9)):
        with pytest.raises(Exception, match="zone id 9 not found"):
            filters.select_zones(df, ids(*wanted)).select("name").collect()


def test_name_filter_checks(spark):
    df = spark.createDataFrame([(1, " Fiji ", None), (2, "Tonga", "Fiji"), (3, "Niue", None)], "row long, a string, b string")
    kept = filters.filter_by_names(df, ["a", "b"], ["Fiji", " ", ""], "src", "t", "row")
    assert sorted(r["row"] for r in kept.collect()) == [1, 2]
    with pytest.raises(Exception, match="names not found: Samoa"):
        filters.filter_by_names(df, ["a", "b"], ["Fiji", "Samoa"], "src", "t", "row").collect()
    with pytest.raises(Exception, match="names not found: Samoa"):
        filters.filter_by_names(df, ["a", "b"], ["Samoa"], "src", "t", "row").count()
    with pytest.raises(ValueError, match="fields not found"):
        filters.filter_by_names(df, ["a", "c"], ["Fiji"], "src", "t", "row")


def test_value_lists(spark):
    df = spark.createDataFrame([(1, "1, 2.5 ,reef"), (2, None), (3, "7"), (4, "a,b")], "i int, value string")
    got = {r["i"]: (r["numbers"], r["texts"]) for r in filters.parse_value_lists(df).collect()}
    assert got == {1: ([1.0, 2.5], ["reef"]), 2: (None, None), 3: ([7.0], []), 4: ([], ["a", "b"])}


def test_provenance(spark, folder):
    row = [("set", "parquet", "s3://d", "s3://d.parquet", 5, '"abc"')]
    info = spark.createDataFrame(row, "id string, data_type string, data_url string, path string, size long, tag string")
    record = provenance.provenance_rows(info, "2024Z", "code", "image", extra={"productRunId": "r1"})
    got = record.first()
    assert (got["dataEtag"], got["sourceUrl"], got["provenanceUrl"]) == ("abc", "s3://d", "s3://d.parquet.provenance.json")
    with pytest.raises(Exception, match="unsupported data type: csv"):
        provenance.provenance_rows(info.withColumn("data_type", F.lit("csv")), "t", "c", "i").collect()
    posted = provenance.run_payloads(record, "product").first()
    assert (posted["productId"], posted["id"], "sourceUrl" in posted.asDict()) == ("set", "r1", False)
    assert posted["provenanceJson"]["sourceUrl"] == "s3://d"
    assert "id" not in provenance.run_payloads(record.drop("productRunId"), "dataset").columns
    with pytest.raises(ValueError):
        provenance.run_payloads(record, "other")
    with open(f"{folder}/a.provenance.json", "w") as f:
        json.dump({"id": "set", "dataUrl": "s3://d", "dataType": "parquet", "more": 1}, f, indent=2)
    assert provenance.read_provenance(spark, folder).select("dataUrl", "dataType").first() == ("s3://d", "parquet")


def test_records_hold_workflow_and_metadata(spark, folder):
    row = [("set", "parquet", "s3://d", "s3://d.parquet", 5, "t", "s3://m.xml"), ("bare", "parquet", "s3://e", "s3://e.parquet", 6, "t", None)]
    columns = "id string, data_type string, data_url string, path string, size long, tag string, source_metadata_url string"
    info = spark.createDataFrame(row, columns)
    steps = spark.createDataFrame([("b", "run", 1), ("a", "get", 0)], "label string, command string, position long")
    log = provenance.append_step(None, steps)
    records = provenance.provenance_rows(
        info, "2024Z", "code", "image", workflow_dag=provenance.workflow_steps(log), workflow_dag_simple='{"a": ["b"]}'
    )
    documents = provenance.provenance_documents(records)
    read = {u: json.loads(v) for u, v in documents.collect()}
    assert read["s3://d.parquet.provenance.json"]["workflowDag"] == [{"label": "a", "command": "get"}, {"label": "b", "command": "run"}]
    assert read["s3://d.parquet.provenance.json"]["sourceMetadataUrl"] == "s3://m.xml"
    assert "sourceMetadataUrl" not in read["s3://e.parquet.provenance.json"]
    documents.select("value").write.text(f"{folder}/records")
    back = provenance.read_provenance(spark, f"{folder}/records", "*.txt", lines=True)
    assert {r["id"]: json.loads(r["workflowDagSimple"]) for r in back.collect()} == {"set": {"a": ["b"]}, "bare": {"a": ["b"]}}
    empty = provenance.provenance_rows(info, "t", "c", "i", workflow_dag=provenance.workflow_steps(log.limit(0)))
    assert empty.first()["workflowDag"] is None
    with pytest.raises(Exception, match="(?i)json"):
        provenance.provenance_rows(info, "t", "c", "i", workflow_dag="{no").collect()


def test_reports_read_their_rows_once(spark):
    rows = [(1, 2020, 5.0), (1, 2021, 7.0), (2, 2021, 9.0), (None, 2020, 1.0), (3, None, 2.0), (2, 2021, 1.0)]
    df = spark.createDataFrame([(z, str(z), y, "i", v) for z, y, v in rows], "zone_id int, zone_name string, year int, indicator string, value double")
    got = analytics.summary(df)
    assert tuple(got.first()) == (6, 2020, 2021, 3, 17.0, 9.0, 3)
    assert got._jdf.queryExecution().executedPlan().toString().count("Scan ") == 1
    assert analytics.summary(df.limit(0)).first()["n_zones"] == 0
    series = {r["year"]: (r["top_1"], r["top_2"]) for r in analytics.top_series(df, 2).collect()}
    assert series == {2020: (None, 5.0), 2021: (10.0, 7.0)}


def test_a_key_twice_in_a_batch_fails_before_writing(spark, folder):
    both = outputs(spark)
    with pytest.raises(Exception, match="documents given twice"):
        sinks.write_product_json(both.unionByName(both), f"{folder}/twice", "reef")


def test_step_log_skips_damage(spark, folder):
    root = f"{folder}/steps"
    steps = spark.createDataFrame([("a", 0), ("b", 1)], "label string, position long")
    provenance.append_step(None, steps).write.json(root)
    log = provenance.read_steps(spark, root)
    provenance.append_step(log, steps).write.mode("append").json(root)
    with open(f"{root}/step-0009.json", "w") as f:
        f.write('{"label": "broken", "order": ')
    assert [(r["order"], r["label"]) for r in provenance.read_steps(spark, root).collect()] == [(0, "a"), (1, "b"), (2, "a"), (3, "b")]


def test_file_info_reads_no_content(spark, folder):
    with open(f"{folder}/a.bin", "wb") as f:
        f.write(b"12345")
    info = provenance.file_info(spark, folder)
    assert "content" not in info._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    assert info.first()["size"] == 5


def test_reports(spark):
    rows = [(1, "a", 2020, "i", 4e6), (2, "b", 2020, "i", 1e6), (1, "a", 2019, "i", 2e6), (3, "c", 2020, "i", None), (4, "d", 2020, "i", 0.0)]
    df = spark.createDataFrame(rows, "zone_id long, zone_name string, year int, indicator string, value double")
    assert [r["zone_id"] for r in analytics.top_latest(df, 2).collect()] == [1, 2]
    series = {r["year"]: (r["top_1"], r["top_2"]) for r in analytics.top_series(df, 2).collect()}
    assert series == {2019: (2e6, None), 2020: (4e6, 1e6)}
    summed = analytics.summary(analytics.with_units(df), "value_display").first()
    assert (summed["n_rows"], summed["n_zones"], summed["latest_total"], summed["max_value"]) == (5, 4, 5.0, 4.0)
    other = df.withColumn("value", F.col("value") * 1.5)
    compared = analytics.compare_versions(df, other, ["zone_id", "year"])
    assert sorted((r["zone_id"], r["year"], r["diff"], r["rel_diff"]) for r in compared.collect()) == [(1, 2019, 1.0, 0.5), (1, 2020, 2.0, 0.5), (2, 2020, 0.5, 0.5)]
    assert analytics.top_diff(compared, k=1).first()["diff"] == 2.0


def test_a_name_of_blanks_fails(spark):
    rows = spark.createDataFrame([(1, "  ")], "k bigint, name string")
    with pytest.raises(Exception, match="null or blank name at 1"):
        products.add_id_name(rows, "name", "key", "2020", "k").collect()
