"""Queries of the product, provenance and report operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.functions import geometry as g
from zonewright.functions.wkb import from_wkb, srid_of
from zonewright.operators import analytics, products, provenance
from zonewright.plans import inputs
from zonewright.plans.inputs import tables_sql
from zonewright.plans.raster_queries import uuid5_sql
from zonewright.plans.registry import query
from zonewright.session import scratch_path
from zonewright.sources.sinks import write_product_json

PRODUCT = "reef-watch"
ZONES_URL, DATASET_URL = "s3://zones/z.provenance.json", "s3://data/d.provenance.json"
COMMAND = "products process --geometry-id {zone} --datetime {year}"


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(zone_id, year, indicators) rows of the finished values."""
    values = inputs.product_values(spark, sf_dir)
    entries = F.sort_array(F.collect_list(F.struct("indicator", "value")))
    return values.groupBy("zone_id", "year").agg(F.map_from_entries(entries).alias("indicators"))


def outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.product_outputs(
        results(spark, sf_dir), PRODUCT, "run-1", ZONES_URL, DATASET_URL,
        "products process --geometry-id all",
    )


_OUTPUT_ID = uuid5_sql(f"'{PRODUCT}-'||zone_id||'-{ZONES_URL}-{DATASET_URL}'")
OUTPUTS_SQL = tables_sql("product_values") + f""", out AS (SELECT {_OUTPUT_ID} AS id, '{PRODUCT}' AS "productId",
    'run-1' AS "productRunId", CAST(zone_id AS VARCHAR) AS "geometryOutputId", year||'-01-01T00:00:00Z' AS "timePoint",
    indicator, value FROM product_values)
    """
_FLAT = ["id", "productId", "productRunId", "geometryOutputId", "timePoint"]


def _flat(docs: DataFrame) -> DataFrame:
    return docs.select(*_FLAT, F.explode("indicators").alias("indicator", "value"))


@query(
    "with_uuid5",
    f"SELECT o_orderkey, {uuid5_sql('''o_orderkey||o_orderpriority''')} AS id FROM orders",
)
def with_uuid5(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    return products.with_uuid5(orders, ["o_orderkey", "o_orderpriority"]).select("o_orderkey", "id")


@query(
    "with_time_point",
    """SELECT event_id, CASE event_type WHEN 'click' THEN strftime(ts,'%Y')||'-01-01T00:00:00Z'
    WHEN 'view' THEN strftime(ts,'%Y-%m')||'-01T00:00:00Z'
    WHEN 'error' THEN strftime(ts,'%Y-%m-%dT%H:%M:%SZ')
    ELSE strftime(ts - INTERVAL 10 HOUR,'%Y-%m-%dT%H:%M:%SZ') END AS "timePoint" FROM events""",
)
def with_time_point(spark, sf_dir):
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.date_format("ts", "yyyy"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM"))
        .when(kind == "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+10:00")))
    )
    rows = inputs.table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return products.with_time_point(rows, "text").select("event_id", "timePoint")


@query("product_outputs", OUTPUTS_SQL + "SELECT * FROM out")
def product_outputs(spark, sf_dir):
    return _flat(outputs(spark, sf_dir))


@query(
    "output_paths",
    tables_sql("product_values")
    + f"""SELECT DISTINCT zone_id, year, 'reef/'||year||'/{PRODUCT}-'||zone_id||'.json' AS path,
    'reef/'||year AS directory, '{PRODUCT}-'||zone_id||'.json' AS file_name FROM product_values""",
)
def output_paths(spark, sf_dir):
    work = results(spark, sf_dir).select("zone_id", "year")
    return products.output_paths(work, PRODUCT, ["reef"])


@query("write_product_json", OUTPUTS_SQL + "SELECT * FROM out")
def write_product_json_query(spark, sf_dir):
    root = scratch_path(spark, "documents")
    write_product_json(outputs(spark, sf_dir), root, "reef")
    return _flat(spark.read.schema(products.OUTPUT_SCHEMA).json(f"{root}/reef"))


@query("consolidate", OUTPUTS_SQL + "SELECT * FROM out")
def consolidate(spark, sf_dir):
    root = scratch_path(spark, "documents")
    write_product_json(outputs(spark, sf_dir), root, "reef")
    return _flat(products.consolidate(spark, root, PRODUCT, ZONES_URL, DATASET_URL))


@query(
    "run_summary",
    tables_sql("product_values")
    + """, pairs AS (SELECT DISTINCT zone_id, year FROM product_values)
    SELECT string_agg(DISTINCT CAST(year AS VARCHAR), ',' ORDER BY CAST(year AS VARCHAR)) AS years,
    COUNT(DISTINCT year) AS n_years, CAST(FLOOR(COUNT(*)/COUNT(DISTINCT year)) AS BIGINT) AS zones_per_year,
    'products process --geometry-id {geometry_id} --datetime {datetime}' AS command FROM pairs""",
)
def run_summary(spark, sf_dir):
    docs = outputs(spark, sf_dir)
    command = F.concat(
        F.lit("products process --geometry-id "), F.col("geometryOutputId"),
        F.lit(" --datetime "), F.substring("timePoint", 1, 4),
    )
    docs = docs.withColumn("metadata", F.col("metadata").withField("command", command))
    return products.run_summary(docs).select(
        F.array_join("years", ",").alias("years"),
        F.col("n_years").cast("long").alias("n_years"),
        "zones_per_year",
        "command",
    )


@query(
    "outputs_by_indicator",
    OUTPUTS_SQL
    + """SELECT indicator, "timePoint", COUNT(*) AS n_zones, ROUND(SUM(value),2) AS total,
    MIN("geometryOutputId") AS first_zone FROM out GROUP BY 1,2""",
)
def outputs_by_indicator(spark, sf_dir):
    groups = products.outputs_by_indicator(outputs(spark, sf_dir), n_slices=5)
    values = F.transform("outputs", lambda o: o["value"].cast("decimal(28,2)"))
    sliced = groups.select(
        "indicator", "timePoint", F.size("outputs").alias("n"),
        F.aggregate(values, F.lit(0).cast("decimal(38,2)"), lambda a, v: (a + v).cast("decimal(38,2)")).alias("t"),
        F.get("outputs", F.lit(0))["geometryOutputId"].alias("z"),
    )
    return sliced.groupBy("indicator", "timePoint").agg(
        F.sum("n").alias("n_zones"),
        F.sum("t").cast("double").alias("total"),
        F.min("z").alias("first_zone"),
    )


@query(
    "product_payloads",
    OUTPUTS_SQL
    + """SELECT 'run-9' AS "productRunId", "timePoint", indicator AS "indicatorId", "geometryOutputId", value FROM out""",
)
def product_payloads(spark, sf_dir):
    payloads = products.product_payloads(outputs(spark, sf_dir), "run-9")
    return payloads.select("productRunId", "timePoint", "indicatorId", F.inline("outputs"))


_ZONE_UUID = uuid5_sql("'eez2024-01-01'||s_suppkey")


@query(
    "add_id_name",
    f"SELECT {_ZONE_UUID} AS zone_id, s_name AS zone_name, s_nationkey AS nation FROM supplier",
)
def add_id_name(spark, sf_dir):
    source = inputs.zones(spark, sf_dir).select(
        F.col("zone_id").alias("row"), F.col("zone_name").alias("label"), "nation"
    )
    named = products.add_id_name(source, "label", "eez", "2024-01-01", "row")
    return named.select("zone_id", "zone_name", "nation")


@query(
    "duplicate_names",
    "SELECT p_name, COUNT(*) AS n_rows FROM part GROUP BY 1 HAVING COUNT(*)>1",
)
def duplicate_names(spark, sf_dir):
    return products.duplicate_names(inputs.table(spark, sf_dir, "part"), "p_name")


@query(
    "geometry_outputs",
    """SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, '' AS description, '{}' AS metadata, 2 AS n_parts,
    s_nationkey AS nation, CASE WHEN s_acctbal<5000 THEN s_acctbal END AS balance FROM supplier WHERE s_acctbal>=0""",
)
def geometry_outputs(spark, sf_dir):
    zones = inputs.zones(spark, sf_dir).withColumns(
        {
            "geometry": F.when(F.col("balance") >= 0, F.col("geometry")),
            "balance": F.when(F.col("balance") >= 5000, float("nan")).otherwise(F.col("balance")),
        }
    )
    rows = products.geometry_outputs(zones)
    properties = F.from_json("properties", "nation int, balance double")
    return rows.select(
        "id", "name", "description", "metadata",
        F.size(F.expr(g.from_wkt("geometry"))).alias("n_parts"),
        properties["nation"].alias("nation"), properties["balance"].alias("balance"),
    )


@query(
    "geometry_outputs_wkb",
    tables_sql("zone_vertices")
    + """, rings AS (SELECT zone_id, part, ring, COUNT(*) AS n FROM zone_vertices GROUP BY 1,2,3)
    SELECT CAST(zone_id AS VARCHAR) AS id, CAST(13+9*COUNT(DISTINCT part)+SUM(4+16*n) AS INT) AS n_bytes,
    CAST(4326 AS BIGINT) AS srid, CAST(SUM(n) AS INT) AS n_vertices FROM rings GROUP BY 1""",
)
def geometry_outputs_wkb(spark, sf_dir):
    """Zones as base64 of the extended binary form: its length, coordinate system and vertices."""
    rows = products.geometry_outputs(inputs.zones(spark, sf_dir), form="wkb")
    blobs = rows.select("id", F.unbase64("geometry").alias("blob"))
    return blobs.withColumn("shape", from_wkb(F.col("blob"))).select(
        "id",
        F.length("blob").alias("n_bytes"),
        F.expr(srid_of("blob")).alias("srid"),
        F.size(F.expr(g.xs("shape"))).alias("n_vertices"),
    )


@query(
    "batches",
    """SELECT o_orderkey, CAST(FLOOR((ROW_NUMBER() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey)-1)/50)+1 AS BIGINT) AS batch
    FROM orders""",
)
def batches(spark, sf_dir):
    return products.batches(inputs.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 50)


@query(
    "batch_payloads",
    """SELECT 'zones-run' AS "geometriesRunId", batch, COUNT(*) AS n_outputs, MIN(id) AS first_id FROM (
    SELECT CAST(s_suppkey AS VARCHAR) AS id,
    CAST(FLOOR((ROW_NUMBER() OVER (ORDER BY md5(CAST(s_suppkey AS VARCHAR)), CAST(s_suppkey AS VARCHAR))-1)/8)+1 AS BIGINT) AS batch
    FROM supplier) GROUP BY 1,2""",
)
def batch_payloads(spark, sf_dir):
    rows = products.geometry_outputs(inputs.zones(spark, sf_dir))
    grouped = products.batch_payloads(rows, "zones-run", 8)
    return grouped.select(
        "geometriesRunId", "batch", F.size("outputs").cast("long").alias("n_outputs"),
        F.get("outputs", F.lit(0))["id"].alias("first_id"),
    )


# provenance


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One data file per part: its format by size, its tag quoted as stores give it."""
    size = F.col("p_size")
    kind = F.when(size <= 20, "parquet").when(size <= 35, "geoparquet").otherwise("stac-geoparquet")
    path = F.concat(F.lit("s3://data/"), "p_partkey", F.lit(".parquet"))
    return inputs.table(spark, sf_dir, "part").select(
        F.concat(F.lit("set-"), "p_partkey").alias("id"),
        kind.alias("data_type"),
        path.alias("data_url"),
        path.alias("path"),
        size.cast("long").alias("size"),
        F.concat(F.lit('"'), "p_brand", F.lit('"')).alias("tag"),
        F.when(size <= 25, F.concat(F.lit("https://source/"), "p_partkey")).alias("source_url"),
    )


def provenance_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance.provenance_rows(
        file_listing(spark, sf_dir), "2024-01-01T00:00:00Z", "https://code/tree/abc/", "registry/image:1"
    )


_PROVENANCE_SQL = """SELECT 'set-'||p_partkey AS id, CASE WHEN p_size<=20 THEN 'parquet' WHEN p_size<=35 THEN 'geoparquet'
    ELSE 'stac-geoparquet' END AS "dataType", p_brand AS "dataEtag", CAST(p_size AS BIGINT) AS "dataSize",
    's3://data/'||p_partkey||'.parquet' AS "dataUrl", 's3://data/'||p_partkey||'.parquet.provenance.json' AS "provenanceUrl",
    CASE WHEN p_size<=25 THEN 'https://source/'||p_partkey ELSE 's3://data/'||p_partkey||'.parquet' END AS "sourceUrl" FROM part"""
_PROVENANCE_COLUMNS = ["id", "dataType", "dataEtag", "dataSize", "dataUrl", "provenanceUrl", "sourceUrl"]


@query("provenance_rows", _PROVENANCE_SQL)
def provenance_rows(spark, sf_dir):
    return provenance_table(spark, sf_dir).select(*_PROVENANCE_COLUMNS)


@query(
    "run_payloads",
    """SELECT 'set-'||p_partkey AS "productId", 'run-'||p_partkey AS id, 's3://data/'||p_partkey||'.parquet' AS "dataUrl",
    'set-'||p_partkey AS nested_id, CASE WHEN p_size<=25 THEN 'https://source/'||p_partkey
     ELSE 's3://data/'||p_partkey||'.parquet' END AS nested_source FROM part""",
)
def run_payloads(spark, sf_dir):
    runs = provenance_table(spark, sf_dir).withColumn(
        "productRunId", F.replace("id", F.lit("set-"), F.lit("run-"))
    )
    posted = provenance.run_payloads(runs, "product")
    return posted.select(
        "productId", "id", "dataUrl",
        F.col("provenanceJson.productId").alias("nested_id"),
        F.col("provenanceJson.sourceUrl").alias("nested_source"),
    )


@query(
    "step_log",
    """SELECT CAST(event_id AS BIGINT) AS "order", event_type AS label, user_id AS "user" FROM events""",
)
def step_log(spark, sf_dir):
    """Two appends to a stored log, read back in order."""
    root = scratch_path(spark, "steps")
    events = inputs.table(spark, sf_dir, "events")
    n_first = events.filter(F.col("ts") < "2024-01-15").count()
    steps = events.select(
        F.col("event_type").alias("label"),
        F.concat(F.lit("run "), "user_id").alias("command"),
        F.to_json(F.struct("user_id")).alias("inputs"),
        F.lit("{}").alias("outputs"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("completed_at"),
        F.lit("{}").alias("source"),
        F.col("event_id").alias("position"),
    )
    first = steps.filter(F.col("position") < n_first)
    provenance.append_step(None, first).write.json(root)
    log = provenance.read_steps(spark, root)
    second = steps.filter(F.col("position") >= n_first).withColumn("position", F.col("position") - n_first)
    if not second.isEmpty():
        provenance.append_step(log, second).write.mode("append").json(root)
    return provenance.read_steps(spark, root).select(
        "order", "label", F.get_json_object("inputs", "$.user_id").cast("long").alias("user")
    )


# reports


def finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.product_values(spark, sf_dir)


@query(
    "with_units",
    tables_sql("product_values")
    + """SELECT zone_id, year, indicator, ROUND(value/1e6,6) AS value_km2, ROUND(value/1e10,9) AS value_mha FROM product_values""",
)
def with_units(spark, sf_dir):
    km2 = analytics.with_units(finished(spark, sf_dir), "km²").withColumnRenamed("value_display", "k")
    both = analytics.with_units(km2, "million ha")
    return both.select(
        "zone_id", "year", "indicator", F.round("k", 6).alias("value_km2"),
        F.round("value_display", 9).alias("value_mha"),
    )


@query(
    "time_filter",
    tables_sql("product_values")
    + "SELECT zone_id, zone_name, indicator, value FROM product_values WHERE year=1998 ORDER BY zone_name, zone_id, indicator",
)
def time_filter(spark, sf_dir):
    return analytics.time_filter(finished(spark, sf_dir), 1998).select("zone_id", "zone_name", "indicator", "value")


@query(
    "summary",
    tables_sql("product_values")
    + """SELECT COUNT(*) AS n_rows, MIN(year) AS year_first, MAX(year) AS year_last, COUNT(DISTINCT year) AS n_years,
    ROUND(SUM(CASE WHEN year=(SELECT MAX(year) FROM product_values) THEN value/1e6 END),3) AS latest_total,
    ROUND(MAX(value/1e6),3) AS max_value, COUNT(DISTINCT zone_id) AS n_zones FROM product_values""",
)
def summary(spark, sf_dir):
    return analytics.summary(analytics.with_units(finished(spark, sf_dir)), "value_display")


@query(
    "top_latest",
    tables_sql("product_values")
    + """SELECT zone_id, zone_name, indicator, value FROM product_values WHERE year=(SELECT MAX(year) FROM product_values)
    ORDER BY value DESC, zone_id, indicator LIMIT 10""",
)
def top_latest(spark, sf_dir):
    return analytics.top_latest(finished(spark, sf_dir))


@query(
    "annual_totals",
    tables_sql("product_values") + "SELECT year, ROUND(SUM(value)/1e6,3) AS total_km2 FROM product_values GROUP BY 1",
)
def annual_totals(spark, sf_dir):
    totals = analytics.annual_totals(finished(spark, sf_dir))
    return totals.select("year", F.round(F.col("total") / 1e6, 3).alias("total_km2"))


@query(
    "top_series",
    tables_sql("product_values")
    + """, ranked AS (SELECT zone_id, ROW_NUMBER() OVER (ORDER BY SUM(value) DESC, zone_id) AS r FROM product_values
     WHERE year=(SELECT MAX(year) FROM product_values) GROUP BY 1)
    SELECT year, ROUND(SUM(CASE WHEN r=1 THEN value END),2) AS top_1, ROUND(SUM(CASE WHEN r=2 THEN value END),2) AS top_2,
    ROUND(SUM(CASE WHEN r=3 THEN value END),2) AS top_3, ROUND(SUM(CASE WHEN r=4 THEN value END),2) AS top_4,
    ROUND(SUM(CASE WHEN r=5 THEN value END),2) AS top_5 FROM product_values p JOIN ranked k ON k.zone_id=p.zone_id AND k.r<=5
    GROUP BY 1""",
)
def top_series(spark, sf_dir):
    series = analytics.top_series(finished(spark, sf_dir), 5)
    return series.select("year", *(F.round(f"top_{i}", 2).alias(f"top_{i}") for i in range(1, 6)))


def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["zone_id", "year", "indicator"]
    return analytics.compare_versions(
        finished(spark, sf_dir), inputs.product_values(spark, sf_dir, discounted=True), keys
    )


_COMPARED_SQL = tables_sql("product_values", "product_values_2") + """, compared AS (
    SELECT a.zone_id, a.year, a.indicator, ROUND(a.value/1e6,3) AS value_a, ROUND(b.value/1e6,3) AS value_b,
    ROUND(b.value/1e6-a.value/1e6,3) AS diff, ROUND(b.value/1e6-a.value/1e6,3)/NULLIF(ROUND(a.value/1e6,3),0) AS rel_diff
    FROM product_values a JOIN product_values_2 b ON a.zone_id=b.zone_id AND a.year=b.year AND a.indicator=b.indicator
    WHERE a.value<>0 AND b.value<>0)
    """


@query("compare_versions", _COMPARED_SQL + "SELECT * FROM compared")
def compare_versions(spark, sf_dir):
    return compared(spark, sf_dir)


@query(
    "top_diff",
    _COMPARED_SQL
    + "SELECT zone_id, year, indicator, rel_diff FROM compared ORDER BY rel_diff DESC NULLS LAST, zone_id, year, indicator LIMIT 5",
)
def top_diff(spark, sf_dir):
    top = analytics.top_diff(compared(spark, sf_dir), "rel_diff", 5, ("zone_id", "year", "indicator"))
    return top.select("zone_id", "year", "indicator", "rel_diff")
