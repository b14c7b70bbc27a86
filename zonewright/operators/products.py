"""Product rows, output documents, consolidation and payload tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from zonewright.functions import geometry as g
from zonewright.functions import text
from zonewright.functions.checks import require_each, require_rows
from zonewright.functions.wkb import to_wkb

OUTPUT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("productId", T.StringType()),
        T.StructField("productRunId", T.StringType()),
        T.StructField("geometryOutputId", T.StringType()),
        T.StructField("timePoint", T.StringType()),
        T.StructField("indicators", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("geometryProvenanceUrl", T.StringType()),
                    T.StructField("datasetProvenanceUrl", T.StringType()),
                    T.StructField("command", T.StringType()),
                ]
            ),
        ),
    ]
)


def with_uuid5(
    df: DataFrame, columns: list[str], namespace=uuid.NAMESPACE_URL, name: str = "id"
) -> DataFrame:
    """Deterministic id of the columns' concatenated text.

    Pass the namespace of an existing deployment to reproduce its ids.
    """
    joined = F.concat(*(F.col(c).cast("string") for c in columns))
    return df.withColumn(name, text.uuid5(joined, namespace))


def with_time_point(df: DataFrame, column: str, name: str = "timePoint") -> DataFrame:
    return df.withColumn(name, text.time_point(F.col(column).cast("string")))


def product_outputs(
    results: DataFrame,
    product_id: str,
    run_id: str,
    zones_url: str,
    dataset_url: str,
    command: str,
    namespace=uuid.NAMESPACE_URL,
    time: str = "year",
) -> DataFrame:
    """Output documents of (zone_id, time, indicators) rows.

    The id is made of product, zone and both provenance addresses; years share
    it, so rows are keyed by (id, timePoint).
    """
    name = F.concat_ws(
        "-", F.lit(product_id), F.col("zone_id").cast("string"), F.lit(zones_url), F.lit(dataset_url)
    )
    return results.select(
        text.uuid5(name, namespace).alias("id"),
        F.lit(product_id).alias("productId"),
        F.lit(run_id).alias("productRunId"),
        F.col("zone_id").cast("string").alias("geometryOutputId"),
        text.time_point(F.col(time).cast("string")).alias("timePoint"),
        F.col("indicators"),
        F.struct(
            F.lit(zones_url).alias("geometryProvenanceUrl"),
            F.lit(dataset_url).alias("datasetProvenanceUrl"),
            F.lit(command).alias("command"),
        ).alias("metadata"),
    )


def output_paths(
    work: DataFrame,
    product_id: str,
    indicators: list[str],
    time: str = "year",
    zone_id: str = "zone_id",
) -> DataFrame:
    """Adds path, directory and file_name of each work row's document."""
    folder = indicators[0] if len(indicators) == 1 else "many-indicators"
    path = F.concat_ws(
        "/",
        F.lit(folder),
        F.col(time).cast("string"),
        F.concat(F.lit(f"{product_id}-"), F.col(zone_id).cast("string"), F.lit(".json")),
    )
    return split_path(work.withColumn("path", path))


def split_path(df: DataFrame, path: str = "path") -> DataFrame:
    """Adds ``directory`` (without trailing slashes) and ``file_name``."""
    file_name = F.substring_index(F.col(path), "/", -1)
    head = F.expr(f"left(`{path}`, length(`{path}`) - length(substring_index(`{path}`, '/', -1)))")
    return df.withColumns({"directory": F.rtrim(head, F.lit("/")), "file_name": file_name})


def consolidate(
    spark: SparkSession,
    root: str,
    product_id: str,
    zones_url: str | None = None,
    dataset_url: str | None = None,
) -> DataFrame:
    """All output documents below ``root``, less provenance files, checked.

    A document of another product, or made from other inputs than the given
    ones, fails the job; so does an empty folder.
    """
    documents = (
        spark.read.schema(OUTPUT_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(root)
        .select("*", F.col("_metadata.file_path").alias("_file"))
        .filter(~F.col("_file").endswith(".provenance.json"))
    )
    require_rows(documents, f"no product documents below {root}")
    right = F.col("productId") == product_id
    if zones_url is not None:
        right = right & (F.col("metadata.geometryProvenanceUrl") == zones_url)
    if dataset_url is not None:
        right = right & (F.col("metadata.datasetProvenanceUrl") == dataset_url)
    message = F.concat(F.lit("document of another product or input: "), F.col("_file"))
    return require_each(documents, right, message).drop("_file")


def run_summary(outputs: DataFrame) -> DataFrame:
    """One row: years, zones per year, and the command with placeholders.

    The command is that of the first output by (zone, time).
    """
    year = F.substring("timePoint", 1, 4)
    first = F.min_by(
        F.struct(F.col("metadata.command").alias("command"), "geometryOutputId", year.alias("year")),
        F.struct("geometryOutputId", "timePoint"),
    )
    totals = outputs.agg(
        F.sort_array(F.collect_set(year)).alias("years"),
        F.count("*").alias("n_outputs"),
        first.alias("_f"),
    )
    generic = F.replace(
        F.replace(F.col("_f.command"), F.col("_f.geometryOutputId"), F.lit("{geometry_id}")),
        F.col("_f.year"),
        F.lit("{datetime}"),
    )
    return totals.select(
        "years",
        F.size("years").alias("n_years"),
        F.floor(F.col("n_outputs") / F.nullif(F.size("years"), F.lit(0))).alias("zones_per_year"),
        generic.alias("command"),
    )


def outputs_by_indicator(outputs: DataFrame, n_slices: int = 16) -> DataFrame:
    """(indicator, timePoint, slice, outputs): the (zone, value) list of each group.

    Every group is spread over ``n_slices`` slices by a hash of the zone, whatever its
    size; slices without a zone have no row. Choose more for more zones.
    """
    flat = outputs.select(
        "timePoint", "geometryOutputId", F.explode("indicators").alias("indicator", "value")
    )
    return (
        flat.withColumn("slice", F.pmod(F.xxhash64("geometryOutputId"), F.lit(n_slices)))
        .groupBy("indicator", "timePoint", "slice")
        .agg(F.sort_array(F.collect_list(F.struct("geometryOutputId", "value"))).alias("outputs"))
    )


def product_payloads(outputs: DataFrame, run_id: str, n_slices: int = 16) -> DataFrame:
    """One payload per (indicator, time, slice)."""
    return outputs_by_indicator(outputs, n_slices).select(
        F.lit(run_id).alias("productRunId"),
        "timePoint",
        F.col("indicator").alias("indicatorId"),
        "slice",
        "outputs",
    )


def add_id_name(
    df: DataFrame,
    name_field: str,
    key: str,
    run_time: str,
    source_key: str,
    id_column: str = "zone_id",
    name_column: str = "zone_name",
    namespace=uuid.NAMESPACE_URL,
) -> DataFrame:
    """Adds id and name; a null or blank name fails the job.

    The id is made of key, run time and the row's own source key, so a rerun
    with the same parameters gives the same ids.
    """
    if name_field not in df.columns:
        raise ValueError(f"name field not found: {name_field}")
    named = F.col(name_field)
    message = F.concat(F.lit("null or blank name at "), F.col(source_key).cast("string"))
    unique = text.uuid5(F.concat(F.lit(key + run_time), F.col(source_key).cast("string")), namespace)
    checked = require_each(df, named.isNotNull() & (F.trim(named) != ""), message)
    return checked.withColumns({id_column: unique, name_column: named})


def duplicate_names(df: DataFrame, name_field: str) -> DataFrame:
    """Names used more than once, for the warning of ``add_id_name``."""
    return df.groupBy(name_field).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def geometry_outputs(
    df: DataFrame,
    id_column: str = "zone_id",
    name_column: str = "zone_name",
    geometry: str = "geometry",
    form: str = "wkt",
) -> DataFrame:
    """Payload rows of zones with a geometry; NaN attributes become null.

    ``form`` is ``wkt``, or ``wkb`` for base64 text of the extended binary form.
    """
    if form not in ("wkt", "wkb"):
        raise ValueError(f"unknown geometry form: {form}")
    written = (
        F.expr(g.to_wkt(f"`{geometry}`")) if form == "wkt" else F.base64(to_wkb(F.col(geometry)))
    )

    def clean(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        return value.alias(field.name)

    attributes = [clean(f) for f in df.schema.fields if f.name != geometry]
    description = F.col("description") if "description" in df.columns else F.lit("")
    metadata = F.col("metadata") if "metadata" in df.columns else F.lit("{}")
    return df.filter(F.col(geometry).isNotNull()).select(
        F.col(id_column).cast("string").alias("id"),
        written.alias("geometry"),
        F.col(name_column).alias("name"),
        description.alias("description"),
        metadata.alias("metadata"),
        F.to_json(F.struct(*attributes), {"ignoreNullFields": "false"}).alias("properties"),
    )


def batches(df: DataFrame, key: str, size: int | None = 50) -> DataFrame:
    """Adds ``batch``, counting from 1; without a positive size all rows are batch 1.

    Rows are numbered in the order of (md5 of the key, key) without sorting them
    in one task: rows are counted per 4-digit digest prefix (at most 65,536
    groups, evenly filled), the counts are summed up in that small table, and the
    rows of a prefix are numbered on their own.
    """
    if size is None or size <= 0:
        return df.withColumn("batch", F.lit(1).cast("long"))
    digest = F.md5(F.col(key).cast("string"))
    marked = df.withColumns({"_digest": digest, "_prefix": F.substring(digest, 1, 4)})
    counts = marked.groupBy("_prefix").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_prefix", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("_prefix").orderBy("_digest", key)
    numbered = marked.join(offsets, "_prefix").withColumn(
        "_row", F.col("_before") + F.row_number().over(within)
    )
    return numbered.withColumn("batch", F.floor((F.col("_row") - 1) / size) + 1).drop(
        "_digest", "_prefix", "_before", "_row"
    )


def batch_payloads(outputs: DataFrame, run_id: str, size: int = 50, key: str = "id") -> DataFrame:
    """One row per batch of at most ``size`` payload rows."""
    if size <= 0:
        raise ValueError("a payload needs a positive batch size")
    columns = [key, *(c for c in outputs.columns if c != key)]
    return (
        batches(outputs, key, size)
        .groupBy("batch")
        .agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("outputs"))
        .withColumn("geometriesRunId", F.lit(run_id))
    )
