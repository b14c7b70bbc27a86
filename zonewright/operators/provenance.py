"""Provenance records, run tables and the step log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from zonewright.functions.checks import require_each

# The data formats a record may name.
DATA_FORMATS = ["stac-geoparquet", "geoparquet", "parquet"]

PROVENANCE_SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType() if name == "dataSize" else T.StringType())
        for name in (
            "id", "dataType", "dataEtag", "dataSize", "dataUrl", "description", "imageCode",
            "imageTag", "provenanceUrl", "provenanceUpdated", "workflowDag", "workflowDagSimple",
            "sourceUrl", "sourceMetadataUrl", "geometriesRunId", "productRunId",
        )
    ]
)

STEP_SCHEMA = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("command", T.StringType()),
        T.StructField("inputs", T.StringType()),
        T.StructField("outputs", T.StringType()),
        T.StructField("completed_at", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("order", T.LongType()),
    ]
)


def file_info(spark: SparkSession, root: str) -> DataFrame:
    """path, size, tag, modified of all files below ``root``; contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )
    tag = F.sha1(F.concat_ws("|", "path", "size", F.unix_micros("modified")))
    return listed.withColumn("tag", tag)


def provenance_rows(
    info: DataFrame,
    run_time: str,
    image_code: str,
    image_tag: str,
    description: str = "",
    extra: dict[str, str] | None = None,
    workflow_dag: Column | str | None = None,
    workflow_dag_simple: Column | str | None = None,
) -> DataFrame:
    """A record per data file of ``info(id, data_type, data_url, path, size, tag[, source_url]
    [, source_metadata_url])``.

    A format outside the supported list fails the job. Without a source address
    the data address stands in for it. The workflow is JSON text, or a column of it such as
    ``workflow_steps`` of the step log; text that is not JSON fails the job. A record without a workflow
    or metadata address has nulls there, and its document lacks them.
    """
    kind = F.col("data_type")
    checked = require_each(
        info, kind.isin(DATA_FORMATS), F.concat(F.lit("unsupported data type: "), kind)
    )
    data_url = F.col("data_url")

    def optional(name: str) -> Column:
        return F.col(name) if name in info.columns else F.lit(None).cast("string")

    def workflow(value: Column | str | None) -> Column:
        text = value if isinstance(value, Column) else F.lit(value).cast("string")
        return F.to_json(F.parse_json(text))

    return checked.select(
        "id",
        kind.alias("dataType"),
        F.replace(F.col("tag"), F.lit('"'), F.lit("")).alias("dataEtag"),
        F.col("size").alias("dataSize"),
        data_url.alias("dataUrl"),
        F.lit(description).alias("description"),
        F.lit(image_code).alias("imageCode"),
        F.lit(image_tag).alias("imageTag"),
        F.concat("path", F.lit(".provenance.json")).alias("provenanceUrl"),
        F.lit(run_time).alias("provenanceUpdated"),
        workflow(workflow_dag).alias("workflowDag"),
        workflow(workflow_dag_simple).alias("workflowDagSimple"),
        F.coalesce(optional("source_url"), data_url).alias("sourceUrl"),
        optional("source_metadata_url").alias("sourceMetadataUrl"),
        *(F.lit(v).alias(k) for k, v in (extra or {}).items()),
    )


def workflow_steps(log: DataFrame) -> Column:
    """The steps of a log in order, as JSON text for ``provenance_rows``; null for an empty log.

    A log has a row per command someone ran, so it fits one value.
    """
    names = [c for c in STEP_SCHEMA.names if c in log.columns and c != "order"]
    listed = F.sort_array(F.collect_list(F.struct("order", F.struct(*names).alias("step"))))
    steps = F.to_json(F.transform(listed, lambda s: s["step"]))
    return log.agg(F.when(F.count("*") > 0, steps).alias("steps")).scalar()


def provenance_documents(records: DataFrame) -> DataFrame:
    """(provenanceUrl, value): each record as one line of JSON, its workflow nested, nulls left out."""
    fields = [
        F.parse_json(c).alias(c) if c in ("workflowDag", "workflowDagSimple") else F.col(c)
        for c in records.columns
    ]
    return records.select("provenanceUrl", F.to_json(F.struct(*fields)).alias("value"))


def read_provenance(
    spark: SparkSession, root: str, pattern: str = "*.provenance.json", lines: bool = False
) -> DataFrame:
    """All provenance documents below ``root`` as a table of runs, one per file or with ``lines`` one a line."""
    return (
        spark.read.schema(PROVENANCE_SCHEMA)
        .option("multiLine", not lines)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .json(root)
    )


def append_step(log: DataFrame | None, step: DataFrame) -> DataFrame:
    """The step rows numbered after the log's highest order, ready to append.

    ``step`` carries its own ``position`` (0, 1, ..) within the batch.
    """
    start = F.lit(0).cast("long")
    if log is not None:
        start = F.coalesce(log.agg((F.max("order") + 1).alias("n")).scalar(), start)
    return step.withColumn("order", start + F.col("position")).drop("position")


def read_steps(spark: SparkSession, root: str) -> DataFrame:
    """Step documents below ``root`` in order; damaged documents are skipped."""
    return (
        spark.read.schema(T.StructType([*STEP_SCHEMA.fields, T.StructField("_bad", T.StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .option("recursiveFileLookup", True)
        .json(root)
        .filter(F.col("_bad").isNull() & F.col("order").isNotNull())
        .drop("_bad")
        .orderBy("order")
    )


def run_payloads(runs: DataFrame, kind: str) -> DataFrame:
    """Run records as payload rows: ids renamed by kind, full record nested.

    A zone or product record's id becomes its owner's id, and its run id, where
    there is one, becomes the id.
    """
    # Owner column and run column of each kind.
    columns = {
        "dataset": ("datasetId", None),
        "geometry": ("geometriesId", "geometriesRunId"),
        "product": ("productId", "productRunId"),
    }
    if kind not in columns:
        raise ValueError(f"kind must be one of {list(columns)}")
    owner, run = columns[kind]
    renamed = runs.withColumnsRenamed({"id": owner} if run not in runs.columns else {"id": owner, run: "id"})
    dropped = ("sourceUrl", "sourceMetadataUrl", "provenanceUpdated")
    return renamed.select(
        *(c for c in renamed.columns if c not in dropped),
        F.struct(*renamed.columns).alias("provenanceJson"),
    )
