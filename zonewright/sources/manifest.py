"""Product documents with a manifest: what exists, where, and which one counts.

Below a root stand ``documents`` (JSON lines) and ``manifest`` (Parquet), both in folders by a hash
bucket of the document's key: product, zone and time. A write appends its documents first and their
manifest rows after, so a run that breaks off leaves nothing that counts. Of several entries of a
key the one of the highest ``run`` counts. A write, and the question what is still to do, read only
the manifest buckets that their own keys fall into.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from zonewright.functions import text
from zonewright.functions.checks import require_none
from zonewright.operators.products import OUTPUT_SCHEMA, output_paths
from zonewright.session import written
from zonewright.sources.sinks import DOCUMENT_KEY, path_exists

#: Buckets of a new root; a root keeps the number it was made with.
BUCKETS = 64
_ENTRY = (
    "productId string, geometryOutputId string, timePoint string, path string, run bigint,"
    " write string, bucket int"
)


def _buckets(spark: SparkSession, root: str, buckets: int = BUCKETS) -> int:
    """The root's number of buckets; the first call fixes it."""
    place = f"{root.rstrip('/')}/layout"
    if not path_exists(spark, place):
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(place)
    return spark.read.parquet(place).first()["buckets"]


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(*DOCUMENT_KEY), F.lit(buckets)).cast("int"))


def _touched(df: DataFrame) -> list[int]:
    """Buckets of the rows: a short list, as there are only so many buckets."""
    return sorted(r["bucket"] for r in df.select("bucket").distinct().collect())


def manifest(spark: SparkSession, root: str, buckets: list[int] | None = None) -> DataFrame:
    """The entry that counts of each key; ``buckets`` limits the folders that are read."""
    place = f"{root.rstrip('/')}/manifest"
    if not path_exists(spark, place):
        return spark.createDataFrame([], _ENTRY)
    entries = spark.read.schema(_ENTRY).parquet(place)
    if buckets is not None:
        entries = entries.filter(F.col("bucket").isin(buckets))
    others = F.struct("path", "run", "write")
    return (
        entries.groupBy(*DOCUMENT_KEY, "bucket")
        .agg(F.max_by(others, F.struct("run", "write")).alias("_e"))
        .select(*DOCUMENT_KEY, "_e.path", "_e.run", "_e.write", "bucket")
    )


def _without(left: DataFrame, right: DataFrame) -> DataFrame:
    keys = right.select(*(F.col(c).alias(f"_{c}") for c in DOCUMENT_KEY))
    return left.join(keys, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in DOCUMENT_KEY], "left_anti")


def write_documents(
    outputs: DataFrame,
    root: str,
    indicators: list[str],
    run: int,
    overwrite: bool = False,
    time: Column | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Adds the documents of a run (see ``product_outputs``).

    ``time`` is the text that names the time in a path, by default the whole time point.

    A key that has an entry is left as it is, or with ``overwrite`` gets a new one that counts. A key
    given twice in one call fails the job and nothing is added.
    """
    spark = outputs.sparkSession
    root = root.rstrip("/")
    write = uuid.uuid4().hex
    name = F.concat_ws("/", *(F.coalesce(c, F.lit("null")) for c in DOCUMENT_KEY))
    twice = outputs.groupBy(*DOCUMENT_KEY).count().filter("count > 1").select(name)
    checked = require_none(outputs, twice, "documents given twice")
    placed = _bucketed(checked, _buckets(spark, root, buckets))
    batch = written(placed, "batch")
    fresh = batch if overwrite else _without(batch, manifest(spark, root, _touched(batch)))
    # the path of each document, as the work list names it
    paths = fresh.withColumns(
        {"_zone": F.col("geometryOutputId"), "_time": F.col("timePoint") if time is None else time, "write": F.lit(write)}
    )
    folder = indicators[0] if len(indicators) == 1 else "many-indicators"
    file = F.concat(F.col("productId"), F.lit("-"), F.col("_zone"), F.lit(".json"))
    fresh = written(
        paths.withColumn("path", F.concat_ws("/", F.lit(folder), "_time", file)).drop("_zone", "_time"),
        "fresh-documents",
    )
    spread = fresh.hint("rebalance", "bucket")
    documents = spread.select(*OUTPUT_SCHEMA.fieldNames(), "write", "bucket")
    documents.write.mode("append").partitionBy("bucket").json(f"{root}/documents")
    entries = spread.select(*DOCUMENT_KEY, "path", F.lit(run).cast("bigint").alias("run"), "write", "bucket")
    entries.write.mode("append").partitionBy("bucket").parquet(f"{root}/manifest")


def pending_documents(
    spark: SparkSession,
    work: DataFrame,
    root: str,
    product_id: str,
    indicators: list[str],
    time: str = "year",
    zone_id: str = "zone_id",
) -> DataFrame:
    """Work rows (zone, time) that have no document yet, with the paths they will have."""
    keyed = output_paths(work, product_id, indicators, time, zone_id).withColumns(
        {
            "productId": F.lit(product_id),
            "geometryOutputId": F.col(zone_id).cast("string"),
            "timePoint": text.time_point(F.col(time).cast("string")),
        }
    )
    placed = written(_bucketed(keyed, _buckets(spark, root)), "work")
    done = manifest(spark, root, _touched(placed))
    return _without(placed, done).drop(*DOCUMENT_KEY, "bucket")


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """The documents that count, with their ``path`` and ``run``."""
    schema = T.StructType([*OUTPUT_SCHEMA, T.StructField("write", T.StringType()), T.StructField("bucket", T.IntegerType())])
    documents = spark.read.schema(schema).json(f"{root.rstrip('/')}/documents")
    entries = manifest(spark, root)
    names = entries.withColumnsRenamed({c: f"_{c}" for c in (*DOCUMENT_KEY, "write", "bucket")})
    same = (F.col("bucket") == F.col("_bucket")) & (F.col("write") == F.col("_write"))
    for c in DOCUMENT_KEY:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return documents.join(names, same).select(
        *OUTPUT_SCHEMA.fieldNames(), "path", "run"
    )
