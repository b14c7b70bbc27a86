"""File listings and the bounds index of data files."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.functions import geometry as g
from zonewright.functions.checks import require_rows
from zonewright.operators.geometry import BOUNDS, bounds_to_polygons


def list_files(
    spark: SparkSession, root: str, pattern: str, prefix: str | None = None
) -> DataFrame:
    """path and size of the files below ``root`` whose path matches ``pattern`` somewhere."""
    start = root.rstrip("/") if prefix is None else f"{root.rstrip('/')}/{prefix.strip('/')}"
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(start)
        .select("path", F.col("length").alias("size"))
    )
    return listed.filter(F.col("path").rlike(pattern))


def file_diff(
    source: DataFrame, target: DataFrame, overwrite: bool, policy: str = "size"
) -> DataFrame:
    """Copy or skip per source file, on ``path`` and ``size``.

    ``size``: an existing target is skipped only when the size is equal, and with
    overwrite always copied. ``name``: an existing target is skipped, and with
    overwrite skipped only when the size is equal.
    """
    there = target.select("path", F.col("size").alias("_size"))
    same = F.coalesce(F.col("size") == F.col("_size"), F.lit(False))
    present = F.col("_size").isNotNull()
    if policy == "size":
        skip = F.lit(False) if overwrite else same
    elif policy == "name":
        skip = same if overwrite else present
    else:
        raise ValueError(f"unknown policy: {policy}")
    return (
        source.join(there, "path", "left")
        .withColumn("action", F.when(skip, "skip").otherwise("copy"))
        .drop("_size")
    )


def parse_partition_path(
    files: DataFrame, https_root: str, object_root: str, path: str = "path"
) -> DataFrame:
    """``country_iso=IDN/330.parquet`` -> country, cell and both addresses.

    Paths of another form, and those of the null country, are dropped.
    """
    # Fixed value: the form of a data file's path.
    form = r"^country_iso=(?!None/)([^/]+)/(.+)\.parquet$"
    return files.filter(F.col(path).rlike(form)).select(
        F.regexp_extract(path, form, 1).alias("country_code"),
        F.regexp_extract(path, form, 2).alias("s2_code"),
        F.concat(F.lit(https_root), F.col(path)).alias("url"),
        F.concat(F.lit(object_root), F.col(path)).alias("s3_url"),
    )


def _with_box(index: DataFrame) -> DataFrame:
    boxed = bounds_to_polygons(index)
    return boxed.withColumn("bbox_wkt", F.expr(g.to_wkt("geometry")))


def bbox_index(
    rows: DataFrame, keys: list[str], x: str = "lon", y: str = "lat"
) -> DataFrame:
    """Bounds per data file or partition by an ordinary aggregate over the rows."""
    bounds = rows.groupBy(*keys).agg(
        F.min(x).alias("minx"), F.min(y).alias("miny"), F.max(x).alias("maxx"), F.max(y).alias("maxy")
    )
    return _with_box(bounds)


def bbox_index_from_footers(
    files: DataFrame, url: str = "url", geometry: str = "geometry",
    x: str | None = None, y: str | None = None,
) -> DataFrame:
    """Bounds per Parquet file from its footer alone.

    Uses the file's geometry metadata, or, with ``x`` and ``y``, the row group
    statistics of two plain columns. Files are spread over the tasks, and a task
    opens one footer at a time.
    """
    import pyarrow as pa

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        def from_statistics(meta, column: str) -> tuple[float, float]:
            at = meta.schema.names.index(column)
            found = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
            return min(s.min for s in found), max(s.max for s in found)

        def bounds(address: str) -> tuple[float, float, float, float]:
            filesystem, path = pafs.FileSystem.from_uri(address)
            with filesystem.open_input_file(path) as source:
                meta = pq.read_metadata(source)
            if x is not None and y is not None:
                (x0, x1), (y0, y1) = from_statistics(meta, x), from_statistics(meta, y)
                return x0, y0, x1, y1
            described = json.loads(meta.metadata[b"geo"])
            return tuple(described["columns"][geometry]["bbox"])

        for batch in batches:
            urls = batch.column(0).to_pylist()
            found = [bounds(u) for u in urls]
            columns = [pa.array(urls, pa.string())]
            columns += [pa.array([b[i] for b in found], pa.float64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names=[url, *BOUNDS])

    schema = f"`{url}` string, minx double, miny double, maxx double, maxy double"
    footers = files.select(url).mapInArrow(read, schema)
    return _with_box(files.join(footers, url))


def indexed_files(files: DataFrame) -> DataFrame:
    """``files``, or an error when none was found."""
    return require_rows(files, "no data files found")
