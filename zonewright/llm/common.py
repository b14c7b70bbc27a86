"""Stored intermediates, measured broadcasts and small column helpers of this subpackage."""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.session import scratch_path

#: A side is broadcast up to so many rows and stored bytes; beyond, both sides are shuffled.
BROADCAST_ROWS = 400_000
BROADCAST_BYTES = 16 << 20


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Stored bytes below ``path``, from the file system's own summary."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(hadoop).getLength()


def measured(
    df: DataFrame,
    name: str,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``df`` stored, and marked for broadcast only if its measured size allows it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    if path_bytes(spark, path) <= max_bytes and kept.count() <= max_rows:
        return F.broadcast(kept)
    return kept


def text_bytes(column: Column) -> Column:
    """UTF-8 bytes of a text, empty for null."""
    return F.coalesce(column.cast("string"), F.lit("")).cast("binary")


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose ``column`` holds about ``limit`` bytes, one row at least.

    Keeps the arrays that a task derives from a batch small, however long the texts are.
    """
    import numpy as np

    lengths = np.asarray(
        pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64
    )
    start, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def carries(*used: str) -> Callable:
    """An operator that carries the other columns of its first table through unread.

    ``used`` names its parameters that hold column names. All other columns travel under names
    that no operator uses and come back as they were, unless the result has one of the same name.
    """

    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        signature = inspect.signature(operator)
        table = next(iter(signature.parameters))

        @functools.wraps(operator)
        def run(*args, **kwargs) -> DataFrame:
            call = signature.bind(*args, **kwargs)
            call.apply_defaults()
            df = call.arguments[table]
            read = {call.arguments[name] for name in used}
            aside = {f"carried__{c}": c for c in df.columns if c not in read}
            call.arguments[table] = df.withColumnsRenamed({c: a for a, c in aside.items()})
            out = operator(*call.args, **call.kwargs)
            made = set(out.columns)
            replaced = [a for a, c in aside.items() if c in made]
            return out.drop(*replaced).withColumnsRenamed(
                {a: c for a, c in aside.items() if c not in made}
            )

        return run

    return wrap
