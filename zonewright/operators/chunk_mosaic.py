"""Overlapping chunks of scenes merged array by array."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from zonewright.session import written

#: Chunk places that overlap are broadcast up to this many; beyond, chunks are shuffled by place.
BROADCAST_PLACES = 1_000_000


def _filled(values: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    """Cells of a chunk, and which of them hold a value."""
    cells = values.values
    return cells.to_numpy(zero_copy_only=False).astype(np.float64), np.asarray(cells.is_valid())


def _fold(place: list[str]):
    """Merges neighbouring rows of one place; the earlier row's valid cells win."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cells, valid = None, None, None

        def row() -> pa.RecordBatch:
            merged = pa.array([pa.array(cells, mask=~valid)], pa.list_(pa.float64()))
            columns = [pa.array([v], t) for v, t in zip(at, kinds)]
            return pa.RecordBatch.from_arrays([*columns, merged], names=[*place, "values"])

        for batch in batches:
            kinds = [batch.schema.field(n).type for n in place]
            keys = zip(*(batch.column(n).to_pylist() for n in place))
            for key, values in zip(keys, batch.column("values")):
                if key != at:
                    if at is not None:
                        yield row()
                    at, (cells, valid) = key, _filled(values)
                    cells = cells.copy()
                elif not valid.all():
                    later, has = _filled(values)
                    if len(later) != len(cells):
                        raise ValueError(f"chunks of unlike size at {key}")
                    fresh = has & ~valid
                    cells[fresh] = later[fresh]
                    valid = valid | has
        if at is not None:
            yield row()

    return run


def mosaic_chunks(chunks: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """One chunk per ``by`` and place: of each cell the first valid value in ``order``.

    ``chunks`` has ``by``, ``chunk_x``, ``chunk_y`` and ``values``. A place with a single chunk passes as it
    is and is never moved; only chunks that share a place are brought together, sorted and folded
    one after the other, so a task holds one merged chunk however many scenes overlap.
    """
    place = [*by, "chunk_x", "chunk_y"]
    kept = chunks.select(*place, *order, F.col("values").cast("array<double>").alias("values"))
    counts = kept.groupBy(*place).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    shared = written(counts, "shared-places")
    if shared.count() <= BROADCAST_PLACES:
        shared = F.broadcast(shared)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in place]
    names = shared.withColumnsRenamed({c: f"_{c}" for c in place})
    alone = kept.join(names, same, "left_anti").select(*place, "values")
    several = kept.join(names, same, "left_semi")
    schema = T.StructType([several.schema[c] for c in [*place, "values"]])
    folded = (
        several.repartition(*place)
        .sortWithinPartitions(*place, *order)
        .select(*place, "values")
        .mapInArrow(_fold(place), schema)
    )
    return alone.unionByName(folded)
