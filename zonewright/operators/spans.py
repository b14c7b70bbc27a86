"""Zones as spans of grid cells, and chunked rasters summed span by span.

A chunk is a block of ``size`` x ``size`` cells (see ``pixels_to_chunks``). Against a polygon it is
outside, inside or crossed. An inside chunk counts as a whole, an outside one is never joined.
In a crossed chunk the polygon is filled row by row: the crossings of an outline with the line of
cell centres, sorted, bound the runs of cells inside (even-odd rule). A run is contiguous in the
chunk's row-major values, so two entries of their running sums answer it, and no cell is ever
tested or even exploded. A cell whose centre lies on an outline is inside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from zonewright.functions import geometry as g
from zonewright.functions.rows import unnest
from zonewright.operators.joins import BROADCAST_BYTES, cover_cells, join_on_cells
from zonewright.session import stored, written

_SPAN = "array<struct<first:bigint,last:bigint>>"
_CHUNK = ("chunk_x", "chunk_y")
# Estimated bytes of a joined row beside its spans, and of a span.
_ROW_BYTES, _SPAN_BYTES = 128, 24


def _on_grid(pieces: DataFrame, keys: list[str], res: float, origin: tuple[float, float]) -> DataFrame:
    """Geometry in cells of the grid: cell (ix, iy) is the square from there to (ix+1, iy+1)."""
    x, y = (f"(v.{c} - {float(o)!r}D) / {float(res)!r}D" for c, o in zip("xy", origin))
    return pieces.select(*keys, F.expr(g.map_vertices("geometry", x, y)).alias("geometry"))


def _merged(spans: str) -> str:
    """Sorted spans of one row with those that overlap or touch made one."""
    joined = (
        "concat(slice(t, 1, size(t) - 1), array(named_struct('first', element_at(t, -1).first, "
        "'last', greatest(element_at(t, -1).last, s.last))))"
    )
    return (
        f"aggregate({spans}, cast(array() as {_SPAN}), (t, s) -> if(size(t) > 0 and "
        f"s.first <= element_at(t, -1).last + 1, {joined}, concat(t, array(s))))"
    )


def classify_chunks(
    pieces_m: DataFrame,
    keys: list[str],
    size: int,
    res: float,
    origin: tuple[float, float] = (0.0, 0.0),
) -> DataFrame:
    """(keys, chunk_x, chunk_y, edges): the chunks a piece meets; ``edges`` is null for inside ones.

    The edges are in cells of the grid. Chunks outside have no row.
    """
    cells = cover_cells(_on_grid(pieces_m, keys, res, origin), keys, size)
    return cells.select(
        *keys, F.col("cx").cast("long").alias("chunk_x"), F.col("cy").cast("long").alias("chunk_y"), "edges"
    )


def chunk_spans(
    pieces_m: DataFrame,
    keys: list[str],
    size: int,
    res: float,
    origin: tuple[float, float] = (0.0, 0.0),
) -> DataFrame:
    """(keys, chunk_x, chunk_y, spans): cells of each chunk inside each piece.

    ``spans`` is null for an inside chunk; else it holds half-open ranges of positions in the
    chunk's row-major values, in order and apart from each other.
    """
    chunk = [*keys, "chunk_x", "chunk_y"]
    classes = classify_chunks(pieces_m, keys, size, res, origin)
    # lines of cell centres are the integers after this shift
    at = {c: f"(e.{c} - 0.5D)" for c in ("x1", "y1", "x2", "y2")}
    low = f"greatest(bigint(ceil({at['y1']})), chunk_y * {size}L)"
    high = f"least(bigint(ceil({at['y2']})) - 1, (chunk_y + 1) * {size}L - 1)"
    slope = f"({at['x2']} - {at['x1']}) / ({at['y2']} - {at['y1']})"
    crossing = g.record(iy="r", a=f"{at['x1']} + (r - {at['y1']}) * {slope}", b="cast(null as double)")
    rows = f"transform(if({low} <= {high}, sequence({low}, {high}), cast(array() as array<bigint>)), r -> {crossing})"
    # the upper end of an edge, or a level edge, is on the outline but crosses no line
    level = f"if(e.y1 = e.y2, {at['x1']}, {at['x2']})"
    touch = g.record(
        iy=f"bigint({at['y2']})", a=f"least({level}, {at['x2']})", b=f"greatest({level}, {at['x2']})"
    )
    on_line = (
        f"{at['y2']} = floor({at['y2']}) AND {at['y2']} >= chunk_y * {size} AND {at['y2']} < (chunk_y + 1) * {size}"
    )
    marks = f"concat({rows}, if({on_line}, array({touch}), array()))"
    crossed = unnest(classes.filter(F.col("edges").isNotNull()), F.col("edges"), "e", chunk)
    # spread by chunk once; both groupings below keep that partitioning
    marked = unnest(crossed.repartition(*chunk), F.expr(marks), "_m", chunk)
    per_row = marked.groupBy(*chunk, F.col("_m.iy").alias("iy")).agg(
        F.sort_array(F.collect_list(F.when(F.col("_m.b").isNull(), F.col("_m.a")))).alias("_x"),
        F.collect_list(F.when(F.col("_m.b").isNotNull(), F.col("_m"))).alias("_touch"),
    )
    # edges left of the chunk are not listed: an odd number of crossings means it starts inside
    padded = "if(size(_x) % 2 = 1, concat(array(double('-infinity')), _x), _x)"
    left, right = f"chunk_x * {size}L", f"(chunk_x + 1) * {size}L - 1"

    def cut(a: str, b: str) -> str:
        return g.record(
            first=f"if({a} <= {left}, {left}, bigint(ceil(least({a}, {right} + 1D))))",
            last=f"if({b} >= {right}, {right}, bigint(floor(greatest({b}, {left} - 1D))))",
        )

    pairs = f"transform(if(size(_p) > 1, sequence(0, size(_p) div 2 - 1), cast(array() as array<int>)), i -> {cut('_p[2 * i]', '_p[2 * i + 1]')})"
    every = f"filter(concat({pairs}, transform(_touch, m -> {cut('m.a', 'm.b')})), s -> s.first <= s.last)"
    place = f"(iy - chunk_y * {size}) * {size} - chunk_x * {size}"
    local = f"transform({_merged('_s')}, s -> {g.record(first=f's.first + {place}', last=f's.last + {place}')})"
    ranges = (
        per_row.withColumn("_p", F.expr(padded))
        .withColumn("_s", F.expr(f"array_sort({every})"))
        .withColumn("_s", F.expr(local))
        .groupBy(*chunk)
        .agg(F.array_sort(F.flatten(F.collect_list("_s"))).alias("spans"))
        .filter(F.size("spans") > 0)
    )
    inside = classes.filter(F.col("edges").isNull()).select(*chunk, F.lit(None).cast(_SPAN).alias("spans"))
    return inside.unionByName(ranges)


def merge_spans(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Chunk spans of several pieces as those of their union; ``keys`` name it."""
    chunk = [*keys, "chunk_x", "chunk_y"]
    whole = F.max(F.col("spans").isNull()).alias("_whole")
    every = F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")
    # positions of neighbouring rows may touch; as ranges of positions they are one run
    return (
        spans.groupBy(*chunk)
        .agg(whole, every)
        .select(*chunk, F.when(~F.col("_whole"), F.expr(_merged("spans"))).alias("spans"))
    )


def running_sums(chunks: DataFrame, keys: list[str], values: list[float] | None = None) -> DataFrame:
    """Chunks with ``counts`` and ``totals``: running sums over their row-major values.

    Entry k is the number (the total) of the matching cells before position k. Null cells, and cells that
    hold no number, do not match; ``values`` limits the match to some values.
    """
    names = [*keys, "chunk_x", "chunk_y"]
    kept = chunks.select(*names, F.col("values").cast("array<double>").alias("values"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, totals = [], []
            for row in batch.column("values"):
                cells = row.values.to_numpy(zero_copy_only=False) if row.is_valid else np.zeros(0)
                match = ~np.isnan(cells) if values is None else np.isin(cells, values)
                counts.append(np.concatenate([[0], np.cumsum(match)]))
                totals.append(np.concatenate([[0.0], np.cumsum(np.where(match, cells, 0.0))]))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in names),
                    pa.array(counts, pa.list_(pa.int64())),
                    pa.array(totals, pa.list_(pa.float64())),
                ],
                names=[*names, "counts", "totals"],
            )

    made = kept.drop("values").withColumns(
        {"counts": F.array().cast("array<bigint>"), "totals": F.array().cast("array<double>")}
    )
    return kept.mapInArrow(run, made.schema)


def _met(
    chunks: DataFrame, spans: DataFrame, broadcast_bytes: int
) -> tuple[DataFrame, DataFrame, bool]:
    """The chunks that some span lies on, the spans, and whether these are small enough to broadcast.

    The extent prunes row groups. A small span side also decides which chunks are read at all: as a
    semi join below everything else it prunes the partitions of a chunk table.
    """
    spans = stored(spans)
    measures = [F.sum(F.coalesce(F.size("spans"), F.lit(0)) * _SPAN_BYTES + _ROW_BYTES).alias("size")]
    for c in ("chunk_x", "chunk_y"):
        measures += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    found = spans.agg(*measures).first()
    if not found["size"]:
        return chunks.filter("false"), spans, True
    for c in ("chunk_x", "chunk_y"):
        extent = F.col(c).between(found[f"min_{c}"], found[f"max_{c}"])
        chunks, spans = chunks.filter(extent), spans.filter(extent)
    small = found["size"] <= broadcast_bytes
    if small:
        listed = written(spans.select(*_CHUNK).distinct(), "met-chunks").filter(extent)
        chunks = chunks.join(F.broadcast(listed), ["chunk_x", "chunk_y"], "left_semi")
    return chunks, spans, small


def _over(sums: str) -> Column:
    part = f"t + {sums}[int(s.last) + 1] - {sums}[int(s.first)]"
    zero = "0L" if sums == "counts" else "0D"
    return F.expr(f"if(spans IS NULL, element_at({sums}, -1), aggregate(spans, {zero}, (t, s) -> {part}))")


def zonal_sums(
    chunks: DataFrame,
    pieces_m: DataFrame,
    keys: list[str],
    by: list[str],
    size: int,
    res: float,
    origin: tuple[float, float] = (0.0, 0.0),
    values: list[float] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Number ``n`` and ``total`` of the matching cells per piece and ``by``."""
    spans = chunk_spans(pieces_m, keys, size, res, origin)
    chunks, spans, small = _met(chunks, spans, broadcast_bytes)
    sums = running_sums(chunks, by, values)
    if not small:
        # counted for hot chunks, then joined: the second reading finds the sums stored
        sums = written(sums, "chunk-sums")
    joined = join_on_cells(sums, spans, [*by, "chunk_x", "chunk_y"], small, _CHUNK)
    return (
        joined.select(*keys, *by, _over("counts").alias("n"), _over("totals").alias("total"))
        .filter("n > 0")
        .groupBy(*keys, *by)
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )


def sum_area_spans(
    chunks: DataFrame,
    pieces_m: DataFrame,
    cell_area_m2: float,
    piece: list[str],
    by: list[str],
    size: int,
    res: float,
    origin: tuple[float, float] = (0.0, 0.0),
    values: list[float] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Area of matching cells per zone: 2 decimals per piece, then summed, as ``sum_area_raster``."""
    counts = zonal_sums(chunks, pieces_m, piece, by, size, res, origin, values, broadcast_bytes)
    return (
        counts.withColumn("_m", F.round(F.col("n") * cell_area_m2, 2))
        .groupBy("zone_id", *by)
        .agg(F.sum("_m").alias("area_m2"))
    )


def zonal_mean_spans(
    chunks: DataFrame,
    pieces_m: DataFrame,
    by: list[str],
    size: int,
    res: float,
    origin: tuple[float, float] = (0.0, 0.0),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Mean cell value per zone, null for a zone without a cell, as ``zonal_mean`` without ``by``.

    Cells count once per piece that holds them.
    """
    piece = [c for c in pieces_m.columns if c != "geometry"]
    sums = zonal_sums(chunks, pieces_m, piece, by, size, res, origin, None, broadcast_bytes)
    means = sums.groupBy("zone_id").agg((F.sum("total") / F.sum("n")).alias("mean_value"))
    return pieces_m.select("zone_id").distinct().join(means, "zone_id", "left")


def mask_chunks(
    chunks: DataFrame,
    pieces_m: DataFrame,
    zone_keys: list[str],
    by: list[str],
    size: int,
    res: float,
    origin: tuple[float, float] = (0.0, 0.0),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Cells inside any piece of a zone, once per zone: (zone, by, ix, iy, value), null cells left out.

    The spans of a zone's pieces are merged before, so no cell has to be made distinct after.
    """
    piece = [c for c in pieces_m.columns if c != "geometry"]
    spans = merge_spans(chunk_spans(pieces_m, piece, size, res, origin), zone_keys)
    kept = chunks.select(*by, "chunk_x", "chunk_y", "values")
    kept, spans, small = _met(kept, spans, broadcast_bytes)
    joined = join_on_cells(kept, spans, [*by, "chunk_x", "chunk_y"], small, _CHUNK)
    whole = f"array(named_struct('first', 0L, 'last', {size * size - 1}L))"
    runs = unnest(
        joined,
        F.expr(f"coalesce(spans, {whole})"),
        "_s",
        [*zone_keys, *by, "chunk_x", "chunk_y", "values"],
    )
    cut = F.expr("slice(values, int(_s.first) + 1, int(_s.last - _s.first) + 1)")
    cells = runs.select(
        *zone_keys, *by, "chunk_x", "chunk_y", "_s", F.posexplode_outer(cut).alias("_k", "value")
    ).filter(F.col("value").isNotNull())
    position = F.col("_s.first") + F.col("_k")
    return cells.select(
        *zone_keys,
        *by,
        (F.col("chunk_x") * size + position % size).alias("ix"),
        (F.col("chunk_y") * size + F.floor(position / size)).alias("iy"),
        "value",
    )
