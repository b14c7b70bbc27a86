"""Exact geometry tests over Arrow batches: the rows of a group against the shapes of that group.

``tested`` streams partitions sorted by group, shapes before rows. It holds the shapes of one group and
one batch of rows, so a group may have any number of rows. The tests are those of
``functions/geometry.py`` (``covers`` and ``intersects``), on arrays of doubles.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

#: Elements of one block of a test's matrix.
BLOCK = 1 << 20
#: Edges of an outline from which on only those near a strip of rows are looked at, and rows of a strip.
LONG, STRIP = 256, 64
#: Rows of one batch that is put out.
ROWS = 1 << 16


def flat_edges(edges: str) -> str:
    """An edge list as array<double>: x1, y1, x2, y2 of each edge."""
    return f"flatten(transform({edges}, e -> array(e.x1, e.y1, e.x2, e.y2)))"


def tuples(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of doubles as rows of ``width``, and the offsets of each list's rows."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False) // width
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
    return values, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def _any(flags: np.ndarray, offsets: np.ndarray, axis: int) -> np.ndarray:
    """Whether any flag of each owner is set; an owner without flags has none."""
    shape = list(flags.shape)
    shape[axis] = len(offsets) - 1
    full = np.flatnonzero(np.diff(offsets))
    out = np.zeros(shape, bool)
    if len(full):
        found = np.logical_or.reduceat(flags, offsets[:-1][full], axis=axis)
        out[(slice(None),) * axis + (full,)] = found
    return out


def _turn(e: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (e[:, 2] - e[:, 0]) * (y - e[:, 1]) - (x - e[:, 0]) * (e[:, 3] - e[:, 1])


def covered(x: np.ndarray, y: np.ndarray, edges: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(points, owners): whether the upward edges of an owner hold a point, boundary included."""
    x, y = x[:, None], y[:, None]
    turn = _turn(edges, x, y)
    low, high = np.minimum(edges[:, 0], edges[:, 2]), np.maximum(edges[:, 0], edges[:, 2])
    beside = (y >= edges[:, 1]) & (y <= edges[:, 3])
    on = beside & (turn == 0) & (x >= low) & (x <= high)
    passed = beside & (y < edges[:, 3]) & (turn > 0)
    odd = np.zeros((len(x), len(offsets) - 1), bool)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        odd[:, full] = np.logical_xor.reduceat(passed, offsets[:-1][full], axis=1)
    return odd | _any(on, offsets, 1)


class Outline:
    """The upward edges of a shape by their lower end, and the first vertices of its polygons."""

    def __init__(self, edges: np.ndarray, starts: np.ndarray):
        real = edges[~np.isnan(edges).any(axis=1)]
        self.edges = real[np.argsort(real[:, 1], kind="stable")]
        self.tallest = (real[:, 3] - real[:, 1]).max(initial=0)
        self.starts = starts

    def near(self, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of rows that span ``low`` to ``high``, with all edges whose own span meets one of theirs."""
        if not len(self.edges):
            return
        known = np.flatnonzero(~(np.isnan(low) | np.isnan(high)))
        if len(self.edges) > LONG:
            known = known[np.argsort(low[known], kind="stable")]
        step = STRIP if len(self.edges) > LONG else max(1, BLOCK // len(self.edges))
        for at in range(0, len(known), step):
            some = known[at : at + step]
            # a little lower, as heights and the difference are rounded
            lowest = low[some].min()
            least = lowest - self.tallest - 1e-12 * (abs(lowest) + self.tallest)
            first = np.searchsorted(self.edges[:, 1], least, "left")
            last = np.searchsorted(self.edges[:, 1], high[some].max(), "right")
            if last > first:
                yield some, self.edges[first:last]


def _meeting(p: np.ndarray, shape: Outline) -> np.ndarray:
    """(edges p): whether each shares a point with an edge of the shape."""
    out = np.zeros(len(p), bool)
    for some, q in shape.near(p[:, 1], p[:, 3]):
        x1, y1, x2, y2 = p[some].T[:, :, None]
        near = (y1 <= q[:, 3]) & (q[:, 1] <= y2)
        near &= np.minimum(x1, x2) <= np.maximum(q[:, 0], q[:, 2])
        near &= np.minimum(q[:, 0], q[:, 2]) <= np.maximum(x1, x2)
        i, j = np.nonzero(near)
        one, two = p[some[i]], q[j]
        crossed = _turn(two, one[:, 0], one[:, 1]) * _turn(two, one[:, 2], one[:, 3]) <= 0
        crossed &= _turn(one, two[:, 0], two[:, 1]) * _turn(one, two[:, 2], two[:, 3]) <= 0
        out[some[i[crossed]]] = True
    return out


def _held(starts: np.ndarray, offsets: np.ndarray, shape: Outline) -> np.ndarray:
    """(owners): whether a start of each lies in the shape."""
    out = np.zeros(len(starts), bool)
    for some, edges in shape.near(starts[:, 1], starts[:, 1]):
        out[some] = covered(starts[some, 0], starts[some, 1], edges, np.array([0, len(edges)]))[:, 0]
    return _any(out, offsets, 0)


def intersecting(
    edges: np.ndarray, offsets: np.ndarray, starts: np.ndarray, starting: np.ndarray, shape: Outline
) -> np.ndarray:
    """(owners): whether the shape of each shares a point with the one given."""
    found = _any(_meeting(edges, shape), offsets, 0)
    found |= _held(starts, starting, shape)
    # those that hold a start of the shape; one owner's edges stand together
    for x, y in shape.starts:
        for at in range(0, len(offsets) - 1, ROWS):
            own = offsets[at : at + ROWS + 1]
            part = covered(np.array([x]), np.array([y]), edges[own[0] : own[-1]], own - own[0])
            found[at : at + ROWS] |= part[0]
    return found


def _take(rows: pa.StructArray, shapes: pa.StructArray, i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in (*rows.type, *shapes.type)]
    for at in range(0, len(i), ROWS):
        one, two = pa.array(i[at : at + ROWS]), pa.array(j[at : at + ROWS])
        columns = [c.take(one) for c in rows.flatten()] + [c.take(two) for c in shapes.flatten()]
        yield pa.RecordBatch.from_arrays(columns, names=names)


class PointTest:
    """Points of a cell against the cell rows of its zones; no edge list: the whole cell is inside."""

    def __init__(self, shapes: pa.RecordBatch):
        listed = shapes.column("__edges")
        self.zones = shapes.column("__z")
        crossed = pc.is_valid(listed).to_numpy(zero_copy_only=False)
        self.whole, self.crossed = np.flatnonzero(~crossed), np.flatnonzero(crossed)
        self.edges, self.offsets = tuples(listed.filter(pa.array(crossed)), 4)

    def __call__(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        points = rows.column("__p")
        x, y = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("__x", "__y"))
        step = max(1, BLOCK // max(1, len(self.edges), len(self.zones)))
        for at in range(0, len(x), step):
            part = slice(at, at + step)
            i, j = np.nonzero(covered(x[part], y[part], self.edges, self.offsets))
            n = len(x[part])
            first = np.concatenate([i, np.tile(np.arange(n), len(self.whole))]) + at
            second = np.concatenate([self.crossed[j], np.repeat(self.whole, n)])
            yield from _take(points, self.zones, first, second)


class Shapes:
    """The shapes of a group: batches in memory, and in files of the task's own what goes beyond ``limit`` bytes."""

    def __init__(self, limit: int | None):
        self.limit, self.batches, self.bytes, self.files = limit, [], 0, []

    def add(self, part: pa.RecordBatch) -> None:
        self.batches.append(part)
        self.bytes += part.nbytes
        if self.limit is not None and self.bytes > self.limit:
            self.files.append(tempfile.NamedTemporaryFile(prefix="shapes-"))
            with pa.ipc.new_file(self.files[-1].name, part.schema) as out:
                out.write_batch(pa.concat_batches(self.batches))
            self.batches, self.bytes = [], 0

    def parts(self) -> Iterator[pa.RecordBatch]:
        for file in self.files:
            yield pa.ipc.open_file(pa.memory_map(file.name)).get_batch(0)
        if self.batches:
            yield pa.concat_batches(self.batches)

    def close(self) -> None:
        for file in self.files:
            file.close()


def _run(groups: list[str], test: Callable, held: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, shapes, ready = None, Shapes(held), None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in (*groups, "__side")])
            first = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
            for start, end in zip(first.tolist(), [*first[1:].tolist(), batch.num_rows]):
                part = batch.slice(start, end - start)
                own = tuple(key[:-1, start].tolist())
                if key[-1, start] == 0:
                    if own != group:
                        shapes.close()
                        shapes = Shapes(held)
                    shapes.add(part)
                    group, ready = own, None
                elif own == group:
                    ready = ready or test(next(shapes.parts()) if held is None else shapes)
                    yield from ready(part)
        shapes.close()

    return run


def tested(
    rows: DataFrame,
    shapes: DataFrame,
    groups: list[str],
    test: Callable,
    schema,
    order: list[str] | None = None,
    held: int | None = None,
) -> DataFrame:
    """What ``test`` gives for the rows and shapes of each group.

    Both sides have the integer columns ``groups``; rows a struct ``__p``, shapes a struct ``__z``, and
    what the test reads. A batch gives the columns of ``__p`` and ``__z`` side by side. The rows of a
    group come by ``order``. With ``held`` the test gets the shapes of a group as ``Shapes``, of which so
    many bytes are held in memory.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = shapes.withColumn("__side", F.lit(0)).unionByName(
        rows.withColumn("__side", F.lit(1)), allowMissingColumns=True
    )
    return (
        both.repartition(parts, *groups)
        .sortWithinPartitions(*groups, "__side", *(order or []))
        .mapInArrow(_run(groups, test, held), schema)
    )
