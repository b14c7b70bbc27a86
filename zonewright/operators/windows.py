"""Polygons against polygons in the squares of a grid.

A feature lies in one square: that of its lower left corner, on the finest grid whose squares are no
smaller than it. The window of a square is what the features of the square can reach, so a zone
takes part in each window it meets, with its edges there and a few upright ones that stand for all
edges beyond the window's side. So each feature moves once and each zone once per window, whatever the
number of pairs, and all zones that meet a feature come together in one place.

Within a window, a raster of the zone tells which parts no edge passes: a feature there lies
wholly inside or outside. Only features near an edge are tested against edges.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from zonewright.operators import kernels
from zonewright.session import stored

#: Side of a square of the finest grid, in cells of the join.
SQUARE = 4
#: A square with more than 1 / (SHARES * shuffle partitions) of the features is dealt over salts.
SHARES = 2
#: Rows and columns of a raster, candidates from which on one is drawn, and rasters kept for a group.
RASTER, DRAWN, KEPT = 64, 32, 1024
#: Features placed and outlines cut at once; doubles and rows of one batch of windows that is put out.
_FEATURES, _OUTLINES, _VALUES, _ROWS = 1024, 128, 1 << 20, 1 << 14
#: Flags of keys and zones held at once.
_FLAGS = 1 << 26
#: Bytes of the zones of one window that are held in memory; more are read again for each batch of features.
HELD = 64 << 20
ON = ["__lv", "__cx", "__cy"]
_ENDS = ("minx", "miny", "maxx", "maxy")
_CUT = "__lv int, __cx int, __cy int, __box array<double>, __near int, __edges array<double>, __starts array<double>"


def squared(boxed: DataFrame, cell: float) -> DataFrame:
    """Rows with the level of their grid, their square and their width, from the bounds ``__whole``."""
    side = float(cell) * SQUARE
    minx, miny, maxx, maxy = (F.col(f"__whole.{c}") for c in _ENDS)
    sized = boxed.withColumn("__wide", F.greatest(maxx - minx, maxy - miny))
    level = F.when(F.col("__wide") > side, F.ceil(F.log2(F.col("__wide") / side))).otherwise(0)
    levelled = sized.withColumn("__lv", level.cast("int"))
    step = F.lit(side) * F.pow(F.lit(2.0), F.col("__lv"))
    return levelled.withColumns(
        {"__cx": F.floor(minx / step).cast("int"), "__cy": F.floor(miny / step).cast("int")}
    )


class Outlines:
    """Shapes of a batch: upward edges with their sign, first vertices of polygons, bounds.

    The sign is +1 where a line of latitude enters the shape, -1 where it leaves, whatever the
    direction of the rings: outer rings come first in a polygon, holes after.
    """

    def __init__(self, column: pa.Array, cell: float):
        def listed(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
            return lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)

        polygons, of_row = listed(column)
        rings, of_polygon = listed(polygons)
        vertices, of_ring = listed(rings)
        corners = [vertices.flatten()[vertices.type.get_field_index(c)] for c in "xy"]
        self.n = len(of_row)
        row = np.repeat(np.arange(self.n), of_row)
        row_of_ring = np.repeat(row, of_polygon)
        broken = [row[pc.is_null(polygons).to_numpy(zero_copy_only=False)]]
        broken.append(row_of_ring[pc.is_null(rings).to_numpy(zero_copy_only=False)])
        ends = np.cumsum(of_ring)
        ring_at = np.cumsum(of_polygon) - of_polygon
        self._bound(corners, np.repeat(row_of_ring, of_ring), np.concatenate(broken), cell)
        x, y = (v.to_numpy(zero_copy_only=False).astype(float) for v in corners)
        full = np.flatnonzero(of_polygon)
        full = full[of_ring[ring_at[full]] > 0]
        first = (ends - of_ring)[ring_at[full]]
        self.starts, self.at = np.stack([x[first], y[first]], axis=1), self._offsets(row[full])
        followed = np.ones(len(x), bool)
        followed[ends[of_ring > 0] - 1] = False
        i = np.flatnonzero(followed)
        ring = np.repeat(np.arange(len(of_ring)), of_ring)[i]
        x1, y1, x2, y2 = x[i], y[i], x[i + 1], y[i + 1]
        up = y1 <= y2
        ends = [np.where(up, x1, x2), np.where(up, y1, y2), np.where(up, x2, x1), np.where(up, y2, y1)]
        outer = np.zeros(len(of_ring), bool)
        outer[ring_at[of_polygon > 0]] = True
        sign = self._turns(ring, x1, y1, x2, y2)[ring] * np.where(outer[ring], 1, -1) * np.where(y1 < y2, -1, 1)
        self.edges, self.of = np.stack([*ends, sign], axis=1), self._offsets(row_of_ring[ring])

    def _offsets(self, owner: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=self.n))]).astype(np.int64)

    @staticmethod
    def _turns(ring: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> np.ndarray:
        own = np.flatnonzero(np.diff(ring, prepend=-1))
        turn = np.zeros(int(ring.max(initial=-1)) + 1)
        if len(own):
            k = np.repeat(own, np.diff(np.append(own, len(ring))))
            cross = (x1 - x1[k]) * (y2 - y1[k]) - (x2 - x1[k]) * (y1 - y1[k])
            turn[ring[own]] = np.nan_to_num(np.sign(np.add.reduceat(cross, own)))
        return turn

    def _bound(self, corners: list[pa.Array], row: np.ndarray, broken: np.ndarray, cell: float) -> None:
        """``box``, and whether it is whole: all parts given, finite, not too far out for numbered cells."""
        self.box = np.full((self.n, 4), np.nan)
        self.whole = np.ones(self.n, bool)
        self.whole[broken] = False
        for c, values in enumerate(corners):
            given = pc.is_valid(values).to_numpy(zero_copy_only=False)
            v, own = values.to_numpy(zero_copy_only=False).astype(float)[given], row[given]
            self.whole[own[~np.isfinite(v)]] = False
            at = np.flatnonzero(np.diff(own, prepend=-1))
            if len(at):
                self.box[own[at], c], self.box[own[at], c + 2] = np.minimum.reduceat(v, at), np.maximum.reduceat(v, at)
        with np.errstate(invalid="ignore"):
            number = np.floor(self.box / cell)
            self.whole &= ((number >= -(2.0**31)) & (number < 2.0**31)).all(axis=1)


def _place(cell: float, signed: bool, extra: list[str], whole: bool) -> Callable:
    """Features with bounds, in their squares; ``whole``: with their edges and starts."""
    width = 5 if signed else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(n, _FEATURES) for b in batches for n in range(0, b.num_rows, _FEATURES)):
            shapes = Outlines(batch.column("__shape"), cell)
            kept = np.flatnonzero(shapes.whole)
            box = shapes.box[kept]
            side = float(cell) * SQUARE
            wide = np.maximum(box[:, 2] - box[:, 0], box[:, 3] - box[:, 1])
            level = np.ceil(np.log2(np.maximum(wide / side, 1))).astype(np.int32)
            step = side * 2.0**level
            place = [level, *(np.floor(box[:, c] / step).astype(np.int32) for c in (0, 1))]
            columns = [batch.column(c).take(pa.array(kept)) for c in extra] + [pa.array(c) for c in (*place, wide)]
            names = [*extra, *ON, "__wide"]
            columns.append(_list(box, np.arange(len(kept) + 1)))
            names.append("__box")
            if whole:
                edges, of = of_rows(shapes.edges[:, :width], shapes.of, kept)
                starts, at = of_rows(shapes.starts, shapes.at, kept)
                columns += [_list(edges, of), _list(starts, at)]
                names += ["__edges", "__starts"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def of_rows(values: np.ndarray, offsets: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of some rows, and their offsets."""
    sizes = offsets[i + 1] - offsets[i]
    own = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return values[np.repeat(offsets[i] - own[:-1], sizes) + np.arange(own[-1])], own


def _list(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of ``values`` as lists of doubles."""
    flat = pa.array(np.ascontiguousarray(values, dtype=float).ravel())
    return pa.ListArray.from_arrays(pa.array((offsets * values.shape[1]).astype(np.int32)), flat)


def place(features: DataFrame, shape: Column, extra: list[Column], cell: float, signed: bool, whole: bool = True) -> DataFrame:
    """``extra`` of the features, with bounds, edges, starts, and the square they lie in; others are dropped."""
    given = features.select(*extra, shape.alias("__shape"))
    names = given.columns[:-1]
    made = "__lv int, __cx int, __cy int, __wide double, __box array<double>"
    made += ", __edges array<double>, __starts array<double>" if whole else ""
    schema = StructType([StructField(c, given.schema[c].dataType) for c in names] + list(StructType.fromDDL(made)))
    return given.mapInArrow(_place(cell, signed, names, whole), schema)


def _upright(far: np.ndarray, x: float, low: float, high: float, step: float, signed: bool) -> np.ndarray:
    """Upright edges at ``x`` that count as ``far`` does at each latitude from ``low`` to ``high``."""
    far = far[far[:, 1] < far[:, 3]]
    if not len(far):
        return np.zeros((0, 5))
    weight = far[:, 4] if signed else np.ones(len(far))
    y, w = np.concatenate([far[:, 1], far[:, 3]]), np.concatenate([weight, -weight])
    base = w[y <= low].sum()
    within = (y > low) & (y <= high)
    borders, at = np.unique(y[within], return_inverse=True)
    count = base + np.concatenate([[0], np.cumsum(np.bincount(at, w[within], len(borders)))])
    count = np.rint(count) if signed else np.rint(count) % 2
    changed = np.flatnonzero(np.diff(count))
    count = count[np.append(changed, len(count) - 1)]
    y = np.concatenate([[low - step], borders[changed], [high + step]])
    some = np.flatnonzero(count)
    out = np.empty((len(some), 5))
    out[:, 0] = out[:, 2] = x
    out[:, 1], out[:, 3], out[:, 4] = y[some], y[some + 1], count[some]
    return out


def _windows(
    edges: np.ndarray, starts: np.ndarray, box: np.ndarray, levels: list[tuple[int, float, float]], signed: bool
) -> Iterator[tuple[int, int, int, list[float], int, np.ndarray, np.ndarray]]:
    """A shape's windows: level, square, bounds of shape and window, edges (the near ones first), starts.

    Edges beyond the right side decide which points are inside; for shared areas those on the left do.
    """
    edges = edges[~np.isnan(edges[:, :4]).any(axis=1)]
    left, right = np.minimum(edges[:, 0], edges[:, 2]), np.maximum(edges[:, 0], edges[:, 2])
    minx, miny, maxx, maxy = box.tolist()
    for level, step, wide in levels:
        slack = step * 1e-9 + np.abs(box).max() * 1e-14
        columns = range(int((minx - wide - slack) // step), int((maxx + slack) // step) + 1)
        for cy in range(int((miny - wide - slack) // step), int((maxy + slack) // step) + 1):
            low, high = cy * step - slack, (cy + 1) * step + wide + slack
            band = np.flatnonzero((edges[:, 3] >= low) & (edges[:, 1] <= high))
            banded, lefts, rights = edges[band], left[band], right[band]
            rows = starts[(starts[:, 1] >= low) & (starts[:, 1] <= high)]
            for cx in columns:
                west, east = cx * step - slack, (cx + 1) * step + wide + slack
                near = banded[(lefts <= east) & (rights >= west)]
                if signed:
                    others = _upright(banded[rights < west], west - step, low, high, step, True)
                else:
                    others = _upright(banded[lefts > east], east + step, low, high, step, False)
                own = rows[(rows[:, 0] >= west) & (rows[:, 0] <= east)]
                if len(near) or len(others) or len(own):
                    both = np.concatenate([near, others])
                    yield level, cx, cy, [minx, miny, maxx, maxy, west, low, east, high], len(near), both, own


def _lists(values: list[np.ndarray]) -> pa.Array:
    sizes = [v.size for v in values]
    flat = np.concatenate([v.ravel() for v in values]) if values else np.zeros(0)
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(flat, pa.float64()))


def _cut(levels: list[tuple[int, float, float]], cell: float, signed: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(n, _OUTLINES) for b in batches for n in range(0, b.num_rows, _OUTLINES)):
            shapes = Outlines(batch.column("__shape"), cell)
            kept, rows, held = [], [], 0

            def packed() -> pa.RecordBatch:
                level, cx, cy, box, near, lines, points = zip(*rows)
                out = pa.RecordBatch.from_arrays(
                    [
                        batch.column("__z").take(pa.array(kept)),
                        *(pa.array(c, pa.int32()) for c in (level, cx, cy)),
                        _lists([np.array(b) for b in box]),
                        pa.array(near, pa.int32()),
                        # column by column, where the corners of an outline repeat and pack well
                        _lists([np.ascontiguousarray(e.T) for e in lines]),
                        _lists(list(points)),
                    ],
                    names=["__z", *ON, "__box", "__near", "__edges", "__starts"],
                )
                kept.clear()
                rows.clear()
                return out

            for k in np.flatnonzero(shapes.whole).tolist():
                edges = shapes.edges[shapes.of[k] : shapes.of[k + 1]]
                starts = shapes.starts[shapes.at[k] : shapes.at[k + 1]]
                for row in _windows(edges, starts, shapes.box[k], levels, signed):
                    kept.append(k)
                    rows.append(row)
                    held += row[5].size
                    if held > _VALUES or len(rows) >= _ROWS:
                        yield packed()
                        held = 0
            if rows:
                yield packed()

    return run


class Features:
    """The features of a batch: bounds, edges, starts."""

    def __init__(self, rows: pa.RecordBatch, width: int):
        self.edges, self.of = kernels.tuples(rows.column("__edges"), width)
        self.starts, self.at = kernels.tuples(rows.column("__starts"), 2)
        self.box = kernels.tuples(rows.column("__box"), 4)[0].T.copy()
        known = ~np.isnan(self.starts).any(axis=1)
        self.started = kernels._any(known, self.at, 0)
        self._area: np.ndarray | None = None

    def area(self) -> np.ndarray:
        """Area of each feature from its signed edges, positions being counted from its left bound on."""
        if self._area is None:
            owner = np.repeat(np.arange(len(self.of) - 1), np.diff(self.of))
            x1, y1, x2, y2, sign = self.edges.T
            strip = -sign * (y2 - y1) * ((x1 + x2) / 2 - self.box[0, owner])
            self._area = np.bincount(owner[y1 < y2], strip[y1 < y2], len(self.of) - 1)
        return self._area


class Raster:
    """Which cells of a window an edge passes, and how often the others are inside."""

    def __init__(self, frame: list[float], near: np.ndarray, edges: np.ndarray, starts: np.ndarray, signed: bool):
        self.x, self.y = frame[0], frame[1]
        self.dx, self.dy = (frame[2] - frame[0]) / RASTER, (frame[3] - frame[1]) / RASTER
        points = np.concatenate([starts, starts, np.zeros((len(starts), near.shape[1] - 4))], axis=1)
        passed = self._passed(np.concatenate([near, points]))
        self.sums = np.zeros((RASTER + 1, RASTER + 1), np.int16)
        self.sums[1:, 1:] = passed.cumsum(axis=0, dtype=np.int16).cumsum(axis=1, dtype=np.int16)
        self.inside = self._inside(edges, signed)

    def _spread(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each number from ``first`` to ``last``, with its owner."""
        sizes = np.maximum(last - first + 1, 0)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[owner]

    def _passed(self, e: np.ndarray) -> np.ndarray:
        m = 1e-6
        first = np.clip(np.floor((e[:, 1] - self.y) / self.dy - m), 0, RASTER).astype(np.int64)
        last = np.clip(np.floor((e[:, 3] - self.y) / self.dy + m), -1, RASTER - 1).astype(np.int64)
        k, r = self._spread(first, last)
        x1, y1, x2, y2 = e[k, 0], e[k, 1], e[k, 2], e[k, 3]
        high = np.where(y2 > y1, y2 - y1, 1)
        t0 = np.where(y2 > y1, np.clip((self.y + (r - m) * self.dy - y1) / high, 0, 1), 0)
        t1 = np.where(y2 > y1, np.clip((self.y + (r + 1 + m) * self.dy - y1) / high, 0, 1), 1)
        xa, xb = x1 + t0 * (x2 - x1), x1 + t1 * (x2 - x1)
        c0 = np.floor((np.minimum(xa, xb) - self.x) / self.dx - m)
        c1 = np.floor((np.maximum(xa, xb) - self.x) / self.dx + m)
        met = (c1 >= 0) & (c0 < RASTER)
        r, c0, c1 = r[met], np.clip(c0[met], 0, RASTER - 1).astype(np.int64), np.clip(c1[met], 0, RASTER - 1).astype(np.int64)
        size = RASTER + 1
        change = np.bincount(r * size + c0, minlength=RASTER * size) - np.bincount(r * size + c1 + 1, minlength=RASTER * size)
        return change.reshape(RASTER, size).cumsum(axis=1)[:, :RASTER] > 0

    def _inside(self, e: np.ndarray, signed: bool) -> np.ndarray:
        first = np.clip(np.ceil((e[:, 1] - self.y) / self.dy - 0.5), 0, RASTER).astype(np.int64)
        last = np.clip(np.ceil((e[:, 3] - self.y) / self.dy - 0.5), 0, RASTER).astype(np.int64) - 1
        k, r = self._spread(first, last)
        t = (self.y + (r + 0.5) * self.dy - e[k, 1]) / (e[k, 3] - e[k, 1])
        x = (e[k, 0] + t * (e[k, 2] - e[k, 0]) - self.x) / self.dx - 0.5
        size = RASTER + 1
        if signed:
            c, w = np.clip(np.floor(x) + 1, 0, RASTER).astype(np.int64), e[k, 4]
            change = np.bincount(r * size + c, w, RASTER * size)
            return np.rint(change.reshape(RASTER, size).cumsum(axis=1)[:, :RASTER]).astype(np.int32)
        c = np.clip(np.ceil(x), 0, RASTER).astype(np.int64)
        change = np.bincount(r * size, minlength=RASTER * size) - np.bincount(r * size + c, minlength=RASTER * size)
        return change.reshape(RASTER, size).cumsum(axis=1)[:, :RASTER] % 2

    def looked_up(self, box: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each bounds, whether no edge passes them, and how often they are inside if so."""
        c0, c1 = (np.clip((v - self.x) / self.dx, 0, RASTER - 1).astype(np.int64) for v in (box[0], box[2]))
        r0, r1 = (np.clip((v - self.y) / self.dy, 0, RASTER - 1).astype(np.int64) for v in (box[1], box[3]))
        s = self.sums
        passed = s[r1 + 1, c1 + 1] - s[r0, c1 + 1] - s[r1 + 1, c0] + s[r0, c0]
        return passed == 0, self.inside[r0, c0]


class Shape:
    """A zone in a window."""

    def __init__(self, box: np.ndarray, near: int, edges: np.ndarray, starts: np.ndarray, signed: bool):
        self.box, self.near, self.edges, self.starts, self.signed = box, near, edges, starts, signed
        # no edge in the window, and as often inside all over it
        self.even = (
            not near and not len(starts) and len(edges) == 1 and edges[0, 1] <= box[5] and edges[0, 3] >= box[7]
        )
        self.outline = kernels.Outline(edges[edges[:, 1] < edges[:, 3]] if signed else edges, starts)
        self.raster: Raster | None = None

    def met(self, box: np.ndarray) -> np.ndarray:
        """Numbers of the bounds that meet those of the zone."""
        minx, miny, maxx, maxy = self.box[:4]
        return np.flatnonzero((box[0] <= maxx) & (box[2] >= minx) & (box[1] <= maxy) & (box[3] >= miny))

    def free(self, box: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray] | None:
        """As ``Raster.looked_up``; none where looking is not worth a raster."""
        if self.even:
            return np.ones(box.shape[1], bool), np.full(box.shape[1], int(self.edges[0, 4]))
        raster = self.raster
        if raster is None:
            frame = [*np.maximum(self.box[:2], self.box[4:6]), *np.minimum(self.box[2:4], self.box[6:])]
            if box.shape[1] < DRAWN or frame[2] <= frame[0] or frame[3] <= frame[1]:
                return None
            raster = Raster(frame, self.edges[: self.near], self.edges, self.starts, self.signed)
            if keep:
                self.raster = raster
        return raster.looked_up(box)


class _Test:
    """Zones of a window against its features, batch by batch."""

    signed = False

    def __init__(self, shapes: kernels.Shapes, once: list[str] | None = None):
        self.shapes, self.once, self.loaded = shapes, once, None
        if once is not None:
            numbers: dict = {}
            self.number = []
            for part in shapes.parts():
                values = zip(*(part.column("__z").field(c).to_pylist() for c in once))
                self.number.append(np.array([numbers.setdefault(_plain(v), len(numbers)) for v in values], np.int64))
            self.zones = len(numbers)
            self.key, self.seen = None, np.zeros(0, np.int64)

    def parts(self) -> Iterator[tuple[pa.StructArray, list[Shape]]]:
        """The zones part by part, kept if they are one."""
        if self.loaded is not None:
            yield self.loaded
            return
        for part in self.shapes.parts():
            zones = part.column("__z"), self._shapes(part)
            if not self.shapes.files:
                self.loaded = zones
            yield zones

    def _shapes(self, part: pa.RecordBatch) -> list[Shape]:
        box = kernels.tuples(part.column("__box"), 8)[0]
        near = part.column("__near").to_numpy()
        edges, of = kernels.tuples(part.column("__edges"), 5)
        starts, at = kernels.tuples(part.column("__starts"), 2)
        shapes = []
        for k in range(len(box)):
            own = np.ascontiguousarray(edges[of[k] : of[k + 1]].reshape(5, -1).T)
            shapes.append(Shape(box[k], near[k], own, starts[at[k] : at[k + 1]], self.signed))
        return shapes

    def __call__(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if self.once is not None:
            # one flag for each key and zone
            most = max(1, _FLAGS // max(self.zones, 1))
            if rows.num_rows > most:
                for at in range(0, rows.num_rows, most):
                    yield from self(rows.slice(at, most))
                return
        features = Features(rows, 5 if self.signed else 4)
        flags = Once(self, rows) if self.once is not None else None
        for n, (zones, shapes) in enumerate(self.parts()):
            found, waiting = [], 0
            for k, shape in enumerate(shapes):
                i = shape.met(features.box)
                if not len(i):
                    continue
                i, *values = self.tested(shape, i, features, k < KEPT)
                if flags is not None:
                    i = flags.new(i, int(self.number[n][k]))
                if len(i):
                    found.append((i, np.full(len(i), k), *values))
                    waiting += len(i)
                if waiting >= kernels.ROWS:
                    yield self.taken(rows, zones, found)
                    found, waiting = [], 0
            if found:
                yield self.taken(rows, zones, found)
        if flags is not None:
            self.key, self.seen = flags.last()

    def tested(self, shape: Shape, i: np.ndarray, features: Features, keep: bool) -> tuple[np.ndarray, ...]:
        """Which of the features ``i`` count, and what is put out for each beside both sides' columns."""
        raise NotImplementedError

    @staticmethod
    def taken(rows: pa.RecordBatch, zones: pa.StructArray, found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        i, k, *values = (np.concatenate(c) for c in zip(*found))
        columns = [c.take(pa.array(i)) for c in rows.column("__p").flatten()]
        columns += [c.take(pa.array(k)) for c in zones.flatten()]
        names = [f.name for f in (*rows.column("__p").type, *zones.type)]
        return pa.RecordBatch.from_arrays(
            [*columns, *(pa.array(v) for v in values)], names=[*names, *(f"__v{n}" for n in range(len(values)))]
        )


class Once:
    """Which keys of a batch have met which zones, from the last key of the batch before on."""

    def __init__(self, test: _Test, rows: pa.RecordBatch):
        self.keys, self.code = np.unique(rows.column("__key").to_numpy(), return_inverse=True)
        self.alone = len(self.keys) == rows.num_rows
        self.done = np.zeros((len(self.keys), test.zones), bool)
        if test.key is not None:
            self.done[np.ix_(np.flatnonzero(self.keys == test.key), test.seen)] = True

    def new(self, i: np.ndarray, zone: int) -> np.ndarray:
        """Those rows whose key had not met the zone, one for each key."""
        i = i[~self.done[self.code[i], zone]]
        if not self.alone:
            i = i[np.sort(np.unique(self.code[i], return_index=True)[1])]
        self.done[self.code[i], zone] = True
        return i

    def last(self) -> tuple[int, np.ndarray]:
        return int(self.keys[-1]), np.flatnonzero(self.done[-1])


def _plain(value):
    """A value as Spark's grouping compares it: NaN is NaN, and lists by what they hold."""
    if isinstance(value, float):
        return "NaN" if value != value else value
    if isinstance(value, dict):
        return tuple((k, _plain(v)) for k, v in value.items())
    return tuple(map(_plain, value)) if isinstance(value, (list, tuple)) else value


class Meeting(_Test):
    """Features that share a point with the zone."""

    def tested(self, shape, i, features, keep):
        looked = shape.free(features.box[:, i], keep)
        hit = np.zeros(len(i), bool)
        rest = np.arange(len(i))
        if looked is not None:
            free, inside = looked
            hit = free & (inside != 0) & features.started[i]
            rest = np.flatnonzero(~free)
        if len(rest):
            edges, of = of_rows(features.edges, features.of, i[rest])
            starts, at = of_rows(features.starts, features.at, i[rest])
            hit[rest] = kernels.intersecting(edges, of, starts, at, shape.outline)
        return (i[hit],)


class Shared(_Test):
    """The area that features and the zone share, as ``overlap`` explains it; none where it is known to be none."""

    signed = True

    def tested(self, shape, i, features, keep):
        miny, maxy = shape.box[[1, 3]]
        i = i[np.minimum(features.box[3, i], maxy) > np.maximum(features.box[1, i], miny)]
        looked = shape.free(features.box[:, i], keep)
        area = np.zeros(len(i))
        rest = np.arange(len(i))
        known = np.zeros(len(i), bool)
        if looked is not None:
            free, inside = looked
            known = free & (inside != 0)
            area[known] = inside[known] * features.area()[i[known]]
            rest = np.flatnonzero(~free)
        if len(rest):
            edges, of = of_rows(features.edges, features.of, i[rest])
            area[rest] = shared(edges, of, features.box[0, i[rest]], features.box[2, i[rest]], shape.outline)
            known[rest] = True
        return i[known], area[known]


def shared(p: np.ndarray, of: np.ndarray, west: np.ndarray, east: np.ndarray, outline: kernels.Outline) -> np.ndarray:
    """(owners of p): area shared with the outline, positions being counted from each owner's left bound on."""
    owner = np.repeat(np.arange(len(of) - 1), np.diff(of))
    out = np.zeros(len(of) - 1)
    rising = p[:, 1] < p[:, 3]
    p, owner = p[rising], owner[rising]
    for some, q in outline.near(p[:, 1], p[:, 3]):
        own = owner[some]
        # an edge right of the feature takes part in no overlap
        met = np.maximum(p[some, 1][:, None], q[:, 1]) < np.minimum(p[some, 3][:, None], q[:, 3])
        i, j = np.nonzero(met & (np.minimum(q[:, 0], q[:, 2]) < east[own][:, None]))
        one, two, own = p[some[i]], q[j], own[i]
        low, high = np.maximum(one[:, 1], two[:, 1]), np.minimum(one[:, 3], two[:, 3])
        p0, p1, q0, q1 = (
            e[:, 0] + (y - e[:, 1]) * (e[:, 2] - e[:, 0]) / (e[:, 3] - e[:, 1]) - west[own]
            for e in (one, two) for y in (low, high)
        )
        gap0, gap1 = p0 - q0, p1 - q1
        mean = (np.maximum(p0, q0) + np.maximum(p1, q1)) / 2
        # where the edges cross inside the range the larger one changes: two trapezoids meet there
        crossed = gap0 * gap1 < 0
        part = np.abs(gap0[crossed]) / (np.abs(gap0[crossed]) + np.abs(gap1[crossed]))
        middle = p0[crossed] + (p1[crossed] - p0[crossed]) * part
        before, after = np.maximum(p0, q0)[crossed] + middle, middle + np.maximum(p1, q1)[crossed]
        mean[crossed] = (part * before + (1 - part) * after) / 2
        out += np.bincount(own, -one[:, 4] * two[:, 4] * (high - low) * mean, len(out))
    return out


def _deal(features: DataFrame, zones: DataFrame, per: DataFrame, hash_of: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``__salt``: squares with many features are dealt over salts."""
    parts = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = per.agg(F.sum("n")).first()[0] or 0
    share = F.col("n") * (SHARES * parts) / F.lit(max(total, 1))
    hot = stored(per.filter(share > 1).select(*ON, F.ceil(share).cast("int").alias("__salts")))
    dealt = features.join(F.broadcast(hot), ON, "left").withColumn(
        "__salt", F.coalesce(F.pmod(hash_of, "__salts").cast("int"), F.lit(0))
    )
    salts = F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)
    copied = zones.join(F.broadcast(hot), ON, "left").withColumn("__salt", F.explode(salts))
    return dealt.drop("__salts"), copied.drop("__salts")


def cut_zones(
    zones: DataFrame, shape: Column, keys: Column, cell: float, levels: list[tuple[int, float, float]], signed: bool
) -> DataFrame:
    """``zones`` once per window they meet: ``__z`` with the keys, and what of the outline counts there."""
    given = zones.select(keys.alias("__z"), shape.alias("__shape"))
    schema = StructType([StructField("__z", given.schema["__z"].dataType), *StructType.fromDDL(_CUT)])
    return given.mapInArrow(_cut(levels, cell, signed), schema)


def per_square(placed: DataFrame, n: str = "count(*)") -> DataFrame:
    return stored(placed.groupBy(*ON).agg(F.expr(n).alias("n"), F.max("__wide").alias("wide")))


def levels_of(per: DataFrame, cell: float) -> list[tuple[int, float, float]]:
    """Level, side of a square and width of the widest feature of each grid that holds features."""
    found = per.groupBy("__lv").agg(F.max("wide").alias("wide")).collect()
    return [(r["__lv"], float(cell) * SQUARE * 2.0 ** r["__lv"], r["wide"]) for r in found]


def meeting(
    features: DataFrame,
    zones: DataFrame,
    feature_key: list[str],
    geometry: str,
    cell: float,
    schema: StructType,
    once: tuple[list[str], list[str]] | None = None,
) -> DataFrame:
    """Pairs of features and zones that share a point, with the columns of both; ``once`` as in the join."""
    attributes = [F.col(f"`{c}`") for c in features.columns if c != geometry]
    keys = [F.col(f"`{c}`") for c in zones.columns if c != geometry]
    shape = F.col(f"`{geometry}`")
    parts = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the features of a file or two would be worked on by as many tasks
    spread = features.repartition(parts, F.xxhash64(*feature_key, shape))
    row = F.struct(*attributes).alias("__p")
    if once is None:
        per = per_square(place(features, shape, [], cell, False, whole=False))
        rows = place(spread, shape, [row, F.xxhash64(*feature_key).alias("__hash")], cell, False)
        test, order = Meeting, []
    else:
        # rows of one key come to one place, so they lie in the square of their common bounds
        names = [f"__k{n}" for n in range(len(once[0]))]
        own = [F.col(f"`{c}`").alias(n) for c, n in zip(once[0], names)]
        bounded = place(spread, shape, [row, *own, F.monotonically_increasing_id().alias("__key")], cell, False)
        ends = [f(F.col("__box")[n]) for n, f in enumerate((F.min, F.min, F.max, F.max))]
        whole = F.struct(*(v.alias(c) for c, v in zip(_ENDS, ends))).alias("__whole")
        alike = place(features, shape, own, cell, False, whole=False)
        alike = alike.groupBy(*names).agg(whole, F.count("*").alias("__n"))
        per = per_square(squared(alike, cell), "sum(__n)")
        same = Window.partitionBy(*names)
        over = F.struct(*(v.over(same).alias(c) for c, v in zip(_ENDS, ends)))
        gathered = bounded.drop(*ON, "__wide").withColumns({"__whole": over, "__key": F.min("__key").over(same)})
        rows = squared(gathered, cell).withColumn("__hash", F.xxhash64(*names)).drop(*names, "__whole")
        test, order = functools.partial(Meeting, once=once[1]), ["__key"]
    cut = cut_zones(zones, shape, F.struct(*keys), cell, levels_of(per, cell), False)
    rows, shapes = _deal(rows.drop("__wide"), cut, per, "__hash")
    return kernels.tested(rows.drop("__hash"), shapes, [*ON, "__salt"], test, schema, order, HELD)


def overlap(features: DataFrame, zones: DataFrame, shape: Column, keys: Column, cell: float, schema: StructType) -> DataFrame:
    """Shared areas of placed features (``__p``, ``__hash``) and zones, with the columns of both.

    Of edges beyond a window those on its left count, as those on its right take part in no overlap.
    """
    per = per_square(features)
    cut = cut_zones(zones, shape, keys, cell, levels_of(per, cell), True)
    rows, shapes = _deal(features.drop("__wide"), cut, per, "__hash")
    return kernels.tested(rows.drop("__hash"), shapes, [*ON, "__salt"], Shared, schema, held=HELD)
